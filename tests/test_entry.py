"""Every registered query against its SQL, run by DuckDB on the same tables."""

import pathlib

import pytest

import __spark_entry__ as registered

duckdb = pytest.importorskip("duckdb")
DATA = pathlib.Path("/root/testdata")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connections = {}

    def connect(folder):
        if folder not in connections:
            connection = connections[folder] = duckdb.connect()
            for file in sorted(pathlib.Path(folder).glob("*.parquet")):
                connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        return connections[folder]

    return connect


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(str(tuple(record[i] for i in order)) for record in records)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", registered.usage_and_ingest())
def test_same_as_sql(spark, oracle, name, sf):
    folder = str(DATA / sf)
    found = registered.queries()[name](spark, folder)
    collected = [tuple(r) for r in found.collect()]
    assert collected and found.count() == len(collected)
    expected = oracle(folder).sql(registered.oracle_sql()[name])
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found.columns, collected) == rows(expected.columns, expected.fetchall())


def test_golden_numbers(spark):
    def run(name):
        return registered.queries()[name](spark, str(DATA / "sf0.01"))

    usage = run("object_usage").collect()
    assert (len(usage), sum(r.usage_count for r in usage)) == (120, 2544)
    unused = run("unused_objects").collect()
    assert (len(unused), sum(r.base_object_name is None for r in unused)) == (2277, 10)
    assert run("unused_objects_distinct").count() == 60
    check = run("data_check").first()
    assert (check.query_count, check.unused_data_count) == (2006, 6262)


def test_entry(spark):
    assert registered.entry(spark).columns == [
        "base_object_name",
        "user_name",
        "last_usage",
        "usage_count",
    ]


def test_session_is_left_as_it_was(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        registered.queries()["stale_rows"](spark, str(DATA / "sf0.001"))
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_registered_alike():
    assert set(registered.usage_and_ingest_sql()) == set(registered.usage_and_ingest())
    assert set(registered.oracle_sql()) <= set(registered.queries())
