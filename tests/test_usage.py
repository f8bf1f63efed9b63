"""The usage reports: edge cases, and the join they stand for as SQL."""

import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dustline import (
    access_history,
    check_table,
    data_check,
    dim_access_history,
    materialize,
    object_mentions,
    object_usage,
    stale_rows,
    unused_objects,
)
from dustline.operators.usage import repeat_rows
from dustline.sources.tables import ACCESS_HISTORY

AS_OF = datetime(2024, 4, 20, 12)
SCHEMA = (
    "base_object_name string, user_name string, query_start_time timestamp, "
    "object_modified_by_ddl string"
)


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def history(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


JOIN_FORM = """
    WITH object_usage AS (
        SELECT base_object_name, user_name, max(query_start_time) AS last_usage,
               count(*) AS usage_count
        FROM {h}
        WHERE user_name IS NOT NULL AND object_modified_by_ddl IS NOT NULL
        GROUP BY base_object_name, user_name)
    SELECT u.* FROM object_usage u LEFT JOIN {h} o
      ON u.base_object_name = o.base_object_name AND u.user_name = o.user_name
    WHERE date_diff(TIMESTAMP '2024-04-20 12:00:00', u.last_usage) > 90
"""


def test_boundary_counts_calendar_days(spark):
    h = history(
        spark,
        [
            ("kept", "u", at("2024-01-21 00:00:01"), "{}"),  # 90 boundaries, 90.5 days
            ("found", "u", at("2024-01-20 23:59:59"), "{}"),  # 91 boundaries, 90.5 days
        ],
    )
    assert [r.base_object_name for r in unused_objects(h, AS_OF).collect()] == ["found"]


def test_who_counts_and_how_often(spark):
    old = at("2023-01-01 00:00:00")
    rows = [("o", "u", old, "{}")] * 2 + [("o", "u", old, None)] * 3  # five rows, two uses
    rows += [(None, "u", old, "{}")] * 5  # null object: matches nothing, stays once
    rows += [("o", None, old, "{}")] * 2  # null user: never
    rows += [("only_reads", "u", old, None)]  # no ddl: absent
    rows += [("o", "u", at("2023-02-01 00:00:00"), None)]  # a read does not refresh
    rows += [("no_time", "u", None, "{}")]  # unknown last usage is not "unused"
    h = history(spark, rows)
    by_rows = unused_objects(h, AS_OF).collect()
    assert sorted((r[0] or "", r[1], r.usage_count) for r in by_rows) == (
        [("", "u", 5)] + [("o", "u", 2)] * 6
    )
    counted = unused_objects(h, AS_OF, multiplicity="count").collect()
    assert {(r[0], r.fan_out) for r in counted} == {(None, 1), ("o", 6)}
    assert unused_objects(h, AS_OF, multiplicity="distinct").count() == 2
    assert all(r.last_usage == by_rows[0].last_usage for r in by_rows)
    everyone = unused_objects(h, AS_OF, multiplicity="distinct", ddl_only=False).collect()
    assert {r[0] for r in everyone} == {None, "o", "only_reads"}
    assert unused_objects(h, AS_OF, days=10_000).count() == 0
    with pytest.raises(ValueError):
        unused_objects(h, AS_OF, multiplicity="twice")


def test_now_is_the_default(spark):
    now = datetime.now(timezone.utc)
    h = history(
        spark,
        [("fresh", "u", now, "{}"), ("old", "u", now - timedelta(days=92), "{}")],
    )
    assert [r[0] for r in unused_objects(h).collect()] == ["old"]


@pytest.mark.parametrize("seed", range(4))
def test_single_scan_equals_join(spark, seed):
    rng = random.Random(seed)
    base = at("2023-12-25 00:00:00")
    rows = [
        (
            rng.choice(["a", "b", "c", None]),
            rng.choice(["u", "v", "w", "x", None]),
            rng.choice([None] + [base + timedelta(hours=rng.randrange(1200))] * 6),
            rng.choice(["{}", None, None, None]),
        )
        for _ in range(rng.choice([0, 40, 400]))
    ]
    h = history(spark, rows)
    h.createOrReplaceTempView("h_random")
    expected = spark.sql(JOIN_FORM.format(h="h_random"))
    found = unused_objects(h, AS_OF)
    assert found.columns == expected.columns
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    pairs = unused_objects(h, AS_OF, multiplicity="distinct")
    assert sorted(map(str, pairs.collect())) == sorted(map(str, expected.distinct().collect()))


def test_a_hot_pair_is_copied_by_many_tasks(spark):
    pairs = spark.createDataFrame([("hot", 250_001), ("cold", 1), ("none", 0)], "k string, n long")
    copies = repeat_rows(pairs, "n", block=10_000)
    assert {r.k: r["count"] for r in copies.groupBy("k").count().collect()} == {
        "hot": 250_001,
        "cold": 1,
    }
    tasks = copies.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1


def test_plan_has_one_scan_no_join_and_pushed_filter(spark, tmp_path):
    path = str(tmp_path / "history")
    history(spark, [("o", "u", at("2023-01-01 00:00:00"), "{}")]).withColumn(
        "query_id", F.lit("q")
    ).write.parquet(path)
    h = spark.read.parquet(path)
    plan = unused_objects(h, AS_OF)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("FileScan") == 1
    assert "Join" not in physical
    assert "IsNotNull(user_name)" in physical
    assert "query_id" not in physical.split("ReadSchema")[1]
    plan = object_usage(h)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "IsNotNull(object_modified_by_ddl)" in plan


LOG = [
    ("select * from DB.SALES.orders", at("2024-01-05 00:00:00")),
    ("SELECT 1 FROM db.sales.ORDERS2", at("2024-01-07 00:00:00")),
    ("select 'db_sales.orders'", at("2024-01-08 00:00:00")),
    ("select * from dbXsales.a_b", at("2024-01-09 00:00:00")),
    ("select * from db.sales.aXb\nwhere 1", at("2024-01-10 00:00:00")),
    (None, at("2024-01-11 00:00:00")),
    (r"select * from db.sales.back\slash", at("2024-01-12 00:00:00")),
]


def mentions(spark, name, literal=False):
    log = spark.createDataFrame(LOG, "query_text string, end_time timestamp")
    row = object_mentions(log, name, literal).collect()
    assert len(row) == 1
    return row[0].query_count, row[0].last_usage


def test_mentions(spark):
    assert mentions(spark, "db.sales.orders")[0] == 2  # any case; a longer name also matches
    assert mentions(spark, "db.sales.a_b")[0] == 1  # "_" is any character
    assert mentions(spark, "db.sales.a_b", literal=True)[0] == 0
    assert mentions(spark, "db%a", literal=True)[0] == 0
    assert mentions(spark, "db%sales")[0] == 6
    assert mentions(spark, r"db.sales.back\slash")[0] == 1
    assert mentions(spark, r"db.sales.back\slash", literal=True)[0] == 1
    assert mentions(spark, "absent") == (0, None)


def target(spark, kind="timestamp"):
    days = [at("2024-01-01 00:00:00"), at("2024-01-02 00:00:00"), at("2024-01-03 12:00:00"), None]
    df = spark.createDataFrame([(d,) for d in days], "last_accessed_timestamp timestamp")
    return df.withColumn("last_accessed_timestamp", F.col("last_accessed_timestamp").cast(kind))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize(
    "interval", [timedelta(days=1), "1 day", "'1 days'", "INTERVAL '1 days'", "interval 24 hours"]
)
def test_stale_is_strictly_before(spark, kind, interval):
    as_of = datetime(2024, 1, 3)
    assert stale_rows(target(spark, kind), interval, as_of).count() == 1
    later = datetime(2024, 1, 3, 0, 0, 1)
    assert stale_rows(target(spark, kind), interval, later).count() == 2
    assert stale_rows(target(spark, kind), interval, "2024-01-03 00:00:01").count() == 2
    aware = datetime(2024, 1, 3, 2, 0, 1, tzinfo=timezone(timedelta(hours=2)))
    assert stale_rows(target(spark, kind), interval, aware).count() == 2


def test_stale_dates(spark):
    dates = target(spark, "date")
    assert stale_rows(dates, "1 day", date(2024, 1, 3)).count() == 1
    assert stale_rows(dates, "1 day", datetime(2024, 1, 3, 0, 0, 1)).count() == 2
    assert stale_rows(dates, "1 month", datetime(2024, 3, 1)).count() == 3


def test_stale_now_and_other_column(spark):
    df = target(spark).withColumnRenamed("last_accessed_timestamp", "seen")
    assert stale_rows(df, timedelta(days=1), column="seen").count() == 3


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_stale_filter_reaches_the_scan(spark, tmp_path, kind):
    path = str(tmp_path / kind)
    target(spark, kind).write.parquet(path)
    plan = stale_rows(spark.read.parquet(path), timedelta(days=1), AS_OF)
    text = plan._jdf.queryExecution().toString()
    assert "LessThan(last_accessed_timestamp" in text.split("PushedFilters")[1]


def test_data_check(spark):
    log = spark.createDataFrame(LOG, "query_text string, end_time timestamp")
    as_of = datetime(2024, 1, 4)
    found = data_check(log, target(spark), "db.sales.orders", timedelta(days=1), as_of).collect()
    assert [(r.query_count, r.unused_data_count) for r in found] == [(2, 2)]
    assert found[0].last_usage == spark.sql("SELECT TIMESTAMP '2024-01-07 00:00:00'").first()[0]
    silent = data_check(log, target(spark), "absent", timedelta(days=1), as_of).collect()
    assert [tuple(r) for r in silent] == [(None, 0, 2)]
    nothing_stale = data_check(log, target(spark), "db.sales.orders", "90000 days", as_of)
    assert nothing_stale.collect() == []
    plan = data_check(log, target(spark), "x", "1 day")._jdf.queryExecution().toString()
    assert "Join" not in plan.split("== Physical Plan ==")[1]


def test_check_table_by_name(spark, database):
    materialize(target(spark), "odd_name", database=database)
    log = spark.createDataFrame(
        [(f"select * from spark_catalog.{database}.odd_name", at("2024-01-05 00:00:00"))],
        "query_text string, end_time timestamp",
    )
    found = check_table(
        spark, log, "spark_catalog", database, "odd_name", "1 day", datetime(2024, 1, 4)
    )
    assert [(r.query_count, r.unused_data_count) for r in found.collect()] == [(1, 2)]


def test_access_history_model(spark, database):
    wide = spark.createDataFrame(
        [tuple(str(i) if f.name.endswith("_ID") else "x" for i, f in enumerate(ACCESS_HISTORY)) + ("extra",)],
        [f.name.lower() for f in ACCESS_HISTORY] + ["more"],
    ).withColumn("query_start_time", F.lit("2024-01-01 01:02:03.123456"))
    model = access_history(wide, {"USER_NAME": "who"})
    assert model.columns == ACCESS_HISTORY.fieldNames()
    assert model.schema["QUERY_START_TIME"].dataType == T.TimestampType()
    assert model.select(F.col("QUERY_START_TIME").cast("string")).first()[0] == (
        "2024-01-01 01:02:03.123456"
    )
    kept = materialize(dim_access_history(model), "dim_history", database=database)
    assert kept.columns == model.columns and kept.count() == 1
    described = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {database}.dim_history").collect()}
    assert described["USER_NAME"] == "who"
    view = materialize(dim_access_history(model), "dim_view", kind="view")
    assert view.collect() == model.collect()
    with pytest.raises(ValueError):
        materialize(model, "x", kind="index")


def test_materialize_partitioned_at_a_path(spark, database, tmp_path):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    path = str(tmp_path / "t")
    kept = materialize(df, "parted", database=database, path=path, partition_by=["k"])
    assert kept.where("k = 1").count() == 5
    assert (tmp_path / "t" / "k=1").is_dir()
    assert materialize(df.limit(3), "parted", database=database, path=path).count() == 3


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_data_check_keeps_the_logs_time(spark, kind):
    """Also a time that a zone's clock change leaves out is the one that was logged."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        log = spark.sql(
            f"SELECT 'from db.s.t' AS query_text, CAST('2024-03-10 02:30:00' AS {kind}) AS end_time"
        )
        rows = spark.sql("SELECT DATE '2000-01-01' AS last_accessed_timestamp")
        found = data_check(log, rows, "db.s.t", "1 day")
        mentioned = object_mentions(log, "db.s.t")
        assert found.schema["last_usage"].dataType.simpleString() == kind
        assert found.first()["last_usage"] == mentioned.first()["last_usage"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
