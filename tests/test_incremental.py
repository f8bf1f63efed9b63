"""The report from kept partial aggregates against the one from the whole history."""

import itertools
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dustline import UsageState, unused_objects
from dustline.operators.usage import usage_with_fan_out

AS_OF = "2024-12-01"
SCHEMA = "base_object_name string, user_name string, query_start_time timestamp, object_modified_by_ddl string, arrived string"
ROWS = [
    (
        [None, "a", "b", "c"][i % 4],
        [None, "u", "v"][i % 3],
        datetime(2024, 1, 1) + timedelta(days=(i * 37) % 300, hours=i % 24),
        ["x", None][i % 2],
        f"day {i // 60}",
    )
    for i in range(240)
]


@pytest.fixture
def history(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.partitionBy("arrived").parquet(str(tmp_path / "history"))
    return spark.read.parquet(str(tmp_path / "history")).withColumn("arrived", F.col("arrived").cast("string"))


@pytest.fixture
def state(spark, tmp_path):
    return UsageState(spark, str(tmp_path / "state"))


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def same(state, history):
    for multiplicity, ddl_only in itertools.product(["rows", "count", "distinct"], [True, False]):
        found = state.unused_objects(AS_OF, 90, multiplicity, ddl_only)
        assert rows(found) == rows(unused_objects(history, AS_OF, 90, multiplicity, ddl_only))
    assert rows(state.usage()) == rows(usage_with_fan_out(history))


def test_arrivals_one_by_one(state, history):
    same(state, history.limit(0))
    for last in range(4):
        there = history.where(F.col("arrived") <= f"day {last}")
        assert state.catch_up(there, "arrived") == [f"day {last}"]
        same(state, there)
    assert state.catch_up(history, "arrived") == []
    assert state.arrivals() == [f"day {i}" for i in range(4)]


def test_compacted(state, history):
    state.compact()
    for last in range(3):
        state.catch_up(history.where(F.col("arrived") == f"day {last}"), "arrived")
    before = rows(state.by_day())
    state.compact()
    assert rows(state.by_day()) == rows(state.partials()) == before
    assert state.arrivals() == ["day 0", "day 1", "day 2"]
    assert state.catch_up(history, "arrived") == ["day 3"]
    same(state, history)
    state.compact()
    same(state, history)


def test_runs_that_end_halfway_and_two_at_a_time(state, history, monkeypatch):
    write = state.manifests.write

    def ends(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(state.manifests, "write", ends)
    with pytest.raises(RuntimeError, match="lost"):
        state.catch_up(history, "arrived")
    assert state.arrivals() == [] and state.partials().count() == 0
    monkeypatch.setattr(state.manifests, "write", write)
    monkeypatch.setattr(state.manifests, "next_number", lambda: "00000001")
    assert len(state.catch_up(history.where("arrived < 'day 2'"), "arrived")) == 2
    with pytest.raises(RuntimeError, match="another run"):
        state.catch_up(history, "arrived")
    same(state, history.where("arrived < 'day 2'"))


def test_only_new_arrivals_are_read(state, history, capsys):
    state.catch_up(history.where("arrived < 'day 3'"), "arrived")
    new = state.new_rows(history, "arrived")
    assert new.select(F.input_file_name()).distinct().count() <= 4
    new.explain()
    plan = capsys.readouterr().out
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "day 3" in filters and "day 2" not in filters


def test_rows_without_an_arrival(spark, state):
    df = spark.createDataFrame([("a", "u", datetime(2024, 1, 1), None, None)], SCHEMA)
    with pytest.raises(ValueError, match="without arrived"):
        state.catch_up(df, "arrived")
