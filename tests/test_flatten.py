"""Flattening a raw access history, against loops over its objects."""

import itertools
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dustline import access_history, flatten_access_history, unused_objects
from dustline.sources.tables import ACCESS_HISTORY

OBJECT = "struct<objectDomain: string, objectId: bigint, objectName: string, stageKind: string, columns: array<string>>"
SCHEMA = f"""QUERY_ID string, QUERY_START_TIME timestamp, USER_NAME string, PARENT_QUERY_ID string,
    ROOT_QUERY_ID string, OBJECT_MODIFIED_BY_DDL struct<objectName: string>,
    DIRECT_OBJECTS_ACCESSED array<{OBJECT}>, BASE_OBJECTS_ACCESSED array<{OBJECT}>,
    OBJECTS_MODIFIED array<{OBJECT}>, more int"""
NOW = datetime(2024, 1, 1)


def thing(name, stage=None):
    return ("Table", len(name), name, stage, ["c"])


ARRAYS = [None, [], [None], [thing("a")], [thing("b"), thing("c", "Internal"), thing("b")]]
ROWS = [
    (str(i), NOW, f"u{i}", None, "r", ("t",) if i % 2 else None, direct, base, modified, i)
    for i, (direct, base, modified) in enumerate(itertools.product(ARRAYS, repeat=3))
]


def expected(rows):
    def cells(one):
        return tuple(one[:4]) if one else (None,) * 4

    found = []
    for qid, time, user, parent, root, ddl, *arrays, _ in rows:
        ddl = json.dumps({"objectName": ddl[0]}, separators=(",", ":")) if ddl else None
        for direct, base, modified in itertools.product(*[a or [None] for a in arrays]):
            found.append((qid, time, user, parent, ddl, root, *cells(direct), *cells(base), *cells(modified)))
    return sorted(found, key=repr)


def flat(df, **more):
    out = flatten_access_history(df, **more)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in ACCESS_HISTORY]
    return sorted(map(tuple, out.collect()), key=repr)


def test_all_combinations(spark):
    raw = spark.createDataFrame(ROWS, SCHEMA)
    assert flat(raw) == expected(ROWS)
    assert flat(raw.limit(0)) == []
    lower = raw.toDF(*[c.lower() for c in raw.columns])
    assert flat(lower) == expected(ROWS)


def test_text_and_variants(spark):
    raw = spark.createDataFrame(ROWS, SCHEMA)
    nested = ["DIRECT_OBJECTS_ACCESSED", "BASE_OBJECTS_ACCESSED", "OBJECTS_MODIFIED", "OBJECT_MODIFIED_BY_DDL"]
    text = raw.select("*", *[F.to_json(c).alias(f"t_{c}") for c in nested]).drop(*nested)
    text = text.withColumnsRenamed({f"t_{c}": c for c in nested})
    assert flat(text) == expected(ROWS)
    variant = text.withColumns({c: F.parse_json(c) for c in nested})
    assert flat(variant) == expected(ROWS)


def test_broken_text(spark):
    raw = spark.createDataFrame(ROWS[:1], SCHEMA)
    broken = raw.withColumn("OBJECTS_MODIFIED", F.lit("[{"))
    with pytest.raises(Exception, match="OBJECTS_MODIFIED is not an array"):
        flat(broken)
    assert len(flat(broken, strict=False)) == 1
    assert len(flat(raw.withColumn("OBJECTS_MODIFIED", F.lit("null")))) == 1
    with pytest.raises(TypeError, match="not an array"):
        flatten_access_history(raw.withColumn("OBJECTS_MODIFIED", F.lit(1)))


def test_fields_may_be_missing(spark):
    raw = spark.createDataFrame(ROWS, SCHEMA).withColumn(
        "BASE_OBJECTS_ACCESSED", F.array(F.struct(F.lit("x").alias("OBJECTNAME")))
    )
    rows = flatten_access_history(raw)
    assert rows.select("BASE_OBJECT_NAME", "BASE_OBJECT_ID").distinct().collect() == [("x", None)]


def test_no_shuffle_and_reports_read_it(spark, capsys):
    history = flatten_access_history(spark.createDataFrame(ROWS, SCHEMA))
    history.explain()
    assert "Exchange" not in capsys.readouterr().out
    report = unused_objects(access_history(history), as_of="2024-12-01", multiplicity="distinct")
    assert report.count() > 0
