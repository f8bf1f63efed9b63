"""Mentions of many objects against one scan for each, and identifiers against a small lexer."""

import collections
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dustline import (
    all_object_mentions,
    catalog_objects,
    data_check,
    data_check_all,
    identifier_mentions,
    mention_index,
    object_mentions,
)
from dustline.operators import mentions

START = datetime(2024, 1, 1)
LOG = "query_text string, end_time timestamp"


def log_of(spark, texts, schema=LOG):
    rows = [(text, START + timedelta(minutes=i)) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


TEXTS = [
    "select * from db.sales.orders",
    "SELECT * FROM DB.Sales.ORDERS2",
    "select * from dbxsales.orders -- 50%",
    "",
    None,
    "db.sales.orders db.sales.orders db.sales.click",
    "a\nb.c\nd 100% a_b aXb a\\b",
    "İstanbul STRASSE straße ΣΑΣ",
    "x" * 100_000 + "db.sales.click" + "y" * 100_000,
]
NAMES = [
    "db.sales.orders", "DB.SALES.ORDERS2", "sales.ord", "orders", "db_sales.orders", "db%orders", "%", "_", "", "a_b",
    "a\\b", "a%b", "b.c\nd", "none.of.these", "db.sales.click", "İSTANBUL", "straße", "STRASSE", "σας", "50%", "%%_%", "orders",
]


@pytest.mark.parametrize("literal", [False, True])
@pytest.mark.parametrize("most", [3, mentions.NAMES])
def test_same_as_one_by_one(spark, literal, most):
    log = log_of(spark, TEXTS).repartition(3)
    found = {r["object_name"]: tuple(r)[1:] for r in all_object_mentions(log, NAMES, literal, most).collect()}
    assert found.keys() == set(NAMES)
    for name in set(NAMES):
        assert found[name] == tuple(object_mentions(log, name, literal).first()), name


@pytest.mark.parametrize("seed", range(3))
def test_random_names(spark, seed):
    draw = random.Random(seed)

    def text(size, letters):
        return "".join(draw.choice(letters) for _ in range(size))

    log = log_of(spark, [text(draw.randint(0, 30), "aAbB._") for _ in range(60)])
    names = [text(draw.randint(1, 5), "abB._%") for _ in range(25)]
    found = {r["object_name"]: tuple(r)[1:] for r in all_object_mentions(log, names).collect()}
    for name in set(names):
        assert found[name] == tuple(object_mentions(log, name).first()), name


def test_time_keeps_its_type_and_one_scan(spark, capsys):
    log = log_of(spark, TEXTS).select("query_text", F.col("end_time").cast("timestamp_ntz"))
    found = all_object_mentions(log, [f"db.t{i}" for i in range(5000)] + ["db.sales.click"])
    assert found.schema["last_usage"].dataType.simpleString() == "timestamp_ntz"
    found.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
    assert found.where("query_count > 0").collect()[0]["query_count"] == 2
    assert found.count() == 5001
    assert all_object_mentions(log, []).count() == 0
    assert all_object_mentions(log.limit(0), ["a"]).first()["query_count"] == 0


def test_all_checks_at_once(spark, database):
    log = log_of(spark, TEXTS)
    days = spark.range(100).select(F.expr("timestamp'2024-01-01' - make_interval(0, 0, 0, int(id))").alias("last_accessed_timestamp"))
    targets = {"db.sales.orders": days, "db.sales.click": days.where("last_accessed_timestamp < '2023-12-01'"), "fresh": days.limit(0)}
    interval = timedelta(days=30)
    found = {r["object_name"]: tuple(r)[1:] for r in data_check_all(log, targets, interval, START).collect()}
    for name, target in targets.items():
        alone = data_check(log, target, name, interval, START).first()
        assert found.get(name) == (tuple(alone) if alone else None)
    assert set(found) == {"db.sales.orders", "db.sales.click"}
    with pytest.raises(ValueError):
        data_check_all(log, {}, interval)
    days.write.mode("overwrite").saveAsTable(f"{database}.days")
    assert f"spark_catalog.{database}.days" in catalog_objects(spark, database)


# Identifiers


def plain_names(text, database, schema):
    """The names of a text, read one character after the other."""
    place, chains = 0, []

    def skip(end, start):
        found = text.find(end, start)
        return len(text) if found < 0 else found + len(end)

    def part(at):
        if at < len(text) and text[at] == '"':
            end = at + 1
            while True:
                end = text.find('"', end)
                if end < 0:
                    return None
                if text[end : end + 2] != '""':
                    break
                end += 2
            return (text[at + 1 : end].replace('""', '"'), end + 1) if end > at + 1 else None
        word = re.compile(r"[^\W\d][\w$]*").match(text, at)
        return (word[0].upper(), word.end()) if word else None

    while place < len(text):
        two = text[place : place + 2]
        if two in ("--", "//"):
            place = skip("\n", place)
        elif two == "/*":
            place = skip("*/", place + 2)
        elif two == "$$":
            place = skip("$$", place + 2)
        elif text[place] == "'":
            place += 1
            while place < len(text):
                if text[place] == "\\" or text[place : place + 2] == "''":
                    place += 2
                elif text[place] == "'":
                    break
                else:
                    place += 1
            place += 1
        elif text[place].isdigit():
            place = re.compile(r"[\w$.]+").match(text, place).end()
        elif found := part(place):
            names = [found[0]]
            place = found[1]
            while True:
                dot = re.compile(r"\s*\.\s*").match(text, place)
                found = part(dot.end()) if dot else None
                if not found:
                    break
                names.append(found[0])
                place = found[1]
            chains.append(names)
        else:
            place += 1
    full = {1: lambda n: [database, schema, *n], 2: lambda n: [database, *n]}
    return {tuple(full.get(len(n), lambda n: n[:3])(n)) for n in chains}


ODD = [
    "select * from orders",
    "select * from orders2 join Sales . Orders",
    'select "orders", "a""b"."c.d" from DB.sales."Orders" x',
    "-- from orders\nselect 'it''s orders' /* orders\n */ from db.sales.orders.id",
    "select 'open orders",
    "/* open orders",
    "select $$ orders $$ , 1.orders, 2e5, a1.b2, x.\"y",
    "// orders\r\nselect '\\' orders ' , orders",
    "über.straße _x.$y z$1",
    "",
    "''''orders'",
    "a.b.c.d.e",
    "orders" * 5000,
    "x." * 3000 + "orders",
]


def test_names_of_odd_texts(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string")
    names = mentions.identifiers(F.col("t"), F.lit("DB"), F.lit("SALES"))
    for row in df.select("t", names.alias("n")).collect():
        assert {tuple(n) for n in row["n"]} == plain_names(row["t"], "DB", "SALES"), row["t"][:80]
        assert len(row["n"]) == len({tuple(n) for n in row["n"]})


@pytest.mark.parametrize("seed", range(2))
def test_names_of_random_texts(spark, seed):
    draw = random.Random(seed)
    pieces = ["orders", "Sales", ".", " . ", '"', '""', "'", "--", "\n", "/*", "*/", "$$", " ", "1", "_x", "\\", ",", "é", "//"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(1, 14))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    names = mentions.identifiers(F.col("t"), F.lit("DB"), F.lit("SALES"))
    for row in df.select("t", names.alias("n")).collect():
        assert {tuple(n) for n in row["n"]} == plain_names(row["t"], "DB", "SALES"), repr(row["t"])


def test_mentions_by_identifier(spark):
    texts = [
        "select * from orders",
        "select * from orders2",
        "select * from sales.orders o join db.sales.orders p",
        "select * from 'db.sales.orders' -- orders",
        'select * from "orders"',
        None,
    ]
    log = log_of(spark, texts).withColumn("s", F.lit("SALES"))
    objects = spark.createDataFrame(
        [("DB", "SALES", "ORDERS", 1), ("DB", "SALES", "orders", 2), ("DB", "OTHER", "ORDERS", 3)],
        "object_database string, object_schema string, object_name string, last_usage int",
    )
    index = mention_index(log, "DB", F.col("s"))
    found = {tuple(r)[1:3]: tuple(r)[3:] for r in identifier_mentions(index, objects).collect()}
    assert found[("SALES", "ORDERS")] == (START + timedelta(minutes=2), 2)
    assert found[("SALES", "orders")] == (START + timedelta(minutes=4), 1)
    assert found[("OTHER", "ORDERS")] == (None, 0)
    by_text = object_mentions(log, "orders").first()["query_count"]
    assert by_text == 5
    expected = collections.Counter(n for t in texts for n in plain_names(t or "", "DB", "SALES"))
    assert {tuple(r)[:3]: r["query_count"] for r in index.collect()} == expected
    assert mention_index(log.limit(0)).count() == 0
