"""Exact dedup when suspects are too many to be sent to every task."""

import re

import pytest
from pyspark.sql import functions as F
from samples import plain

from dustline.llm import bitmaps, exact_dedup
from dustline.llm.common import ROW, numbered
from dustline.llm.exact_dedup import digests


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def corpus(spark, rows=6000, parts=8):
    """A third of the rows alike, a third in pairs, the others once."""
    text = (
        F.when(F.col("id") % 3 == 0, F.lit("the same text again"))
        .when(F.col("id") % 3 == 1, F.concat(F.lit("pair "), F.floor(F.col("id") / 6)))
        .otherwise(F.concat(F.lit("alone "), F.col("id")))
    )
    return spark.range(rows).select(F.col("id").alias("doc_id"), text.alias("text")).repartition(parts)


def test_same_result_without_broadcasts(spark, odd, no_broadcast):
    found = plain(exact_dedup.find_copies(odd))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert found == plain(exact_dedup.find_copies(odd))


def test_no_text_is_shuffled_before_it_is_grouped(spark, no_broadcast, capsys):
    docs = corpus(spark)
    slim = numbered(digests(docs), "t")
    by_plan = exact_dedup.copies(docs, slim)
    assert by_plan.where("kept").count() == 1 + 2000 + 1000
    # An exchange of texts stands above a partial aggregate of them only, and nothing is joined.
    possible = bitmaps.may_contain(slim.select("fingerprint").limit(10), 10)
    exact_dedup.groups_of_bytes(docs, possible).explain()
    plan = capsys.readouterr().out
    assert plan.count("sha2(") == 1
    order = re.findall(r"(HashAggregate|Exchange hashpartitioning|Join)", plan)
    assert order == ["HashAggregate", "Exchange hashpartitioning", "HashAggregate"]


def test_a_hot_text_loads_no_task(spark, no_broadcast):
    """Rows for each task of what is shuffled, of a text that a third of the rows hold."""
    docs = corpus(spark, 24_000)
    text = exact_dedup.normalised(F.col("text"))
    fingerprint = F.xxhash64(text).alias("f")
    one = docs.select(fingerprint).distinct()
    possible = bitmaps.may_contain(one, 24_000)
    counted = docs.select(fingerprint, text.alias("b")).where(possible(F.col("f")))
    partial = counted.groupBy("f", "b", F.spark_partition_id()).count()
    hot = partial.where("b = 'thesametextagain'")
    assert hot.count() <= 8 and hot.agg(F.sum("count")).first()[0] == 8000
    # Rows with a large group's name never move: the join with their group is a broadcast.
    slim = numbered(digests(docs), "t")
    found = exact_dedup.copies(docs, slim)
    sizes = found.where("group_size = 8000").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 2 and max(r["count"] for r in sizes) < 8000


@pytest.mark.parametrize("rows", [0, 1, 5000])
def test_bitmap_contains_all(spark, rows, monkeypatch):
    for most in (bitmaps.MOST_BITS, bitmaps.BLOCK_BITS + 1, bitmaps.BLOCK_BITS):
        monkeypatch.setattr(bitmaps, "MOST_BITS", most)
        held = spark.range(rows).select(F.xxhash64("id").alias("h"))
        possible = bitmaps.may_contain(held, rows)
        assert held.where(~possible(F.col("h"))).count() == 0
        others = spark.range(10_000_000, 10_020_000).select(F.xxhash64("id").alias("h"))
        assert others.where(possible(F.col("h"))).count() <= 20_000 * (rows / 2**19 + 0.01)


def test_rows_are_kept_whole(spark, odd):
    kept = exact_dedup.deduplicate(odd.where("doc_id is not null"))
    assert ROW not in kept.columns and kept.columns == odd.columns
