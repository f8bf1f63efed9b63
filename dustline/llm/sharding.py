"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number for a key, and the record goes to the shard with the lowest draw.
A draw does not depend on the other shards, so one more shard only takes records that it wins
itself, and a heavier weight wins more. The law is ``key``: doc_id and the shards decide.

A null doc_id is a key like any other: all such records share a shard. Null and empty texts
have one byte, long ones as many as they have and one. Equal rows get slots of their own, in any order among themselves. An empty
table gives an empty result. Other columns of the input play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dustline.llm.common import ROW, numbered, running_total

SHARDS = 16
#: Hexadecimal digits of a hash that make a draw; a double holds them exactly.
DIGITS = 13


def draw(key: Column, shard: int, weight: float = 1.0) -> Column:
    """An exponentially distributed number with rate ``weight``, fixed by key and shard."""
    digest = F.md5(F.concat(key, F.lit(f":{shard}")))
    hashed = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long")
    even = (hashed.cast("double") + F.lit(0.5)) / F.lit(float(16**DIGITS))
    return -F.ln(even) / F.lit(float(weight))


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard of a key among shards of these weights; of equal draws the lower shard."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    draws = [
        F.struct(draw(text, shard, weight).alias("draw"), F.lit(shard).alias("shard"))
        for shard, weight in enumerate(weights)
    ]
    return F.array_min(F.array(*draws))["shard"]


def with_shards(docs: DataFrame, weights: list[float], name: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row; a column of that name is replaced."""
    return docs.withColumn(name, shard_of(F.col("doc_id"), weights))


def write_shards(docs: DataFrame, weights: list[float], path: str) -> None:
    """All columns of ``docs``, in one folder for each shard."""
    with_shards(docs, weights).write.partitionBy("shard").parquet(path)


def slots(placed: DataFrame) -> DataFrame:
    """``placed`` with a slot for each row, without a gap from 0 in each shard.

    A shard may hold any number of rows, so rows are counted in ranges, not shard by shard.
    """
    order = [F.col(name) for name in ("shard", "doc_id", ROW)]
    one = placed.withColumn("__one", F.lit(1).cast("long"))
    counted = running_total(one, order, "__one", "__count", "shard-slots", placed.count())
    # As many rows as shards.
    shards = placed.groupBy("shard").agg(F.count("*").alias("__rows")).collect()
    before, total = [], 0
    for shard in sorted(shards):
        before += [F.lit(shard["shard"]), F.lit(total)]
        total += shard["__rows"]
    start = F.create_map(*before)[F.col("shard")] if before else F.lit(0)
    return counted.select(
        *placed.columns, (F.col("__count") - 1 - start).cast("long").alias("slot")
    )


def assign(docs: DataFrame, weights: list[float], grown: list[float] | None = None) -> DataFrame:
    """Columns doc_id, size, text_crc32, law, shard, slot and grown_shard.

    ``grown`` has the weights with one shard more; by default that shard has weight 1.
    """
    grown = grown or [*weights, 1.0]
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = numbered(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            shard_of(F.col("doc_id"), weights).cast("int").alias("shard"),
            shard_of(F.col("doc_id"), grown).cast("int").alias("grown_shard"),
        ),
        "shards",
    )
    return slots(placed).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
