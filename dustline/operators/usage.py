"""Usage of objects by users, from an access history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIR = ("base_object_name", "user_name")


def _pair() -> list[Column]:
    return [F.col(name).alias(name) for name in PAIR]


def object_usage(history: DataFrame, ddl_only: bool = True) -> DataFrame:
    """Last usage and number of uses of each (object, user) pair.

    Rows without a user do not count, nor, with ``ddl_only``, rows that changed no
    object. A missing object name is a pair of its own. Both tests reach the scan, and
    partial aggregates leave one row per pair and task to shuffle, however hot the pair.
    """
    counted = F.col("user_name").isNotNull()
    if ddl_only:
        counted &= F.col("object_modified_by_ddl").isNotNull()
    return (
        history.where(counted)
        .groupBy(*_pair())
        .agg(F.max("query_start_time").alias("last_usage"), F.count("*").alias("usage_count"))
    )


def usage_with_fan_out(history: DataFrame, ddl_only: bool = True) -> DataFrame:
    """:func:`object_usage` and how many history rows a left join on the pair meets.

    A pair meets every history row with its names, also rows that do not count as use;
    a pair without an object name meets none and is kept once by the join. Counting in
    the same aggregate gives the join's multiplicity from one scan and no join.
    """
    is_use = F.col("object_modified_by_ddl").isNotNull() if ddl_only else F.lit(True)
    met = F.when(F.col("base_object_name").isNull(), F.lit(1)).otherwise(F.col("rows_of_pair"))
    return (
        history.where(F.col("user_name").isNotNull())
        .groupBy(*_pair())
        .agg(
            F.max(F.when(is_use, F.col("query_start_time"))).alias("last_usage"),
            F.count(F.when(is_use, 1)).alias("usage_count"),
            F.count("*").alias("rows_of_pair"),
        )
        .where(F.col("usage_count") > 0)
        .select(*PAIR, "last_usage", "usage_count", met.alias("fan_out"))
    )


def repeat_rows(df: DataFrame, times: str, block: int = 100_000) -> DataFrame:
    """Every row as often as its column ``times`` says; the column is dropped.

    Done in two steps so that one row with a huge count is not one task's work: a row
    becomes one row per ``block`` copies, these are spread over the cluster, and each
    then becomes its copies. The number of shuffle partitions is spelled out because
    the rows are tiny before they are copied, and adaptive execution would otherwise
    put them all into one partition.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [name for name in df.columns if name != times]
    count = F.col(times)
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((count - 1) / block))
    copies = F.least(F.lit(block), count - F.col("_block") * block).cast("int")
    return (
        df.where(count > 0)
        .select(*df.columns, F.explode(blocks).alias("_block"))
        .repartition(partitions, *columns, "_block")
        .select(*columns, F.explode(F.array_repeat(F.lit(True), copies)).alias("_copy"))
        .select(*columns)
    )
