"""The usage reports."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dustline.functions.moments import days_between, moment
from dustline.operators.checks import object_mentions, stale_rows
from dustline.operators.mentions import all_object_mentions
from dustline.operators.usage import object_usage, repeat_rows, usage_with_fan_out
from dustline.sources.tables import table

Moment = datetime | date | str | Column | None


def unused_objects(
    history: DataFrame,
    as_of: Moment = None,
    days: int = 90,
    multiplicity: str = "rows",
    ddl_only: bool = True,
) -> DataFrame:
    """Pairs whose last usage lies more than ``days`` calendar days before ``as_of``.

    ``multiplicity`` says how often a pair is reported: ``"rows"`` once per history row
    with the same names (what a left join back to the history yields), ``"count"`` once
    with that number as ``fan_out``, ``"distinct"`` once.
    """
    if multiplicity == "distinct":
        usage = object_usage(history, ddl_only)
        return usage.where(days_between(F.col("last_usage"), moment(as_of)) > days)
    return report_unused(usage_with_fan_out(history, ddl_only), as_of, days, multiplicity)


def report_unused(counted: DataFrame, as_of: Moment, days: int, multiplicity: str) -> DataFrame:
    """The report on pairs whose usage, and ``fan_out``, are known."""
    unused = counted.where(days_between(F.col("last_usage"), moment(as_of)) > days)
    if multiplicity == "distinct":
        return unused.drop("fan_out")
    if multiplicity == "count":
        return unused
    if multiplicity == "rows":
        return repeat_rows(unused, "fan_out")
    raise ValueError(f"multiplicity must be rows, count or distinct, not {multiplicity!r}")


def data_check(
    query_log: DataFrame,
    target: DataFrame,
    object_name: str,
    interval: timedelta | str | Column,
    as_of: Moment = None,
    literal: bool = False,
) -> DataFrame:
    """Last mention, number of mentions and number of stale rows of one table.

    No row when no row of the table is stale. Each side is counted in its own scan;
    the two one-row results are added up, so nothing is joined.
    """
    mentions = object_mentions(query_log, object_name, literal).select(
        "last_usage", "query_count", F.lit(0).cast("long").alias("unused_data_count")
    )
    stale = stale_rows(target, interval, as_of).agg(F.count("*").alias("unused_data_count"))
    # Of the log's own type: widening a zoneless time would move it.
    kind = mentions.schema["last_usage"].dataType
    stale = stale.select(
        F.lit(None).cast(kind).alias("last_usage"),
        F.lit(0).cast("long").alias("query_count"),
        "unused_data_count",
    )
    return (
        mentions.unionByName(stale)
        .agg(
            F.max("last_usage").alias("last_usage"),
            F.sum("query_count").alias("query_count"),
            F.sum("unused_data_count").alias("unused_data_count"),
        )
        .where(F.col("unused_data_count") > 0)
    )


def check_table(
    spark: SparkSession,
    query_log: DataFrame,
    database: str,
    schema: str,
    object_name: str,
    interval: timedelta | str | Column,
    as_of: Moment = None,
    literal: bool = False,
) -> DataFrame:
    """:func:`data_check` of a catalog table named by database, schema and object."""
    full_name = f"{database}.{schema}.{object_name}"
    target = table(spark, object_name, schema, database)
    return data_check(query_log, target, full_name, interval, as_of, literal)


def data_check_all(
    query_log: DataFrame,
    targets: Mapping[str, DataFrame],
    interval: timedelta | str | Column,
    as_of: Moment = None,
    literal: bool = False,
) -> DataFrame:
    """:func:`data_check` of many tables, given by full name: object_name and its three numbers.

    One scan of the log for all of them, and one of each table. No row for a table without a stale row.
    """
    if not targets:
        raise ValueError("no table to check")
    counts = [
        stale_rows(target, interval, as_of)
        .agg(F.count("*").alias("unused_data_count"))
        .withColumn("object_name", F.lit(name))
        for name, target in targets.items()
    ]
    stale = reduce(DataFrame.unionByName, counts).where(F.col("unused_data_count") > 0)
    mentions = all_object_mentions(query_log, list(targets), literal)
    return mentions.join(stale, "object_name").select(
        "object_name", "last_usage", "query_count", "unused_data_count"
    )
