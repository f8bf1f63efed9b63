"""The two halves of the check of a single table."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dustline.functions.moments import cutoff
from dustline.functions.text import mention_pattern


def object_mentions(query_log: DataFrame, object_name: str, literal: bool = False) -> DataFrame:
    """When query text last mentioned the object, and how often: always one row."""
    pattern = mention_pattern(object_name, literal)
    return query_log.where(F.col("query_text").ilike(pattern)).agg(
        F.max("end_time").alias("last_usage"), F.count("*").alias("query_count")
    )


def stale_rows(
    target: DataFrame,
    interval: timedelta | str | Column,
    as_of: datetime | date | str | Column | None = None,
    column: str = "last_accessed_timestamp",
) -> DataFrame:
    """Rows last touched strictly before ``as_of - interval``."""
    stored_type = target.select(column).schema[0].dataType
    return target.where(F.col(column) < cutoff(as_of, interval, stored_type))
