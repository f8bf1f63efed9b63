"""Points in time and spans as Spark columns."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType


def moment(as_of: datetime | date | str | Column | None = None) -> Column:
    """The moment a report is asked for; now when none is given.

    Values go in as text and are cast by Spark, so a moment without an offset is
    read in the session time zone and never in that of the Python process.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    text = as_of if isinstance(as_of, str) else as_of.isoformat()
    return F.lit(text).cast("timestamp")


def span(interval: timedelta | str | Column) -> Column:
    """An interval given as ``timedelta`` or as SQL text (``90 days``)."""
    if isinstance(interval, Column):
        return interval
    if isinstance(interval, timedelta):
        return F.lit(interval)
    text = interval.strip()
    if text.lower().startswith("interval"):
        return F.expr(text)
    return F.expr("INTERVAL '{}'".format(text.strip("'")))


def cutoff(
    as_of: datetime | date | str | Column | None,
    interval: timedelta | str | Column,
    column_type: DataType,
) -> Column:
    """``as_of - interval`` as a value that ``column < cutoff`` can push to the scan.

    Comparing columns of two time types would cast the stored column and keep the
    filter out of the Parquet reader, so the constant is brought to the stored type.
    """
    limit = moment(as_of) - span(interval)
    if isinstance(column_type, TimestampNTZType):
        return limit.cast("timestamp_ntz")
    if isinstance(column_type, DateType):
        # A date stands for its midnight: it lies before the limit when it lies
        # before the first date that does not start earlier than the limit.
        return F.to_date(limit + F.lit(timedelta(days=1, microseconds=-1)))
    return limit


def days_between(earlier: Column, later: Column) -> Column:
    """Calendar-day boundaries crossed, in the session time zone."""
    return F.date_diff(later, earlier)
