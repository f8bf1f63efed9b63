"""What several operators share: words, rows with a number, running totals over all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dustline.sources.shared import staged

#: White space that parts words, and a word.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: The number of a row, see numbered().
ROW = "__row"
ROW_TYPE = "struct<file:bigint,row:bigint>"
#: Rows of a few numbers that make a file worth its while.
ROWS_OF_FILE = 100_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder, each row with a number of its own in ``__row``.

    Rows may be equal in all columns, so no key of theirs tells them apart. The numbers are
    written with the rows: a task that runs again reads the same ones.
    """
    return staged(df.drop(ROW).withColumn(ROW, row_of(F.lit(0), F.monotonically_increasing_id())), label)


def row_of(file: Column, row: Column) -> Column:
    """A row's number: that of its file, and its place there."""
    return F.struct(file.cast("long").alias("file"), row.cast("long").alias("row"))


def packed(docs: DataFrame, label: str, written: bool = False) -> DataFrame:
    """Each row of ``docs`` whole in ``__doc`` beside its number: no column's name clashes with
    those that an operator adds.

    The caller says whether ``docs`` is ``written``: a table as it was read from its files, perhaps
    with some rows or columns left out. Its rows have places there, which are their numbers. Rows
    of any other frame are written with theirs, as :func:`numbered` does.
    """
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("__doc")
    if written and "_metadata" not in docs.columns:
        file = F.xxhash64("_metadata.file_path")
        try:
            rows = docs.select(whole, row_of(file, F.col("_metadata.row_index")).alias(ROW))
        except AnalysisException:  # files of a format without places of rows
            return numbered(docs.select(whole), label)
        check_numbers(docs)
        return rows
    return numbered(docs.select(whole), label)


def check_numbers(docs: DataFrame) -> None:
    """Raise if two files of ``docs`` have one number. The driver knows their names anyway."""
    names = [(name,) for name in docs.inputFiles()]
    files = docs.sparkSession.createDataFrame(names, "name string")
    both = files.agg(F.count_distinct("name"), F.count_distinct(F.xxhash64("name"))).first()
    if both[0] != both[1]:
        raise ValueError("two files have the same number")


def files_for(rows: int) -> int:
    """Files that so many narrow rows need."""
    return max(1, -(-rows // ROWS_OF_FILE))


def staged_small(df: DataFrame, label: str, rows: int) -> DataFrame:
    """``df`` written in no more files than ``rows`` narrow rows need, the most it can have.

    Tables that a job writes in each of many steps may be tiny; what they cost is files.
    """
    return staged(df.coalesce(files_for(rows)), label)


def in_ranges(df: DataFrame, order: list[Column], label: str, rows: int) -> DataFrame:
    """``df`` written in ranges of ``order``, with the number of its range in ``__range``.

    Ranges hold about equal numbers of rows if ``order`` tells all rows apart. They are
    written, as their bounds come from a sample that a second run might draw otherwise.
    ``rows`` is the most that ``df`` can have.
    """
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    return staged_small(ranged, label, rows)


def range_starts(ranged: DataFrame, value: str) -> DataFrame:
    """What each range adds up to and what all ranges before it do: a row for each range."""
    sums = ranged.groupBy("__range").agg(F.sum(value).alias("__sum"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("__sum").over(before), F.lit(0).cast("long"))
    return sums.select("__range", "__sum", start.alias("__start"))


def running_total(
    df: DataFrame, order: list[Column], value: str, name: str, label: str, rows: int
) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows up to this one, in one order of all rows.

    No window spans all rows: the frame is cut into ranges, each range is summed, and a row
    gets the sum of the ranges before its own beside the running sum in its own. The only
    rows that meet in one task are one for each range, as many as there are partitions.
    ``rows`` is the most that ``df`` can have.
    """
    ranged = in_ranges(df, order, label, rows)
    starts = F.broadcast(range_starts(ranged, value).select("__range", "__start"))
    inside = Window.partitionBy("__range").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = (F.col("__start") + F.sum(value).over(inside)).alias(name)
    return ranged.join(starts, "__range").select(*df.columns, total)
