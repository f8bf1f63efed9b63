"""Files in, all-text tables out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dustline.functions.names import column_names, first_clash, quoted, table_name
from dustline.functions.text import NULL_TOKENS, csv_line
from dustline.operators.inference import infer_types, spell_as
from dustline.operators.text_tables import (
    RAW,
    as_text,
    export_csv,
    replace_table,
    replace_tables,
    text_columns,
)
from dustline.sources.csv_files import (
    FILE,
    CsvSource,
    csv_source,
    list_csv,
    read_head,
    read_heads,
    read_records,
    whole_bytes,
)
from dustline.sources.shared import staged
from dustline.sources.workbooks import combined_sheets, scan_workbooks, sheet_rows

STATUS = "path string, table string, rows long, error string"


def read_csv_text(
    spark: SparkSession,
    path: str | CsvSource,
    null_tokens: Sequence[str] = NULL_TOKENS,
    split_bytes: int | None = None,
    infer: bool = False,
) -> DataFrame:
    """A CSV file as text columns with clean names, plus the text of misfit records.

    That last column, ``raw-record``, is null for records that fit (see ``read_records``).
    With ``infer`` each column has a type first, found by a scan of its own, and cells are
    spelled as values of that type (see ``operators.inference``).
    """
    source = path if isinstance(path, CsvSource) else csv_source(spark, path)
    return _text(spark, source, read_head(spark, source), null_tokens, split_bytes, infer)


def _text(
    spark: SparkSession,
    source: CsvSource,
    head: Sequence[str],
    null_tokens: Sequence[str],
    split_bytes: int | None,
    infer: bool,
) -> DataFrame:
    names = column_names(head)
    text = text_columns(read_records(spark, source, len(names), split_bytes), names, null_tokens)
    return spell_as(text, infer_types(text, names)) if infer else text


def ingest_folder(
    spark: SparkSession,
    folder: str,
    database: str,
    location: str | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    split_bytes: int | None = None,
    parallel: int = 8,
    infer: bool = False,
) -> DataFrame:
    """Every ``.csv`` of a folder becomes its own all-text table.

    Returns one row per file: path, table, rows, error. A file that cannot be loaded is
    reported and the others go on. Two files that would be one table, or one that would be a
    table without a name, stop the run before anything is written. One job reads all
    headers, and files with the same header that are a task's work each are loaded together
    in another; a larger file is a job of its own, of which ``parallel`` are submitted at a time.
    With ``infer`` every file is, as it has types of its own (see ``read_csv_text``).
    """
    listed = list_csv(spark, folder)
    clash = first_clash(table_name(source.name) for source in listed)
    if clash is not None:
        raise ValueError(f"files collide in table {clash}")
    sources = {table_name(source.name): source for source in listed}
    if "" in sources:
        raise ValueError(f"no table name in {sources[''].path}")
    heads = read_heads(spark, listed)

    def alone(table: str) -> tuple[int | None, str | None]:
        try:
            source = sources[table]
            if source.path not in heads:
                raise ValueError("no header")
            records = _text(spark, source, heads[source.path], null_tokens, split_bytes, infer)
            return replace_table(spark, records, database, table, location), None
        except (PySparkException, Py4JJavaError, ValueError) as problem:
            return None, _first_line(problem)

    def together(
        group: tuple[tuple[str, ...], Sequence[str]],
    ) -> dict[str, tuple[int | None, str | None]]:
        head, tables = group
        try:
            names = column_names(head)
            records = read_records(spark, [sources[table] for table in tables], len(names))
            by_address = {a: table for table in tables for a in sources[table].addresses}
            text = text_columns(records, names, null_tokens, quoted(FILE))
            return replace_tables(spark, text, names, by_address, database, location, parallel)
        except (PySparkException, Py4JJavaError, ValueError):
            return {}  # each is tried alone, and the one at fault reported

    status: dict[str, tuple[int | None, str | None]] = {}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        alike = {} if infer else _alike(spark, sources, heads, split_bytes)
        for loaded in pool.map(together, alike.items()):
            status |= loaded
        rest = [table for table in sources if table not in status]
        status |= dict(zip(rest, pool.map(alone, rest)))
    rows = [(source.path, table, *status[table]) for table, source in sources.items()]
    return spark.createDataFrame(rows, STATUS)


def _alike(
    spark: SparkSession,
    sources: Mapping[str, CsvSource],
    heads: Mapping[str, tuple[str, ...]],
    split_bytes: int | None,
) -> dict[tuple[str, ...], list[str]]:
    """Tables of files that are a task's work each by their header, where several share it."""
    most = whole_bytes(spark) if split_bytes is None else split_bytes
    groups: dict[tuple[str, ...], list[str]] = {}
    for table, source in sources.items():
        if source.path in heads and source.largest <= most:
            groups.setdefault(heads[source.path], []).append(table)
    return {head: tables for head, tables in groups.items() if len(tables) > 1}


def _first_line(problem: Exception) -> str:
    cause = problem.java_exception.toString() if isinstance(problem, Py4JJavaError) else problem
    return str(cause).strip().split("\n")[0]


def save_as_text(
    df: DataFrame, table: str, database: str, location: str | None = None
) -> DataFrame:
    """Create or replace an all-text table from any DataFrame, with clean column names.

    Missing values become empty text.
    """
    text = as_text(df.toDF(*column_names(df.columns)))
    replace_table(df.sparkSession, text, database, table, location)
    return df.sparkSession.table(quoted(database, table))


def positional_load(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    table: str,
    database: str,
    location: str | None = None,
    split_bytes: int | None = None,
) -> DataFrame:
    """Load a CSV by position into a table of named text columns.

    The header line is skipped, whatever it says; an empty field is null. A record
    with more fields than columns fails the load and leaves the old table.
    """
    source = csv_source(spark, path)
    records = read_records(spark, source, len(columns), split_bytes)
    named = records.select(
        *[F.nullif(F.col(f"c{i}"), F.lit("")).alias(c) for i, c in enumerate(columns)], quoted(RAW)
    )
    replace_table(spark, named, database, table, location)
    return spark.table(quoted(database, table))


def ingest_workbooks(spark: SparkSession, path: str, out: str) -> DataFrame:
    """The first sheet of every workbook below ``path`` becomes a CSV in folder ``out``.

    Returns one row per workbook: path, csv, rows, error. A workbook that cannot be read
    is reported and skipped. Of workbooks with the same base name the last by path is
    kept, as if they were written one after the other. Other files in ``out`` stay. Each
    CSV is a folder ``file=NAME.csv``, which ``ingest_folder`` reads as ``NAME.csv``.
    """
    rows = staged(sheet_rows(scan_workbooks(spark, path)), "sheet-rows")
    base_name = F.regexp_extract("path", r"([^/]*)$", 1)
    books = rows.groupBy("path").agg(
        F.max("error").alias("error"), F.count(F.when(F.col("row") > 0, 1)).alias("rows")
    )
    books = staged(
        books.withColumn("csv", F.concat(F.regexp_replace(base_name, r"\.[^.]*$", ""), F.lit(".csv"))),
        "workbooks",
    )
    kept = books.where(F.col("error").isNull()).groupBy("csv").agg(F.max("path").alias("path"))
    # A workbook has a bounded number of rows, so all of one file may share a task,
    # which keeps the header first and the rows in order.
    (
        rows.join(kept, "path")
        .select(F.col("csv").alias("file"), "row", csv_line(F.col("cells")).alias("value"))
        .repartition("file")
        .sortWithinPartitions("file", "row")
        .select("value", "file")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("file")
        .text(out)
    )
    replaced = F.when(
        F.col("kept") != F.col("path"), F.concat(F.lit("replaced by "), F.col("kept"))
    )
    return books.join(kept.withColumnRenamed("path", "kept"), "csv", "left").select(
        "path", "csv", "rows", F.coalesce("error", replaced).alias("error")
    )


def combine_workbook(
    spark: SparkSession, path: str, out: str, null_tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame:
    """All sheets of a workbook, cleaned and under each other, written as one CSV.

    Returns the combined sheets; ``out`` is replaced.
    """
    combined = combined_sheets(spark, path, null_tokens)
    export_csv(combined, out)
    return combined
