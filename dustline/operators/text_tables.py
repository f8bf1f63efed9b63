"""All-text tables, and writing them."""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dustline.functions.names import quoted
from dustline.functions.text import NULL_TOKENS, field_count
from dustline.sources.csv_files import FILE, RAW, csv_pattern, qualified
from dustline.sources.csv_split import file_id

BROADCAST_NAMES = 100_000  # pairs of short names, some 20 MB


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, missing values as empty text."""
    return df.select(
        *[
            F.coalesce(F.col(quoted(name)).cast("string"), F.lit("")).alias(name)
            for name in df.columns
        ]
    )


def text_columns(
    records: DataFrame,
    names: Sequence[str],
    null_tokens: Sequence[str] = NULL_TOKENS,
    *more: str,
) -> DataFrame:
    """Records ``c0..`` under their names, null tokens and missing cells as empty text."""
    # One text for each cell, not a tree of calls: files may have hundreds of columns.
    tokens = ", ".join(literal(token) for token in null_tokens if token)
    kept = f"CASE WHEN {{0}} IN ({tokens}) THEN '' ELSE coalesce({{0}}, '') END"
    cell = kept if tokens else "coalesce({0}, '')"
    cells = [f"{cell.format(f'c{i}')} AS {quoted(name)}" for i, name in enumerate(names)]
    return records.selectExpr(*cells, quoted(RAW), *more)


def literal(text: str) -> str:
    """A text as SQL."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def too_long(width: int) -> Column:
    """Whether a record has more fields than the header."""
    raw = F.col(quoted(RAW))
    return raw.isNotNull() & (field_count(raw) > width)


def replace_table(
    spark: SparkSession, records: DataFrame, database: str, name: str, location: str | None
) -> int:
    """Write records as the table's new content and return their number.

    ``spark`` is the session whose table it is; the records may come from another.

    The rows go to a folder of their own and the table is pointed to it afterwards, so
    a load that fails, or finds a record with too many fields, leaves the old table as
    it is. Rows and faults are counted by the write itself.
    """
    columns = [column for column in records.columns if column not in (RAW, FILE)]
    faulty = too_long(len(columns)) if RAW in records.columns else F.lit(False)
    seen = Observation()
    rows = records.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(faulty, 1)).alias("faults"),
    ).select(*[quoted(column) for column in columns])
    path = new_content(spark, database, name, location)
    rows.write.parquet(path)
    counts = seen.get
    if counts["faults"]:
        raise ValueError(fault_text(counts["faults"], len(columns)))
    point_table(spark, database, name, path, rows.schema)
    return counts["rows"]


def replace_tables(
    spark: SparkSession,
    records: DataFrame,
    names: Sequence[str],
    tables: Mapping[str, str],
    database: str,
    location: str | None,
    parallel: int,
) -> dict[str, tuple[int | None, str | None]]:
    """:func:`replace_table` for many tables of the same columns, in one write.

    ``tables`` gives the table for each address of a file in the records. Returns rows and
    error by table; a table none of whose records is here is not in the result.
    """
    # Neither column can be one of the files', whose names have no hyphen.
    target = records.sparkSession.createDataFrame(
        list(tables.items()), "address string, `in-table` string"
    ).select(file_id(F.col("address")).alias(FILE), "`in-table`")
    if len(tables) <= BROADCAST_NAMES:
        target = F.broadcast(target)
    rows = records.join(target, FILE).select(
        *[quoted(name) for name in names], too_long(len(names)).alias("too-long"), "in-table"
    )
    path = new_content(spark, database, "together", location)
    rows.write.partitionBy("in-table").parquet(path)
    counts = (
        spark.read.schema("`too-long` boolean, `in-table` string")
        .parquet(path)
        .groupBy("in-table")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if("too-long").alias("faults"))
    )

    columns = rows.select(*[quoted(name) for name in names])

    def point(row: Row) -> tuple[str, tuple[int | None, str | None]]:
        if row["faults"]:
            return row["in-table"], (None, fault_text(row["faults"], len(names)))
        place = f"{path}/in-table={row['in-table']}"
        point_table(spark, database, row["in-table"], place, columns.schema)
        return row["in-table"], (row["rows"], None)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(pool.map(point, counts.collect()))


def new_content(spark: SparkSession, database: str, name: str, location: str | None) -> str:
    """A folder of its own for new content of a table."""
    base = location or spark.catalog.getDatabase(database).locationUri
    return f"{base.rstrip('/')}/{name}/{uuid.uuid4().hex}"


def point_table(
    spark: SparkSession, database: str, name: str, path: str, schema: StructType
) -> None:
    """Make the table, new or old, the one whose content is at the path.

    A table of the same columns changes its place in one step and is there all the time. One
    of other columns is dropped and made anew; in between readers do not find it.
    """
    full_name = quoted(database, name)
    if spark.catalog.tableExists(full_name):
        same = [(f.name, f.dataType) for f in spark.table(full_name).schema]
        if same == [(f.name, f.dataType) for f in schema] and _is_external_parquet(_described(spark, full_name)):
            spark.sql(f"ALTER TABLE {full_name} SET LOCATION {literal(path)}")
            spark.catalog.refreshTable(full_name)
            return
        spark.sql(f"DROP TABLE {full_name}")
    spark.catalog.createTable(full_name, path=path, source="parquet", schema=schema)


def _described(spark: SparkSession, full_name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name}").collect()
    return {row["col_name"]: row["data_type"] for row in rows}


def _is_external_parquet(said: Mapping[str, str]) -> bool:
    return said.get("Type") == "EXTERNAL" and said.get("Provider", "").lower() == "parquet"


def read_tables(
    spark: SparkSession, database: str, names: Sequence[str], column: str = "table", parallel: int = 8
) -> DataFrame:
    """The rows of many tables written here, with the name of each row's table in ``column``.

    All tables of the same columns are one scan, in which a task reads many small files. In a union of
    them each task reports on every table, so what the driver gets grows with their square.
    """
    if not names:
        raise ValueError("no table to read")
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        found = list(pool.map(lambda name: _columns_and_place(spark, quoted(database, name)), names))
    alike: dict[str, list[tuple[str, str]]] = {}
    for name, (columns, place) in zip(names, found, strict=True):
        alike.setdefault(columns, []).append((place, name))
    scans = [_scan_places(spark, columns, places, column) for columns, places in alike.items()]
    return functools.reduce(DataFrame.unionByName, scans)


def _columns_and_place(spark: SparkSession, full_name: str) -> tuple[str, str]:
    """The columns of a table, as SQL, and the full path of its content."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name}").collect()
    said = [(row["col_name"], row["data_type"]) for row in rows]
    if not _is_external_parquet(dict(said)):
        raise ValueError(f"not a table written here: {full_name}")
    # The columns come first, up to a row without a name.
    columns = said[: [name for name, _ in said].index("")]
    return ", ".join(f"{quoted(name)} {kind}" for name, kind in columns), qualified(spark, dict(said)["Location"])


def _scan_places(
    spark: SparkSession, columns: str, places: Sequence[tuple[str, str]], column: str
) -> DataFrame:
    """The rows at many places, with the name that belongs to each place."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    # Files tell their address, whose odd characters are escaped. No column of a table has a hyphen.
    named = [(path(place).toUri().toString(), name) for place, name in places]
    named = spark.createDataFrame(named, "`in-folder` string, `in-table` string")
    if len(places) <= BROADCAST_NAMES:
        named = F.broadcast(named)
    address = F.col("_metadata.file_path")
    folder = F.left(address, F.length(address) - F.length(F.substring_index(address, "/", -1)) - 1)
    patterns = [csv_pattern(place) for place in dict.fromkeys(place for place, _ in places)]
    rows = spark.read.schema(columns).parquet(*patterns).select("*", folder.alias("in-folder"))
    unknown = F.raise_error(F.concat(F.lit("no table at "), "`in-folder`")).cast("string")
    rows = rows.join(named, "in-folder", "left").withColumn(column, F.coalesce("`in-table`", unknown))
    return rows.drop("in-folder", "in-table")


def remove_superseded(
    spark: SparkSession, database: str, name: str, location: str | None = None
) -> list[str]:
    """Remove the folders of content that the table had before, and return them.

    For tables written one by one, and when nobody reads the old content any more.
    """
    base = location or spark.catalog.getDatabase(database).locationUri
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}")
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    current = _described(spark, quoted(database, name))["Location"].rstrip("/")
    if not files.exists(folder):
        return []
    gone = []
    for entry in files.listStatus(folder):
        path = entry.getPath()
        is_content = re.fullmatch("[0-9a-f]{32}", path.getName())
        if entry.isDirectory() and is_content and path.getName() not in current.split("/"):
            files.delete(path, True)
            gone.append(path.toString())
    return gone


def fault_text(faults: int, width: int) -> str:
    return f"{faults} records with more than {width} fields"


def export_csv(df: DataFrame, path: str) -> None:
    """Write as CSV with header, replacing an earlier export; cells keep their blanks."""
    (
        df.write.mode("overwrite")
        .options(
            header=True,
            quote='"',
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )
