"""Inputs for the registered queries, derived by Spark from the given tables.

The audit and the ingest read relations the given tables do not contain: an access
history, a query log, CSV files, workbooks. Each is made from whole tables, so the work
of every query grows with them. Files go to the shared folder of the session.
"""

from __future__ import annotations

import io
import re
import sys
import tempfile
import zipfile
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from dustline.operators.text_tables import export_csv
from dustline.sources.shared import new_folder
from dustline.sources.tables import ACCESS_HISTORY

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Access history: every event is a query. Some rows lack a user, an object or a change;
# half of the users are not seen after 19 January. The columns no report reads hold
# values of their own, so that a column in the wrong place shows.
HISTORY_COLUMNS = {
    "QUERY_ID": "CAST(event_id AS STRING)",
    "QUERY_START_TIME": "ts",
    "USER_NAME": """CASE WHEN user_id % 11 <> 0
        AND (ts < TIMESTAMP '2024-01-20 00:00:00' OR user_id % 20 < 10)
        THEN concat('U', CAST(user_id % 20 AS STRING)) END""",
    "OBJECT_MODIFIED_BY_DDL": "CASE WHEN event_id % 3 = 0 THEN props END",
    "BASE_OBJECT_NAME": "CASE WHEN event_id % 7 <> 0 THEN event_type END",
}


def _carried(place: int, field: StructField) -> str:
    if field.dataType == LongType():
        return f"event_id * 100 + {place}"
    return f"concat('{field.name} of ', CAST(event_id AS STRING))"


HISTORY_SQL = "SELECT {} FROM events".format(
    ", ".join(
        f"{HISTORY_COLUMNS.get(field.name) or _carried(place, field)} AS {field.name}"
        for place, field in enumerate(ACCESS_HISTORY)
    )
)
QUERY_LOG_SQL = """
    SELECT concat('select * from {}.', upper(event_type), ' where u=', CAST(user_id AS STRING))
               AS query_text,
           ts AS end_time
    FROM events
"""
AUDITED_SQL = "SELECT o_orderdate AS last_accessed_timestamp FROM orders"


# The usage report as a join: a pair once per history row with the same names. {days} counts
# the days from last_usage to the moment asked for.
UNUSED_SQL = """
    SELECT used.base_object_name AS base_object_name, used.user_name AS user_name,
           used.last_usage AS last_usage, used.usage_count AS usage_count
    FROM (
        SELECT base_object_name, user_name, max(query_start_time) AS last_usage,
               count(*) AS usage_count
        FROM {history}
        WHERE user_name IS NOT NULL AND object_modified_by_ddl IS NOT NULL
        GROUP BY base_object_name, user_name) AS used
    LEFT JOIN {history} AS rows_of_pair USING (base_object_name, user_name)
    WHERE {days} > 90
"""


def ready(spark: SparkSession) -> SparkSession:
    """A session of one machine that names no shared folder, as in tests, gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and re.match(r"local(\[|$)", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dustline-"))
    return spark


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The relation of one of the texts above."""
    table = sql.split("FROM ")[-1].split()[0]
    return spark.sql(
        sql.replace(f"FROM {table}", "FROM {given}"), given=given(spark, sf_dir, table)
    )


def run_database(spark: SparkSession) -> str:
    """A database of this run's own, kept in the shared folder."""
    folder = new_folder(spark, "database")
    name = "dustline_" + folder.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    return name


def csv_folder(spark: SparkSession, exports: Mapping[str, DataFrame]) -> str:
    """A folder with one CSV per table."""
    folder = new_folder(spark, "csv")
    for name, df in exports.items():
        export_csv(df, f"{folder}/{name}")
    return folder


FILE_ROWS = 4_000


def csv_lines(lines: DataFrame, header: str, path: str) -> None:
    """A CSV as a folder of part files from ``lines`` (key, line), each line with its end.

    Of every file the header is the first line; ``header`` has its end, too. Files hold ranges
    of the key in folders of their own, so all parts have the same name.
    """
    ranges = lines.withColumn("part", F.floor(F.col("key") / FILE_ROWS))
    heads = ranges.select("part").distinct().select(
        F.lit(-1).cast("long").alias("key"), F.lit(header).alias("line"), "part"
    )
    (
        ranges.unionByName(heads)
        .repartition("part")
        .sortWithinPartitions("part", "key")
        .select(F.expr("left(line, length(line) - 1)").alias("value"), "part")
        .write.partitionBy("part")
        .text(path)
    )


BOOK_ROWS = 5_000


def workbook_folder(
    df: DataFrame, sheets: Mapping[str, Sequence[str]], key: str, damaged: bool = False
) -> str:
    """A folder of workbooks that together hold ``df``, one per range of a unique key.

    Each sheet holds the named columns. The name and the content of a workbook depend on
    its range only, so a task that runs again writes the same files again. With ``damaged``
    there is a copy of each workbook that ends halfway.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folder = new_folder(df.sparkSession, "workbooks")
    place = folder.removeprefix("file://").removeprefix("file:").replace("s3a://", "s3://")

    def write(table: pa.Table) -> pa.Table:
        files, root = pyarrow.fs.FileSystem.from_uri(place)
        files.create_dir(root, recursive=True)
        rows = table.sort_by(key).to_pylist()
        book = {
            sheet: [list(columns)] + [[row[c] for c in columns] for row in rows]
            for sheet, columns in sheets.items()
        }
        with files.open_output_stream(f"{root}/book {rows[0]['book']}.xlsx") as stream:
            stream.write(content := workbook_bytes(book))
        if damaged:
            with files.open_output_stream(f"{root}/damaged {rows[0]['book']}.xlsx") as stream:
                stream.write(content[: len(content) // 2])
        return pa.table({"n": pa.array([len(rows)], pa.int64())})

    books = df.withColumn("book", F.floor(F.col(key) / BOOK_ROWS)).repartition(partitions, "book")
    books.groupBy("book").applyInArrow(write, "n long").agg(F.sum("n")).collect()
    return folder


MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def workbook_bytes(sheets: Mapping[str, Sequence[Sequence]]) -> bytes:
    """A small workbook. Texts are shared strings on even columns, inline on odd ones."""
    shared: dict[str, int] = {}

    def cell(row: int, column: int, value) -> str:
        letters, rest = "", column + 1
        while rest:
            rest, digit = divmod(rest - 1, 26)
            letters = chr(ord("A") + digit) + letters
        place = f'r="{letters}{row + 1}"'
        if value is None:
            return ""
        if isinstance(value, bool):
            return f'<c {place} t="b"><v>{int(value)}</v></c>'
        if isinstance(value, datetime):
            days = (value - datetime(1899, 12, 30)).total_seconds() / 86_400
            return f'<c {place} s="1"><v>{days!r}</v></c>'
        if isinstance(value, date):
            return f'<c {place} s="1"><v>{(value - date(1899, 12, 30)).days}</v></c>'
        if isinstance(value, (int, float)):
            return f"<c {place}><v>{value!r}</v></c>"
        if column % 2:
            text = f'<t xml:space="preserve">{escape(value)}</t>'
            return f'<c {place} t="inlineStr"><is>{text}</is></c>'
        return f'<c {place} t="s"><v>{shared.setdefault(value, len(shared))}</v></c>'

    parts = {}
    for number, rows in enumerate(sheets.values(), 1):
        lines = [
            f'<row r="{r + 1}">{"".join(cell(r, c, v) for c, v in enumerate(row))}</row>'
            for r, row in enumerate(rows)
            if any(v is not None for v in row)
        ]
        data = f"<sheetData>{''.join(lines)}</sheetData>"
        parts[f"xl/worksheets/sheet{number}.xml"] = f'<worksheet xmlns="{MAIN}">{data}</worksheet>'
    links = [
        (f"s{n}", "worksheet", f"worksheets/sheet{n}.xml") for n in range(1, len(sheets) + 1)
    ] + [("t", "sharedStrings", "sharedStrings.xml"), ("f", "styles", "styles.xml")]
    named = "".join(
        f'<sheet name={quoteattr(name)} sheetId="{n}" r:id="s{n}"/>'
        for n, name in enumerate(sheets, 1)
    )
    texts = "".join(f'<si><t xml:space="preserve">{escape(text)}</t></si>' for text in shared)
    parts |= {
        "_rels/.rels": _links([("d", "officeDocument", "xl/workbook.xml")]),
        "xl/_rels/workbook.xml.rels": _links(links),
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{OFFICE}">'
        f"<sheets>{named}</sheets></workbook>",
        "xl/sharedStrings.xml": f'<sst xmlns="{MAIN}">{texts}</sst>',
        "xl/styles.xml": f'<styleSheet xmlns="{MAIN}"><numFmts count="1">'
        '<numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/></numFmts>'
        '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>',
    }
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in parts.items():
            archive.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + text)
    return packed.getvalue()


def _links(links: Sequence[tuple[str, str, str]]) -> str:
    each = "".join(
        f'<Relationship Id="{name}" Type="{OFFICE}/{kind}" Target="{target}"/>'
        for name, kind, target in links
    )
    return f'<Relationships xmlns="{PACKAGE}">{each}</Relationships>'
