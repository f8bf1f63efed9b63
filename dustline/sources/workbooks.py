"""Spreadsheet workbooks (``.xlsx``) as Spark rows.

Spark lists the files and hands their bytes to tasks; a small reader in the task turns
the cells of each sheet into rows of text.
"""

from __future__ import annotations

import posixpath
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dustline.functions import names
from dustline.functions.names import quoted, unique_header
from dustline.functions.text import NULL_TOKENS, null_if_token
from dustline.sources.shared import staged

# Tasks get this code with the job, so executors need not have the package installed.
for _module in (__name__, names.__name__):
    cloudpickle.register_pickle_by_value(sys.modules[_module])

SHEET_ROWS = "path string, sheet string, sheet_no int, row int, cells array<string>, error string"
BATCH_ROWS = 5_000
HELD_CELLS = 2_000_000  # per workbook

# Fixed values of the file format: built-in number formats that are dates or times,
# what makes a custom format one, and day 0 of the two calendars.
DATE_FORMATS = frozenset([*range(14, 23), *range(45, 48)])
FORMAT_NOISE = re.compile(r'"[^"]*"|\\.|_.|\*.|\[(?!hh?\]|mm?\]|ss?\])[^\]]*\]')
DATE_LETTERS = re.compile("[dmyhs]", re.IGNORECASE)
ELAPSED = re.compile(r"\[(hh?|mm?|ss?)\]", re.IGNORECASE)
DIGITS = "0123456789"
DAY_ZERO = {False: datetime(1899, 12, 30), True: datetime(1904, 1, 1)}


def scan_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """All workbooks below a folder, or the one at a path: path, time, length, content.

    Columns that are not selected are not read, so a listing reads no content.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.xlsx")
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def sheet_rows(workbooks: DataFrame, first_only: bool = True) -> DataFrame:
    """Rows of the sheets: row 0 is the header, data rows follow, cells are text or null.

    A workbook that cannot be read gives one row with its ``error``. Rows of a sheet all
    have as many cells as its header. Spark packs workbooks into tasks by their size,
    so a task holds one split's worth of workbooks, or a single larger one.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                yield from _workbook_batches(path.as_py(), content.as_buffer(), first_only)

    return workbooks.select("path", "content").mapInArrow(parse, SHEET_ROWS)


def first_sheet(
    spark: SparkSession, path: str, null_tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame:
    """The first sheet of a workbook, or of all workbooks of one layout, as a table."""
    rows = _readable(staged(sheet_rows(scan_workbooks(spark, path)), "first-sheet"))
    return _as_table(rows, _one_header(rows), null_tokens)


def all_sheets(
    spark: SparkSession, path: str, null_tokens: Sequence[str] = NULL_TOKENS
) -> dict[str, DataFrame]:
    """Every sheet of a workbook by name, in order; same-named sheets are stacked.

    One job reads the workbooks and one finds all headers, however many sheets there are.
    """
    rows = sheets_of(spark, path)
    return {
        sheet: _as_table(rows.where(F.col("sheet") == sheet), header, null_tokens)
        for sheet, header in sheet_headers(rows).items()
    }


def combined_sheets(
    spark: SparkSession, path: str, null_tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame:
    """All sheets without empty rows and columns, one under the other by column name.

    The columns that hold a value are found for all sheets in one job, and one scan gives the
    result: a map says for each column where it stands in a sheet.
    """
    rows = sheets_of(spark, path)
    headers = sheet_headers(rows)
    data = rows.where(F.col("row") > 0).withColumn(
        "cells", F.transform("cells", lambda cell: null_if_token(cell, null_tokens))
    )
    filled = data.select("sheet", F.posexplode("cells").alias("place", "cell"))
    filled = filled.where(F.col("cell").isNotNull()).select("sheet", "place").distinct()
    # As many rows as the sheets have columns.
    used = {(row["sheet"], row["place"]) for row in filled.collect()}
    columns: dict[str, tuple[str, dict[str, int]]] = {}
    for sheet, header in headers.items():
        for place, name in enumerate(header):
            if (sheet, place) in used:
                _, places = columns.setdefault(name.lower(), (name, {}))
                if sheet in places:
                    raise ValueError(f"columns collide in sheet {sheet}: {name}")
                places[sheet] = place
    data = data.where(F.exists("cells", lambda cell: cell.isNotNull()))

    def cell_of(places: dict[str, int]) -> Column:
        entries = [F.lit(x) for sheet, place in places.items() for x in (sheet, place)]
        return F.get("cells", F.create_map(*entries)[F.col("sheet")])

    return data.select(*[cell_of(places).alias(name) for name, places in columns.values()])


def sheets_of(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all sheets, written so that a sheet is read without the others."""
    return _readable(
        staged(sheet_rows(scan_workbooks(spark, path), False), "all-sheets", ["sheet"])
    )


def sheet_headers(rows: DataFrame) -> dict[str, list[str]]:
    """The header of every sheet, in order of the sheets."""
    heads = rows.where(F.col("row") == 0).groupBy("sheet")
    heads = heads.agg(
        F.min("sheet_no").alias("at"), F.min("cells").alias("cells"), F.max("cells").alias("last")
    )
    found = sorted(heads.collect(), key=lambda row: (row["at"], row["sheet"]))
    for row in found:
        if row["cells"] != row["last"]:
            raise ValueError(f"sheets differ in their header: {row['sheet']}")
    return {row["sheet"]: row["cells"] for row in found}


def _readable(rows: DataFrame) -> DataFrame:
    broken = rows.where(F.col("error").isNotNull()).first()
    if broken:
        raise ValueError(f"{broken['path']}: {broken['error']}")
    return rows


def _one_header(rows: DataFrame) -> list[str]:
    headers = rows.where(F.col("row") == 0).select("cells").distinct().take(2)
    if len(headers) != 1:
        raise ValueError("no sheet found" if not headers else "sheets differ in their header")
    return headers[0]["cells"]


def _as_table(rows: DataFrame, header: Sequence[str], null_tokens: Sequence[str]) -> DataFrame:
    data = rows.where(F.col("row") > 0)
    cells = [F.element_at("cells", i + 1) for i in range(len(header))]
    return data.select(
        *[null_if_token(cell, null_tokens).alias(name) for cell, name in zip(cells, header)]
    )


def _workbook_batches(path: str, content, first_only: bool) -> Iterator[pa.RecordBatch]:
    def batch(sheet, number, rows, cells, error=None):
        count = len(rows)
        columns = [[path] * count, [sheet] * count, [number] * count, rows, cells, [error] * count]
        types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.string()]
        fields = ["path", "sheet", "sheet_no", "row", "cells", "error"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], fields)

    def batches(book, sheet, number, part, extent, kept):
        rows, cells = [], []
        for row, values in book.filled_rows(part, *extent, kept):
            rows.append(row)
            cells.append(unique_header(values) if row == 0 else values)
            if len(rows) == BATCH_ROWS:
                yield batch(sheet, number, rows, cells)
                rows, cells = [], []
        yield batch(sheet, number, rows, cells)

    try:
        with zipfile.ZipFile(pa.BufferReader(content)) as archive:
            book = _Workbook(archive)
            # All sheets are read before any row goes out: a bad one spoils the workbook.
            sheets = [
                (sheet, number, part, *book.measure(part))
                for number, (sheet, part) in enumerate(book.sheets[: 1 if first_only else None])
            ]
            for sheet in sheets:
                yield from batches(book, *sheet)
    except Exception as problem:  # whatever is wrong with it is reported, not raised
        yield batch(None, None, [None], [None], f"{type(problem).__name__}: {problem}")


class _Workbook:
    """Cell values of an open workbook. Sheets are streamed; small ones are also held."""

    def __init__(self, archive: zipfile.ZipFile):
        self.archive = archive
        self.room = HELD_CELLS
        self.columns: dict[str, int] = {}
        root = next(
            target
            for kind, target in self._links("", "").values()
            if kind.endswith("/officeDocument")
        )
        links = self._links(posixpath.dirname(root), posixpath.basename(root))
        self.sheets, epoch_1904 = [], False
        for tag, node in self._nodes(root):
            if tag == "sheet":
                link = next(v for k, v in node.attrib.items() if k.endswith("}id"))
                kind, target = links[link]
                if kind.endswith("/worksheet"):
                    self.sheets.append((node.get("name"), target))
            elif tag == "workbookPr":
                epoch_1904 = node.get("date1904") in ("1", "true")
        if not self.sheets:
            raise ValueError("workbook has no worksheet")
        self.day_zero = DAY_ZERO[epoch_1904]
        parts = {kind.rsplit("/", 1)[1]: target for kind, target in links.values()}
        self.shared = self._shared_strings(parts.get("sharedStrings"))
        self.formats = self._cell_formats(parts.get("styles"))

    def _links(self, folder: str, name: str) -> dict[str, tuple[str, str]]:
        return {
            node.get("Id"): (
                node.get("Type"),
                posixpath.normpath(posixpath.join("/", folder, node.get("Target")))[1:],
            )
            for tag, node in self._nodes(posixpath.join(folder, "_rels", f"{name}.rels"))
            if tag == "Relationship"
        }

    def _nodes(self, part: str) -> Iterator[tuple[str, ElementTree.Element]]:
        """Finished elements with their plain tag."""
        with self.archive.open(part) as stream:
            for _, node in ElementTree.iterparse(stream):
                yield node.tag.rsplit("}", 1)[-1], node

    @staticmethod
    def _text(node: ElementTree.Element) -> str:
        """Text of a plain or rich string; reading aids (``rPh``) are not part of it."""
        found = []
        for child in node:
            tag = child.tag.rsplit("}", 1)[-1]
            if tag == "t":
                found.append(child.text or "")
            elif tag == "r":
                found.append(_Workbook._text(child))
        return "".join(found)

    def _shared_strings(self, part: str | None) -> list[str]:
        strings = []
        for tag, node in self._nodes(part) if part else ():
            if tag == "si":
                strings.append(self._text(node))
                node.clear()
        return strings

    def _cell_formats(self, part: str | None) -> list[str]:
        """For each cell style: ``date``, ``elapsed`` or ``number``."""
        custom: dict[int, str] = {}
        kinds: list[str] = []
        for tag, node in self._nodes(part) if part else ():
            if tag == "numFmt":
                custom[int(node.get("numFmtId"))] = FORMAT_NOISE.sub("", node.get("formatCode", ""))
            elif tag == "cellXfs":
                for style in node:
                    number = int(style.get("numFmtId", 0))
                    code = custom.get(number, "[h]:mm:ss" if number == 46 else "")
                    if ELAPSED.search(code):
                        kinds.append("elapsed")
                    elif DATE_LETTERS.search(code) or (number in DATE_FORMATS and not code):
                        kinds.append("date")
                    else:
                        kinds.append("number")
        return kinds

    def _value(self, cell: ElementTree.Element) -> str | None:
        kind, raw = cell.get("t", "n"), None
        for child in cell:
            if child.tag.endswith("}v"):
                raw = child.text
            elif child.tag.endswith("}is"):
                return self._text(child) or None
        if raw is None:
            return None
        if kind == "n":
            style = int(cell.get("s", 0))
            form = self.formats[style] if style < len(self.formats) else "number"
            return self._number(raw) if form == "number" else self._moment(float(raw), form)
        if kind == "s":
            return self.shared[int(raw)] or None
        if kind == "b":
            return "True" if raw.strip() in ("1", "true") else "False"
        if kind == "d":
            return str(datetime.fromisoformat(raw))
        return None if kind == "e" else raw

    @staticmethod
    def _number(raw: str) -> str:
        try:
            return str(int(raw))
        except ValueError:
            value = float(raw)
            return str(int(value)) if value.is_integer() else repr(value)

    def _moment(self, serial: float, form: str) -> str:
        if form == "elapsed":
            return str(pd.Timedelta(milliseconds=round(serial * 86_400_000)))
        time_only = 0 <= serial < 1
        if self.day_zero == DAY_ZERO[False] and 0 < serial < 60:
            serial += 1  # the format counts a 29 February 1900
        moment = self.day_zero + timedelta(milliseconds=round(serial * 86_400_000))
        if time_only:
            return str(moment.time())
        midnight = moment.time() == datetime.min.time()
        return str(moment.date()) if midnight else str(moment)

    def _rows(self, part: str) -> Iterator[tuple[int, dict[int, str]]]:
        """Row number (from 0) and its cells that hold a value, by column."""
        row = -1
        with self.archive.open(part) as stream:
            for _, node in ElementTree.iterparse(stream):
                if not node.tag.endswith("}row"):
                    continue
                row = int(node.get("r", row + 2)) - 1
                column, values = -1, {}
                for cell in node:
                    place = cell.get("r")
                    if place:
                        letters = place.rstrip(DIGITS)
                        if letters not in self.columns:
                            self.columns[letters] = _column_index(letters)
                        column = self.columns[letters]
                    else:
                        column += 1
                    value = self._value(cell)
                    if value is not None:
                        values[column] = value
                yield row, values
                node.clear()  # of a row that has been read only its empty shell stays

    def measure(self, part: str) -> tuple[tuple[int, int], list | None]:
        """Rows and columns up to the last that holds a value, and the rows read.

        The rows of a sheet that is too large to hold are not kept but read again.
        """
        height = width = 0
        kept: list | None = []
        for row, values in self._rows(part):
            if values:
                height, width = max(height, row + 1), max(width, max(values) + 1)
                self.room -= len(values)
                if self.room < 0:
                    kept = None
                if kept is not None:
                    kept.append((row, values))
        return (height, width), kept

    def filled_rows(
        self, part: str, height: int, width: int, kept: list | None
    ) -> Iterator[tuple[int, list[str | None]]]:
        """All rows of the extent, those the file leaves out as empty ones."""
        due = 0
        for row, values in self._rows(part) if kept is None else kept:
            if row >= height:
                break
            while due < row:
                yield due, [None] * width
                due += 1
            yield row, [values.get(column) for column in range(width)]
            due = row + 1
        if height == 0:
            yield 0, []


def _column_index(letters: str) -> int:
    index = 0
    for letter in letters.upper():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1
