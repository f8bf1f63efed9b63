"""CSV files as text: listing, headers, records.

What a record is does not depend on how a file is read, see :mod:`dustline.sources.csv_split`.
Files up to a bound are a task's work each, larger ones are read in splits.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dustline.functions.names import quoted
from dustline.sources.csv_split import (
    file_id,
    first_record,
    first_records,
    look,
    plain_lines,
    plain_records,
    split_records,
    whole_records,
)

# Columns beside those of a file, whose clean names have no hyphen.
RAW = "raw-record"
FILE = "file-id"
#: So many files are asked for their headers one by one.
FEW_FILES = 16
#: More columns than this, and longer cells, are an error of Spark's parser.
MAX_COLUMNS = 100_000
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": RAW,
    "maxColumns": str(MAX_COLUMNS),
    "maxCharsPerColumn": "-1",
    # Line ends in a record are within quotes and stay as they are.
    "multiLine": "true",
    "lineSep": "\n",
}


@dataclass(frozen=True)
class CsvSource:
    """One table's worth of CSV: a file, or a folder of part files named like one.

    Of each part it knows the path, the size, and the address from which lines get its number.
    """

    name: str
    path: str
    parts: tuple[tuple[str, int, str], ...]

    @property
    def paths(self) -> list[str]:
        return [csv_pattern(path) for path, _, _ in self.parts]

    @property
    def addresses(self) -> list[str]:
        return [address for _, _, address in self.parts]

    @property
    def largest(self) -> int:
        return max(size for _, size, _ in self.parts)

    @property
    def total(self) -> int:
        return sum(size for _, size, _ in self.parts)


def csv_pattern(path: str) -> str:
    """A path that Spark, which takes paths for glob patterns, takes for itself."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _unescaped(name: str) -> str:
    """File name from a partition folder ``file=NAME``, whose odd characters are ``%XX``."""
    if not name.startswith("file="):
        return name
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name[len("file=") :])


def qualified(spark: SparkSession, path: str) -> str:
    """The one full name of a path: with scheme, absolute, without ``.`` and doubled ``/``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    uri = files.makeQualified(hadoop).toUri().normalize().toString()
    # Back to a path, whose odd characters are not escaped.
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        spark.sparkContext._jvm.java.net.URI(uri)
    ).toString()


def entry_of(path: str, folder: str) -> str:
    """The entry of a folder that a file is, or lies below; both are qualified paths."""
    root = folder.rstrip("/") + "/"
    if not path.startswith(root) or path == root:
        raise ValueError(f"{path} is not below {folder}")
    return path[len(root) :].split("/")[0]


def _listed(spark: SparkSession, pattern: str) -> list[tuple[str, int, str]]:
    # Without partitions to infer, folders like a=1 are folders like any other.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
    return sorted(map(tuple, files.select("path", "length", "_metadata.file_path").collect()))


def list_csv(spark: SparkSession, folder: str) -> list[CsvSource]:
    """Every ``.csv`` directly below a folder, by name. Reads names and sizes only."""
    root = qualified(spark, folder)
    found: dict[str, list[tuple[str, int, str]]] = {}
    try:
        parts = _listed(spark, f"{csv_pattern(root.rstrip('/'))}/*.csv")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        parts = []  # a folder without any
    for part in parts:
        found.setdefault(entry_of(part[0], root), []).append(part)
    return [
        CsvSource(_unescaped(entry), f"{root.rstrip('/')}/{entry}", tuple(parts))
        for entry, parts in sorted(found.items())
    ]


def csv_source(spark: SparkSession, path: str) -> CsvSource:
    """A single file or folder of part files as a source."""
    full = qualified(spark, path)
    parts = tuple(_listed(spark, csv_pattern(full)))
    if not parts:
        raise ValueError(f"no file at {path}")
    return CsvSource(full.rsplit("/", 1)[-1], full, parts)


def read_heads(spark: SparkSession, sources: Sequence[CsvSource]) -> dict[str, tuple[str, ...]]:
    """The cells of each source's header, by path; none where there is none.

    A few files are asked one by one, several at a time, and many by one job for all.
    """
    if len(sources) <= FEW_FILES:
        with ThreadPoolExecutor(max_workers=FEW_FILES) as pool:
            found = pool.map(lambda source: first_record(spark, source.paths[0]), sources)
        heads = zip(sources, found, strict=True)
        return {source.path: _cells(record) for source, record in heads if record is not None}
    firsts = {source.addresses[0]: source for source in sources}
    paths = [source.paths[0] for source in sources]
    addresses = spark.createDataFrame([(a,) for a in firsts], "address string")
    addresses = addresses.select("address", file_id(F.col("address")).alias("file"))
    by_file = {row["file"]: row["address"] for row in addresses.collect()}
    if len(by_file) < len(firsts):
        raise ValueError("two files have the same number")
    heads = first_records(spark, paths).select("file", "record").collect()
    return {firsts[by_file[file]].path: _cells(record) for file, record in heads}


def read_head(spark: SparkSession, source: CsvSource) -> tuple[str, ...]:
    """The cells of the first record; reads little further."""
    heads = read_heads(spark, [source])
    if source.path not in heads:
        raise ValueError("no header")
    return heads[source.path]


def _cells(record: str) -> tuple[str, ...]:
    record = record.removeprefix("﻿")
    if '"' not in record:
        return tuple(record.split(","))
    csv.field_size_limit(1 << 30)
    return tuple(next(csv.reader(io.StringIO(record, newline=""))))


def _schema(width: int) -> str:
    return ", ".join([f"c{i} string" for i in range(width)] + [f"`{RAW}` string"])


def whole_bytes(spark: SparkSession) -> int:
    """Up to this size a file is one task's work."""
    return _bytes(spark, "spark.sql.files.maxPartitionBytes")


def read_records(
    spark: SparkSession,
    sources: CsvSource | Sequence[CsvSource],
    width: int,
    split_bytes: int | None = None,
) -> DataFrame:
    """Records below the headers as columns ``c0..``, ``raw-record`` and ``file-id``.

    Fields a short record lacks are null. ``raw-record`` holds the text of a record that has
    more or fewer fields than ``width`` and is null for all others.

    Files without a quote are read by lines, in splits of any size. Others are read whole, a task
    each, up to ``split_bytes``, and beyond that in splits. By default they are read whole if
    that keeps all cores busy and none is larger than a split of the session. The records are
    the same.
    """
    sources = [sources] if isinstance(sources, CsvSource) else sources
    parts = {address: (path, size) for source in sources for path, size, address in source.parts}
    lines = plain_lines(spark, _patterns(parts), sum(size for _, size in parts.values()), width)
    seen = look(lines)
    quoted_parts = {address: part for address, part in parts.items() if seen.get(address, (False,))[0]}
    # Files without any line have no record. Numbers of lines are of one scan of the same files.
    records = None
    if len(quoted_parts) < len(parts):
        if quoted_parts:
            plain = {address: part for address, part in parts.items() if address not in quoted_parts}
            lines = plain_lines(spark, _patterns(plain), sum(size for _, size in plain.values()), width)
            seen = look(lines)
        records = plain_records(lines, [first for _, first in seen.values()])
    if quoted_parts:
        more = _quoted_records(spark, quoted_parts, width, split_bytes)
        records = more if records is None else records.unionByName(more)
    parsed = F.from_csv("record", _schema(width), CSV_OPTIONS).alias("r")
    return (
        records.where(F.col("number") > 1)
        .select(F.col("file").alias(FILE), parsed)
        .select("r.*", quoted(FILE))
    )


def _patterns(parts: Mapping[str, tuple[str, int]]) -> list[str]:
    return [csv_pattern(path) for path, _ in parts.values()]


def _quoted_records(
    spark: SparkSession, parts: Mapping[str, tuple[str, int]], width: int, split_bytes: int | None
) -> DataFrame:
    paths, sizes = _patterns(parts), [size for _, size in parts.values()]
    total, largest, cut = sum(sizes), max(sizes), whole_bytes(spark)
    if split_bytes is None:
        small = _bytes(spark, "spark.sql.files.openCostInBytes")
        split_bytes = max(small, min(cut, total // spark.sparkContext.defaultParallelism))
    if largest <= split_bytes:
        return whole_records(spark, paths, largest, total, width)
    return split_records(spark, paths, total, width, cut)


def _bytes(spark: SparkSession, setting: str) -> int:
    text = spark.conf.get(setting).lower()
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", text).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
