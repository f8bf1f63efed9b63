"""The lines of CSV files, and the records they make.

One rule holds for files of any size: a record ends at a line end, be it ``\\n``, ``\\r\\n`` or
``\\r``, that is not within a quoted field, where line ends belong to the field as they are.

Where a line starts inside or outside quotes depends on all lines before it. Each line maps
the state it is entered with to the state it leaves, and such maps compose. A file that is one
split is entered outside, and its records are put together as its lines go by. In a larger
file a first scan composes the maps of each split, for both states it may be entered with, and
keeps numbers only. Over the splits of a file, one small row each, the true states follow. A
second scan, which knows them, puts together the records that lie in a split; where a record
crosses splits, one more scan takes its lines from their edges. No line goes through a join
that shuffles it.

In a file without any quote each line is a record. One look at the lines of all files, with a row
of numbers for each file, tells these apart, and Spark's own reader of lines is all they need.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dustline.functions.text import quote_scan
from dustline.sources.shared import staged

# Tasks get this code with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SMALL_SPLIT = 4 << 20
#: Splits of one load, about; beyond these, splits grow. The driver holds three numbers of each.
MANY_SPLITS = 50_000
#: How far into a file its header must end.
HEAD_BYTES = 4 << 20
LINES = ["file", "split", "pos", "value", "out0", "out1", "blank"]
EDGES = (
    "file long, split long, out0 boolean, out1 boolean, starts0 long, starts1 long, "
    "inside_until long, last0 long, last1 long"
)
STATES = (
    "file long, split long, enters_inside boolean, leaves_inside boolean, starts long, "
    "records_before long, inside_until long, last long"
)
#: Lines that are looked at for a header at first.
FIRST_LINES = 16
RECORDS = "file long, number long, record string"


def _split_bytes(spark: SparkSession) -> int:
    """The largest split of the session."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").lower()
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", text).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def file_id(address: Column) -> Column:
    """The number by which lines and records name their file, from its full address."""
    return F.xxhash64(address)


def _own_session(spark: SparkSession, split_bytes: int, **more: str) -> SparkSession:
    """A session with the same settings, but splits that do not depend on the cores it has.

    All scans of a file must cut it alike.
    """
    fixed = spark.newSession()
    usual = fixed.conf.getAll
    for setting, value in spark.conf.getAll.items():
        if usual.get(setting) != value:
            fixed.conf.set(setting, value)
    fixed.conf.set("spark.sql.files.minPartitionNum", "1")
    fixed.conf.set("spark.sql.files.maxPartitionBytes", str(max(1, split_bytes)))
    # Java does not compile longer methods; work on many columns is cut into shorter ones then.
    fixed.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    for setting, value in more.items():
        fixed.conf.set(setting.replace("__", "."), value)
    return fixed


def _with_ends(line: Column) -> Column:
    """The lines, each with its end, of a text that was cut at ``\\n``."""

    def parted() -> Column:
        parts = F.split(line, "\r", -1)
        # A carriage return before the cut is the first half of the end.
        whole = (F.element_at(parts, -1) == "").cast("int")
        last = F.size(parts) - whole - 1
        end = F.when(whole == 1, "\r\n").otherwise("\n")
        return F.transform(
            F.slice(parts, F.lit(1), last + 1),
            lambda part, i: F.concat(part, F.when(i < last, "\r").otherwise(end)),
        )

    return F.when(line.contains("\r"), parted()).otherwise(F.array(F.concat(line, F.lit("\n"))))


def scan_lines(spark: SparkSession, paths: Sequence[str], width: int) -> DataFrame:
    """Lines with file, split, place, what they do to the state, and the split's length.

    A line of blanks is none, but for a single column, where it is a cell.
    """
    value = F.col("value")
    ends = "\r\n" if width == 1 else " \t\r\n"
    quotes = F.when(value.contains('"'), quote_scan(value))
    return (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .text(list(paths))
        .select(
            file_id(F.col("_metadata.file_path")).alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.col("_metadata.file_block_length").alias("length"),
            F.explode(_with_ends(value)).alias("value"),
        )
        .select(
            "*",
            F.monotonically_increasing_id().alias("pos"),
            (F.btrim(value, F.lit(ends)) == "").alias("blank"),
            quotes.alias("quotes"),
        )
        .select(
            "*",
            F.coalesce(F.col("quotes.from_outside") == 1, F.lit(False)).alias("out0"),
            F.coalesce(F.col("quotes.from_inside") == 1, F.lit(True)).alias("out1"),
        )
    )


def plain_lines(spark: SparkSession, paths: Sequence[str], total: int, width: int) -> DataFrame:
    """Lines at any line end with file, address, and a number; none for a line of blanks.

    The numbers are the same in each scan, as files are cut alike. A line with a quote may be
    cut here where it should not be.
    """
    fixed = _own_session(spark, min(_split_bytes(spark), max(SMALL_SPLIT, total // spark.sparkContext.defaultParallelism)))
    address = F.col("_metadata.file_path")
    lines = fixed.read.option("recursiveFileLookup", "true").text(list(paths))
    return lines.select(
        file_id(address).alias("file"), address.alias("address"), F.monotonically_increasing_id().alias("pos"), "value"
    ).where((F.btrim("value", F.lit(" \t")) if width > 1 else F.col("value")) != "")


def look(lines: DataFrame) -> dict[str, tuple[bool, int]]:
    """For each file of ``plain_lines`` by address, whether it has a quote, and the number of its
    first line. One row of numbers for each file."""
    found = lines.groupBy("address").agg(
        F.bool_or(F.col("value").contains('"')).alias("quoted"), F.min("pos").alias("first")
    )
    return {row["address"]: (row["quoted"], row["first"]) for row in found.collect()}


def plain_records(lines: DataFrame, firsts: Sequence[int]) -> DataFrame:
    """Rows ``(file, number, record)`` of ``plain_lines`` of files without quotes, but for their
    headers, whose numbers are ``firsts``: as many as there are files."""
    spark = lines.sparkSession
    heads = spark.createDataFrame([(first,) for first in firsts], "pos long")
    number = F.lit(2).cast("long").alias("number")
    below = lines.join(F.broadcast(heads), "pos", "left_anti") if len(firsts) > 100 else lines.where(~F.col("pos").isin(*firsts))
    return below.select("file", number, F.col("value").alias("record"))


def first_record(spark: SparkSession, path: str) -> str | None:
    """The header of one file, if it has one.

    The first lines are read, and more only of a header that is not ended by then.
    """
    lines, wanted = scan_lines(spark, [path], 2).select(*LINES, "length"), FIRST_LINES
    while True:
        rows = lines.limit(wanted).collect()
        names = [field.name for field in lines.schema]
        batch = pa.RecordBatch.from_arrays([pa.array([row[name] for row in rows]) for name in names], names)
        for head in _heads(iter([batch]), HEAD_BYTES):
            return head.column("record")[0].as_py()
        if len(rows) < wanted:
            return None
        wanted *= 16


def first_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows ``(file, number, record)`` with number 1: the header of each of many files.

    Files are cut into small splits, and a task stops when no split of its own can hold a
    header any more.
    """
    fixed = _own_session(
        spark, HEAD_BYTES, spark__sql__execution__arrow__maxRecordsPerBatch="256"
    )
    lines = scan_lines(fixed, paths, 2).select(*LINES, "length")
    return lines.mapInArrow(lambda batches: _heads(batches, HEAD_BYTES), RECORDS)


def whole_records(spark: SparkSession, paths: Sequence[str], largest: int, total: int, width: int) -> DataFrame:
    """Rows ``(file, number, record)`` of files that are a split each."""
    cores = spark.sparkContext.defaultParallelism
    lines = scan_lines(_own_session(spark, max(largest, total // cores)), paths, width)
    return lines.select(*LINES).mapInArrow(lambda batches: _records(batches, None), RECORDS)


def split_records(
    spark: SparkSession, paths: Sequence[str], total: int, width: int, split_bytes: int
) -> DataFrame:
    """Rows ``(file, number, record)`` of files in splits; the header of a file is its number 1.

    Splits are small enough to keep all cores busy, while they are not many.
    """
    cores = spark.sparkContext.defaultParallelism
    size = min(split_bytes, max(SMALL_SPLIT, total // (8 * cores)))
    fixed = _own_session(spark, max(size, total // MANY_SPLITS))
    lines = scan_lines(fixed, paths, width).select(*LINES)
    edges = staged(lines.drop("value").mapInArrow(_edges, EDGES), "csv-edges")
    splits = _true_states(edges).collect()
    last = {row["file"]: row for row in sorted(splits, key=lambda row: row["split"])}
    if any(row["leaves_inside"] for row in last.values()):
        raise ValueError("a quote is never closed")
    entries = {
        (row["file"], row["split"]): (row["enters_inside"], row["records_before"])
        for row in splits
    }
    within = lines.mapInArrow(lambda batches: _records(batches, entries), RECORDS)
    crossed = [row for row in splits if row["enters_inside"] or row["leaves_inside"]]
    if not crossed:
        return within
    return within.unionByName(_crossing_records(lines, fixed.createDataFrame(crossed, STATES)))


def _true_states(edges: DataFrame) -> DataFrame:
    """The states each split is really entered with and leaves, and records before it.

    ``out0``/``out1`` say whether a split is left inside quotes when entered outside or
    inside. A split that leaves one state whatever it was entered with fixes the state;
    those after it only flip it, so the last such split and the flips since decide. A
    file has as many rows here as splits, each of a few numbers.
    """
    ordered = Window.partitionBy("file").orderBy("split")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    flips = (F.col("out0") & ~F.col("out1")).cast("long")
    fixing = F.when(
        F.col("out0") == F.col("out1"), (F.col("out0").cast("long") + F.col("flips")) % 2
    )
    enters = (F.coalesce(F.last(fixing, ignorenulls=True).over(before), F.lit(0)) + F.col("flips")) % 2

    def by_entry(outside: str, inside: str) -> Column:
        return F.when(F.col("enters_inside"), F.col(inside)).otherwise(F.col(outside))

    return (
        edges.withColumn("flips", F.coalesce(F.sum(flips).over(before), F.lit(0)))
        .withColumn("enters_inside", enters == 1)
        .withColumn("starts", by_entry("starts0", "starts1"))
        .select(
            "file",
            "split",
            "enters_inside",
            by_entry("out0", "out1").alias("leaves_inside"),
            "starts",
            F.coalesce(F.sum("starts").over(before), F.lit(0)).alias("records_before"),
            "inside_until",
            by_entry("last0", "last1").alias("last"),
        )
    )


def _crossing_records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Records that begin in one split and end in a later one, from the lines at the edges.

    The splits, as many as there are at most, are small enough to broadcast to the lines.
    """
    held = lines.join(F.broadcast(splits), ["file", "split"])
    in_head = F.col("enters_inside") & (
        F.col("inside_until").isNull() | (F.col("pos") < F.col("inside_until"))
    )
    in_tail = F.col("leaves_inside") & (F.col("starts") > 0) & (F.col("pos") >= F.col("last"))
    number = F.col("records_before") + F.when(in_tail, F.col("starts")).otherwise(0)
    pieces = held.where(in_head | in_tail).select(
        "file", number.alias("number"), F.struct("split", "pos", "value").alias("piece")
    )
    in_order = F.sort_array(F.collect_list("piece"))
    record = F.array_join(F.transform(in_order, lambda piece: piece["value"]), "")
    return pieces.groupBy("file", "number").agg(F.rtrim(record, F.lit("\r\n")).alias("record"))


# In tasks. The lines of a split come one after the other, in order.


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Batches cut where a split ends, each with whether it begins a split."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, split = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "split"))
        change = (file[1:] != file[:-1]) | (split[1:] != split[:-1])
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            key = (int(file[start]), int(split[start]))
            yield key != last, batch.slice(start, end - start)
            last = key


def _bools(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(bool)


def _inside(batch: pa.RecordBatch, entered: bool) -> tuple[np.ndarray, bool]:
    """For each line whether it begins inside quotes, and whether the last ends there."""
    out0, out1 = _bools(batch, "out0"), _bools(batch, "out1")
    flips = np.cumsum(out0 & ~out1)
    fixed = np.maximum.accumulate(np.where(out0 == out1, np.arange(len(out0)), -1))
    anchored = out0[fixed] ^ ((flips[fixed] & 1) == 1)
    after = np.where(fixed >= 0, anchored, entered) ^ ((flips & 1) == 1)
    return np.concatenate([[entered], after[:-1]]), bool(after[-1])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of numbers per split, for both states it may be entered with.

    ``starts`` counts the records that begin in it and ``last`` is the line where the last of
    them does; ``inside_until`` is the first line that begins outside, if entered inside.
    """
    seen = None
    for begins, batch in _runs(batches):
        if begins:
            if seen:
                yield _edge_row(seen)
            key = [batch.column("file")[0].as_py(), batch.column("split")[0].as_py()]
            seen = {"key": key, "state": [False, True], "starts": [0, 0], "until": None, "last": [None, None]}
        blank, pos = _bools(batch, "blank"), batch.column("pos").to_numpy(zero_copy_only=False)
        for entry in (0, 1):
            inside, seen["state"][entry] = _inside(batch, seen["state"][entry])
            outside = np.flatnonzero(~inside)
            if entry and seen["until"] is None and outside.size:
                seen["until"] = int(pos[outside[0]])
            starts = np.flatnonzero(~inside & ~blank)
            seen["starts"][entry] += int(starts.size)
            if starts.size:
                seen["last"][entry] = int(pos[starts[-1]])
    if seen:
        yield _edge_row(seen)


def _edge_row(seen: dict) -> pa.RecordBatch:
    values = [*seen["key"], *seen["state"], *seen["starts"], seen["until"], *seen["last"]]
    names = ["file", "split", "out0", "out1", "starts0", "starts1", "inside_until", "last0", "last1"]
    types = [pa.bool_() if name.startswith("out") else pa.int64() for name in names]
    arrays = [pa.array([v], t) for v, t in zip(values, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _records(
    batches: Iterator[pa.RecordBatch],
    entries: Mapping[tuple[int, int], tuple[bool, int]] | None,
) -> Iterator[pa.RecordBatch]:
    """The records that lie within a split.

    ``entries`` says of each split whether it is entered inside quotes and how many records
    begin before it; without, each file is one split. The last record seen is held back until
    the next begins or its split ends; one that the split leaves open is not for here, nor are
    the lines before the first record.
    """
    held, inside_now, number, file = None, False, 0, None

    def out(first: int, records: pa.Array) -> pa.RecordBatch:
        numbers = pa.array(np.arange(first, first + len(records)), pa.int64())
        files = pa.array(np.full(len(records), file), pa.int64())
        texts = pc.utf8_rtrim(records, characters="\r\n")
        return pa.RecordBatch.from_arrays([files, numbers, texts], ["file", "number", "record"])

    def rest() -> Iterator[pa.RecordBatch]:
        if inside_now and entries is None:
            raise ValueError("a quote is never closed")
        if held is not None and not inside_now:
            yield out(number, pa.array([held], pa.string()))

    for begins, batch in _runs(batches):
        if begins:
            yield from rest()
            held, file = None, batch.column("file")[0].as_py()
            split = batch.column("split")[0].as_py()
            if entries is None and split:
                raise ValueError("a file that was taken for whole is cut")
            if entries is None:
                inside_now, number = False, 0
            else:
                inside_now, number = entries[file, split]
        inside, inside_now = _inside(batch, inside_now)
        starts = ~inside & ~_bools(batch, "blank")
        of_record = np.flatnonzero(starts | inside)
        value = batch.column("value")
        if len(of_record) < len(value):
            value = value.take(pa.array(of_record))
        begin = np.flatnonzero(starts[of_record])
        if held is not None:
            value = pa.concat_arrays([pa.array([held], pa.string()), value])
            begin = np.concatenate([[0], begin + 1])
        else:
            number += 1 if begin.size else 0
        if not begin.size:
            continue
        if len(begin) < len(value):
            bounds = pa.array(np.append(begin, len(value)), pa.int32())
            value = pc.binary_join(pa.ListArray.from_arrays(bounds, value), "")
        yield out(number, value[:-1])
        number += len(value) - 1
        held = value[-1].as_py()
    yield from rest()


def _heads(batches: Iterator[pa.RecordBatch], split_bytes: int) -> Iterator[pa.RecordBatch]:
    """The first record of each file whose beginning is here."""
    held, inside, done = None, False, True
    for begins, batch in _runs(batches):
        if begins:
            if held is not None and not inside:
                yield _head(*held)
            first = batch.column("split")[0].as_py() == 0
            held, inside, done = None, False, not first
        if not done:
            before, inside = _inside(batch, inside)
            starts = np.flatnonzero(~before & ~_bools(batch, "blank"))
            wanted = before.copy()
            if held is None and starts.size:
                held = (batch.column("file")[0].as_py(), [])
                wanted[: starts[0]], wanted[starts[0]], starts = False, True, starts[1:]
            if held is not None:
                end = int(starts[0]) if starts.size else len(wanted)
                lines = np.flatnonzero(wanted[:end])
                held[1].extend(batch.column("value").take(pa.array(lines)).to_pylist())
                if starts.size:
                    yield _head(*held)
                    held, done = None, True
        if done and batch.column("length")[0].as_py() >= split_bytes:
            return  # a split of full size has its task to itself
    if held is not None and not inside:
        yield _head(*held)


def _head(file: int, lines: list[str]) -> pa.RecordBatch:
    values = [[file], [1], ["".join(lines).rstrip("\r\n")]]
    types = [pa.int64(), pa.int64(), pa.string()]
    arrays = [pa.array(v, t) for v, t in zip(values, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["file", "number", "record"])
