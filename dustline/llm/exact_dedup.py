"""Exact copies, by counting quotient filters and a comparison of bytes.

Texts are equal if they are identical without white space; a null text counts as empty. Each
text has a 64-bit fingerprint. Its upper bits, the quotient, name a run; the rest is the
remainder. Every partition builds a filter of its own: for each quotient the sorted
remainders, each with its count. Filters of all partitions have the same split of bits, so
they merge without loss by merging the sorted remainders of equal quotients and adding counts.
Fingerprints that then count more than one are suspects, and only their texts are looked at
again: they are grouped by their bytes, so that a fingerprint shared by chance parts again.

Of equal texts the row with the most code points in the original stays, then the smallest
doc_id (null last), then the first row. Repeated rows are copies like any other, long texts are
compared whole. Other columns of the input play no part and pass through, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dustline.llm.bitmaps import may_contain
from dustline.llm.common import ROW, SPACE, numbered, packed, staged_small
from dustline.sources.shared import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fingerprints in a run, about, and in what a task holds before it writes its filter.
RUN = 50_000
HELD = 1_000_000

#: Groups of more than this part of all rows are joined where their rows lie.
LARGE = 1000

FILTER = "quotient long, remainders binary, counts binary"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, text_sha256 and n_points of each row of ``docs``, and its row
    number if it has one."""
    text = normalised(F.col("text"))
    rows = [ROW] if ROW in docs.columns else []
    return docs.select(
        *rows,
        "doc_id",
        F.xxhash64(text).alias("fingerprint"),
        F.sha2(text, 256).alias("text_sha256"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_points"),
    )


def counted_runs(fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[tuple]:
    """The filter of some fingerprints: quotient, sorted remainders and their counts."""
    order = np.argsort(fingerprints, kind="stable")
    values, amounts = fingerprints[order], counts[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else []
    if not len(first):
        return
    values, amounts = values[first], np.add.reduceat(amounts, first)
    quotients = values >> np.uint64(64 - bits) if bits else np.zeros_like(values)
    remainders = values & np.uint64((1 << (64 - bits)) - 1)
    edges = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1], True])
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        yield int(quotients[start]), remainders[start:end], amounts[start:end]


def build_filters(bits: int):
    """A task's part: filters of the fingerprints it reads."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[np.ndarray]) -> pa.RecordBatch:
            found = np.concatenate(held).view(np.uint64)
            runs = list(counted_runs(found, np.ones(len(found), np.int64), bits))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([run[0] for run in runs], pa.int64()),
                    pa.array([run[1].tobytes() for run in runs], pa.binary()),
                    pa.array([run[2].tobytes() for run in runs], pa.binary()),
                ],
                names=["quotient", "remainders", "counts"],
            )

        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            size += len(held[-1])
            if size >= HELD:
                yield out(held)
                held, size = [], 0
        if size:
            yield out(held)

    return build


def merge_runs(bits: int):
    """All runs of one quotient to one; what counts more than one comes out."""

    def merge(runs: pd.DataFrame) -> pd.DataFrame:
        quotient = int(runs["quotient"].iloc[0])
        remainders = np.concatenate([np.frombuffer(x, np.uint64) for x in runs["remainders"]])
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in runs["counts"]])
        # With the quotient's bits zero, the remainders form one run.
        ((_, merged, amounts),) = counted_runs(remainders, counts, 0)
        several = amounts > 1
        high = np.uint64(quotient << (64 - bits)) if bits else np.uint64(0)
        found = (merged[several] | high).view(np.int64)
        return pd.DataFrame({"fingerprint": found, "rows": amounts[several]})

    return merge


def suspects(fingerprints: DataFrame, rows: int) -> DataFrame:
    """Fingerprints that occur more than once, and how often; ``fingerprints`` has one column."""
    bits = max(0, (rows // RUN).bit_length())
    filters = fingerprints.mapInArrow(build_filters(bits), FILTER)
    return filters.groupBy("quotient").applyInPandas(
        merge_runs(bits), "fingerprint long, rows long"
    )


def groups_of_bytes(docs: DataFrame, possible: Callable[[Column], Column]) -> DataFrame:
    """fingerprint, text_sha256 and group_size of texts that are equal byte by byte, of those whose
    fingerprints are ``possible``."""
    text = normalised(F.col("text"))
    return (
        docs.select(F.xxhash64(text).alias("fingerprint"), text.alias("__bytes"))
        .where(possible(F.col("fingerprint")))
        .groupBy("fingerprint", "__bytes")
        .agg(F.count("*").alias("group_size"))
        .where(F.col("group_size") > 1)
        # Never null, so that no filter of it is put where texts are read.
        .select("fingerprint", F.coalesce(F.sha2("__bytes", 256), F.lit("")).alias("text_sha256"), "group_size")
    )


def copies(docs: DataFrame, slim: DataFrame) -> DataFrame:
    """``slim`` with keep_id, group_size and kept; ``slim`` is the written digests of ``docs``.

    Suspects are known to every task by a bitmap of bounded size, whatever their number, which
    passes few texts beside theirs. What passes is grouped where it lies, so one row for
    each text and task is shuffled: no text that occurs once, but for those few, and a text that makes up
    much of the corpus is no burden on one task.
    """
    rows = slim.count()
    suspect = suspects(slim.select("fingerprint"), rows).select("fingerprint")
    suspect = staged_small(suspect, "dedup-suspects", rows)
    possible = may_contain(suspect, suspect.count())
    by_bytes = groups_of_bytes(docs, possible)
    # The least: most code points, then the smallest doc_id, null last, then the first row.
    rank = F.struct(
        (-F.col("n_points")).alias("points"),
        F.col("doc_id").isNull().alias("none"),
        F.col("doc_id").alias("doc"),
        F.col(ROW).alias("row"),
    )
    keepers = (
        slim.where(possible(F.col("fingerprint")))
        .groupBy("fingerprint", "text_sha256")
        .agg(F.min(rank).alias("__keep"))
    )
    keys = ["fingerprint", "text_sha256"]
    groups = staged(
        by_bytes.join(keepers, keys).select(
            *keys,
            "group_size",
            F.col("__keep.doc").alias("__keep_id"),
            F.col("__keep.row").alias("__keep_row"),
        ),
        "dedup-groups",
    )
    # Groups above a thousandth of all rows are a thousand at most, so they can be sent to where
    # their rows lie; no key of the others holds more rows than that.
    large = F.broadcast(groups.where(F.col("group_size") * LARGE > rows))
    rest = groups.where(F.col("group_size") * LARGE <= rows)
    named = slim.join(large, keys).unionByName(
        slim.join(large.select(*keys), keys, "left_anti").join(rest, keys, "left")
    )
    alone = F.col("group_size").isNull()
    return named.select(
        ROW,
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("__keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("__keep_row") == F.col(ROW))).alias("kept"),
        "text_sha256",
    )


def find_copies(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256: a row for each row of ``docs``."""
    slim = numbered(digests(docs), "dedup-digests")
    return copies(docs, slim).drop(ROW)


def deduplicate(docs: DataFrame, written: bool = False) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. A ``written`` table is one as it was
    read from its files (see ``packed``)."""
    rows = packed(docs, "dedup-documents", written)
    texts = rows.select(ROW, "__doc.doc_id", "__doc.text")
    slim = staged(digests(texts), "dedup-digests")
    gone = copies(texts, slim).where(~F.col("kept")).select(ROW)
    gone = staged_small(gone, "dedup-gone", slim.count())
    return rows.join(gone, ROW, "left_anti").select("__doc.*")
