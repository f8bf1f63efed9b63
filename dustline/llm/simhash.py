"""Near duplicates by SimHash, with links found in BK-trees.

A document's words, lower-cased in A-Z, are taken as shingles; a bit of the fingerprint is 1 if
it is set in over half of the shingles' hashes. Fingerprints that differ in at most ``radius``
bits are linked, and documents belong together if links lead from one to the other.

Links are looked for between different fingerprints only. The 64 bits are cut into blocks, two
more than the radius: two linked fingerprints agree in two blocks at least. So a fingerprint
goes to one shard for every two blocks, with all others that have the same bits there, and any
link lies in some shard. A shard's fingerprints form a BK-tree: a child hangs on the edge whose
number is its distance to the parent, and a search follows only the edges that differ from the
searched fingerprint's distance by at most the radius. A shard above a number of fingerprints
is parted again in the same way by the bits its members need not share, twice if need be, after
which a shard has 256 members at most. No fingerprint is left out. From a shard come as many
links as it takes to join what belongs together, not all pairs.

Texts that are null or without words have fingerprint zero, which is linked like any other.
Fewer words than a shingle has make one shingle. A group is named by its smallest doc_id, null
if it has none; the row with that doc_id stays, of several the first. Other columns of the
input play no part and pass through, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dustline.llm.common import ROW, packed, row_of, staged_small
from dustline.sources.shared import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Shingles whose bits are counted at once.
STEP = 1 << 16
#: Members of a shard that is searched as one tree.
SHARD = 2048


def text_fingerprint(text: bytes, size: int) -> int:
    """The SimHash of a text in UTF-8."""
    # bytes.split() parts at exactly the ASCII white space, and lower() changes A-Z only.
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles: Iterable[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    ones, total = np.zeros(64, np.int64), 0
    while True:
        hashes = [xxhash.xxh64_intdigest(s, SEED) for s in itertools.islice(shingles, STEP)]
        if not hashes:
            break
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprint_batches(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_fingerprint(t.as_py() or b"", size) for t in batch.column("__text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column(ROW),
                    pa.array(np.array(found, np.uint64).view(np.int64)),
                ],
                names=["doc_id", ROW, "fingerprint"],
            )

    return run


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, ``__row`` and fingerprint of each row of ``docs``, which is numbered."""
    rows = docs.select("doc_id", ROW, F.col("text").cast("binary").alias("__text"))
    schema = StructType(rows.schema.fields[:-1]).add("fingerprint", "long")
    return rows.mapInArrow(fingerprint_batches(size), schema)


class BKTree:
    """Fingerprints by their distance to the one they hang on."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Places of all fingerprints within the radius."""
        found, todo = [], [0] if self.values else []
        while todo:
            node = todo.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            children = self.children[node]
            if len(children) > 2 * radius + 1:
                edges = range(distance - radius, distance + radius + 1)
                todo.extend(children[edge] for edge in edges if edge in children)
            else:
                todo.extend(c for edge, c in children.items() if abs(edge - distance) <= radius)
        return found

    def add(self, value: int) -> None:
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        node = 0
        while node != new:
            distance = (self.values[node] ^ value).bit_count()
            node = self.children[node].setdefault(distance, new)


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join what belongs together in one shard of different fingerprints."""
    tree, group = BKTree(), list(range(len(values)))

    def top(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for i, value in enumerate(values):
        for other in tree.near(value, radius):
            one, two = sorted((top(other), top(i)))
            group[two] = one
        tree.add(value)
    return [(values[top(i)], values[i]) for i in range(len(values)) if top(i) != i]


def link_batches(radius: int):
    """Links of shards, from rows (mask, bits, fingerprint) sorted by shard."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((3, 0), np.uint64)

        def out(rows: np.ndarray) -> pa.RecordBatch:
            change = (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)
            edges = np.flatnonzero(np.r_[True, change, True]) if rows.size else [0]
            found = [
                link
                for start, end in itertools.pairwise(edges)
                if end - start > 1
                for link in shard_links(rows[2, start:end].tolist(), radius)
            ]
            both = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"]
            )

        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns]
            rows = np.concatenate([rest, np.stack(new)], axis=1)
            if not rows.size:
                continue
            # The last shard may go on in the next batch.
            last = int(np.flatnonzero((rows[:2] == rows[:2, -1:]).all(axis=0))[0])
            rest = rows[:, last:]
            yield out(rows[:, :last])
        yield out(rest)

    return run


def _blocks(bits: list[int], radius: int) -> list[list[int]]:
    return [list(x) for x in np.array_split(bits, radius + 2)]


def finer_masks(mask: int, radius: int) -> list[int]:
    """Masks with more bits: linked fingerprints that agree under ``mask`` agree under one."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    pairs = itertools.combinations(_blocks(free, radius), 2)
    return [mask | sum(1 << int(bit) for bit in one + two) for one, two in pairs]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _sharded(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """A row for each finer shard of each row (mask, fingerprint)."""
    entries: list[Column] = []
    for mask, finer in masks.items():
        entries += [F.lit(_signed(mask)), F.array(*[F.lit(_signed(m)) for m in finer])]
    return rows.select(
        "fingerprint", F.explode(F.create_map(*entries)[F.col("mask")]).alias("mask")
    ).select("mask", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("bits"), "fingerprint")


def links(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Columns a and b: enough links of different fingerprints to join what belongs together.

    ``shard`` is 256 at least, which is what is left of a shard that is parted twice.
    """
    found, shard, most = [], max(shard, 256), distinct.count()
    todo, masks = distinct.select(F.lit(0).cast("long").alias("mask"), "fingerprint"), [0]
    while masks:
        finer = {mask: finer_masks(mask, radius) for mask in masks}
        rows = _sharded(todo, finer)
        most *= max(map(len, finer.values()))
        sizes = rows.groupBy("mask", "bits").agg(F.count("*").alias("size")).where("size > 1")
        sizes = staged_small(sizes, "simhash-shards", most)
        members = staged_small(rows.join(sizes, ["mask", "bits"]), "simhash-members", most)
        trees = members.where(F.col("size") <= shard).select("mask", "bits", "fingerprint")
        trees = trees.repartition("mask", "bits").sortWithinPartitions("mask", "bits")
        found.append(trees.mapInArrow(link_batches(radius), "a long, b long"))
        todo = members.where(F.col("size") > shard).select("mask", "fingerprint").distinct()
        masks = sorted({m for new in finer.values() for m in new})
        if todo.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return staged_small(out.distinct(), "simhash-links", most)


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(mixed), F.sum(mixed.cast("decimal(38,0)"))).first()
    )


def stars(edges: DataFrame) -> DataFrame:
    """Columns a and b: for each vertex b of ``edges`` that is not the least of its component,
    the least vertex a.

    In turn, each vertex hands its least neighbour to the larger ones, then to the smaller
    ones, until every component is a star. Each step is written; only counts and checksums
    reach the driver.
    """
    state = _state(edges)
    while rows := state[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        least = least.select("a", F.least("a", "least").alias("least"))
        least = staged_small(least, "stars-least", 2 * rows)
        large = both.where("b > a").join(least, "a").where("least <> b")
        large = large.select(F.col("least").alias("a"), "b").distinct()
        large = staged_small(large, "stars-large", 2 * rows)
        least = large.groupBy("b").agg(F.min("a").alias("least"))
        least = staged_small(least, "stars-least", 2 * rows)
        small = large.join(least, "b").where("least <> a").select("least", "a")
        small = small.union(least.select("least", "b")).distinct().toDF("a", "b")
        edges = staged_small(small, "stars-small", 2 * rows)
        new = _state(edges)
        if new == state:
            break
        state = new
    return edges


def components(slim: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``slim`` (doc_id, ``__row``, fingerprint; written) with the first member of each group:
    component_id, and its row in ``__first_row``."""
    member = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), F.col(ROW).alias("row")
    )
    most = slim.count()
    distinct = slim.groupBy("fingerprint").agg(F.min(member).alias("first"))
    distinct = staged_small(distinct, "simhash-distinct", most)
    found = stars(links(distinct.select("fingerprint"), radius))
    group = F.coalesce("a", "fingerprint").alias("group")
    grouped = distinct.join(found, F.col("fingerprint") == F.col("b"), "left")
    grouped = grouped.select("fingerprint", group, "first")
    grouped = staged_small(grouped, "simhash-grouped", most)
    firsts = grouped.groupBy("group").agg(F.min("first").alias("least"))
    firsts = staged_small(firsts, "simhash-firsts", most)
    named = grouped.join(firsts, "group").select("fingerprint", "least")
    named = staged_small(named, "simhash-components", most)
    return slim.join(named, "fingerprint").select(
        *slim.columns,
        F.col("least.doc").alias("component_id"),
        F.col("least.row").alias("__first_row"),
    )


def groups(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, ``__row``, fingerprint, component_id and ``__first_row`` of each numbered row."""
    slim = staged(fingerprints(docs, size), "simhash-fingerprints")
    return components(slim, radius)


def find_near_copies(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (hexadecimal) and component_id: a row for each row of ``docs``."""
    row = row_of(F.lit(0), F.monotonically_increasing_id()).alias(ROW)
    rows = docs.select("doc_id", "text", row)
    found = groups(rows, size, radius)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def deduplicate(
    docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, written: bool = False
) -> DataFrame:
    """One row of each group of ``docs``, with all columns. A ``written`` table is one as it was
    read from its files (see ``packed``)."""
    rows = packed(docs, "simhash-documents", written)
    found = groups(rows.select(ROW, "__doc.doc_id", "__doc.text"), size, radius)
    gone = staged(found.where(F.col(ROW) != F.col("__first_row")).select(ROW), "simhash-gone")
    return rows.join(gone, ROW, "left_anti").select("__doc.*")
