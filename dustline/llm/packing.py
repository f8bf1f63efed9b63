"""Packing of encoded documents into sequences of bounded length, with balanced cost.

A document is its ids and an end token. Its attention costs a linear and a quadratic share
of its length, so sequences of the same length differ in cost by how their documents are cut. Full
sequences are cut from a document that is longer than one; what is left of documents is packed
in groups of about ``GROUP`` tokens, in the order in which a task reads them. A group has just as much room
as tokens: full sequences, and one for each power of two that is left over, so nothing is padded. Its
documents are assigned from the longest down, each to the sequence of lowest cost that has room
for all of it. Where none has, the lowest one with any room takes the beginning, and the
rest waits until its length is due, so each id lies in one piece.

A task packs what it reads: nothing is shuffled, and a source or document of any size loads no
other task. Sequences are numbered by task and by their place in it, so a task that runs again
gives the same ones, and so do reruns over the same splits of files. Null and empty texts have the
end token only. Repeated rows are packed like any other; equal lengths keep the order of rows. Long texts
are encoded whole. An empty table gives no pieces. Columns of the input pass through if they are named in ``kept``, but for those of a name
of the operator's own.
"""

from __future__ import annotations

import heapq
import json
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from dustline.llm.bpe import byte_symbols

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["dustline.llm.bpe"])

LENGTH = 1024
END = 0
#: The cost of n tokens is COST * n + n * n: a layer of width d spends 24 d * d operations on
#: the weights of a token and 4 d on each pair of tokens, and d is 1024 here.
COST = 6 * 1024
#: Tokens of a group, and rows handed on at once.
GROUP = 1 << 21
ROWS = 4096

PIECE = {
    "start": "long",
    "length": "long",
    "ids": "binary",
    "doc_tokens": "long",
    "sequence_id": "long",
    "offset": "long",
    "cost": "long",
}

#: Fixed value: how the byte-level tokenizer parts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranks_of(parsed: dict) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Ranks of byte sequences and special tokens of a tokenizer file, if it is a plain byte-level
    BPE whose ids are in the order of its merges; else none."""
    model, split = parsed["model"], parsed["pre_tokenizer"] or {}
    plain = parsed["normalizer"] is None and model["type"] == "BPE" and split.get("type") == "ByteLevel"
    plain = plain and not split.get("add_prefix_space") and split.get("use_regex")
    plain = plain and not any(
        model.get(name)
        for name in ("dropout", "byte_fallback", "ignore_merges", "end_of_word_suffix", "continuing_subword_prefix")
    )
    special = parsed["added_tokens"]
    if not plain or any(
        not t["special"] or t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in special
    ):
        return None
    byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
    names = {t["content"] for t in special}
    vocabulary = {token: i for token, i in model["vocab"].items() if token not in names}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [vocabulary[token] for token in merged]
    single = [i for token, i in vocabulary.items() if len(token) == 1]
    if ids != sorted(set(ids)) or len(single) != 256 or len(single) + len(ids) != len(vocabulary):
        return None
    ranks = {bytes(byte_of[symbol] for symbol in token): i for token, i in vocabulary.items()}
    return ranks, {t["content"]: t["id"] for t in special}


class Encoder:
    """Ids of texts as the tokenizers library gives them.

    For a plain byte-level BPE another library gives the same ids in a third of the time. It
    gives up on very long white space; such texts, and other kinds of tokenizers, are left to
    the first one.
    """

    def __init__(self, file: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_str(file)
        self.exact.no_truncation()
        self.exact.no_padding()
        self.fast = None
        if found := ranks_of(json.loads(file)):
            ranks, special = found
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
            )

    def encode(self, text: str) -> np.ndarray:
        if self.fast:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:
                pass
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


def encoder_of(tables: dict) -> Encoder:
    """The encoder of a file that was sent to a worker, which keeps it for its later tasks."""
    if "encoder" not in tables:
        tables["encoder"] = Encoder(tables["file"])
    return tables["encoder"]


def cost_of(length: int, linear: int) -> int:
    return length * (linear + length)


def balanced(lengths: list[int], capacity: int, linear: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Document, start, length, sequence and offset of each piece, for lengths up to ``capacity``.

    Sequences are numbered from 0; together they have room for all lengths and no more.
    """
    full, rest = divmod(sum(lengths), capacity)
    rooms = [capacity] * full + [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
    left, cost = rooms.copy(), [0] * len(rooms)
    # Sequences by cost; those that were too full for some document are set by until one
    # comes that they have room for, in order of room and of cost.
    ready = [(0, sequence) for sequence in range(len(rooms))]
    set_by, roomy, cheap = [False] * len(rooms), [], []

    def place(document: int, start: int, length: int, sequence: int) -> tuple[int, int, int, int, int]:
        offset = rooms[sequence] - left[sequence]
        left[sequence] -= length
        cost[sequence] += cost_of(length, linear)
        if left[sequence]:
            heapq.heappush(ready, (cost[sequence], sequence))
        return document, start, length, sequence, offset

    # What is to be placed, the longest first, the rests of documents that were cut among them.
    queue = [(-length, document, 0) for document, length in enumerate(lengths)]
    heapq.heapify(queue)
    while queue:
        less, document, start = heapq.heappop(queue)
        length = -less
        while roomy and -roomy[0][0] >= length:
            room, sequence = heapq.heappop(roomy)
            if set_by[sequence] and -room == left[sequence]:
                set_by[sequence] = False
                heapq.heappush(ready, (cost[sequence], sequence))
        while ready and left[ready[0][1]] < length:
            _, sequence = heapq.heappop(ready)
            set_by[sequence] = True
            heapq.heappush(roomy, (-left[sequence], sequence))
            heapq.heappush(cheap, (cost[sequence], sequence))
        if ready:
            yield place(document, start, length, heapq.heappop(ready)[1])
            continue
        # None has room for all of it: the one of lowest cost takes a part.
        while True:
            spent, sequence = heapq.heappop(cheap)
            if set_by[sequence] and spent == cost[sequence]:
                break
        set_by[sequence] = False
        part = left[sequence]
        yield place(document, start, part, sequence)
        heapq.heappush(queue, (part - length, document, start + part))


class Packer:
    """What a task holds of the documents it has read, and the pieces it hands on."""

    def __init__(self, capacity: int, linear: int, schema: pa.Schema) -> None:
        self.capacity, self.linear, self.schema = capacity, linear, schema
        self.sequence = TaskContext.get().partitionId() << 33
        self.held: list[tuple[pa.RecordBatch, int, np.ndarray, int]] = []
        self.tokens = 0

    def pieces(self, found: list[tuple]) -> pa.RecordBatch:
        """Rows of (batch, row, ids, start, doc_tokens, sequence, offset)."""
        kept = [
            pa.concat_arrays([batch.column(i).slice(row, 1) for batch, row, *_ in found])
            for i in range(len(self.schema) - len(PIECE))
        ]
        _, _, ids, start, total, sequence, offset = zip(*found, strict=True)
        made = [
            start,
            [len(i) for i in ids],
            [i.astype("<u4").tobytes() for i in ids],
            total,
            sequence,
            offset,
            [cost_of(len(i), self.linear) for i in ids],
        ]
        return pa.RecordBatch.from_arrays([*kept, *map(pa.array, made)], schema=self.schema)

    def add(self, batch: pa.RecordBatch, row: int, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Full sequences of a document go out at once, the rest is held."""
        size, length = len(ids), self.capacity
        whole = size - size % length
        for begin in range(0, whole, ROWS * length):
            starts = range(begin, min(whole, begin + ROWS * length), length)
            found = [
                (batch, row, ids[s : s + length], s, size, self.sequence + place, 0)
                for place, s in enumerate(starts)
            ]
            self.sequence += len(found)
            yield self.pieces(found)
        if size > whole:
            self.held.append((batch, row, ids[whole:].copy(), size))
            self.tokens += size - whole
        if self.tokens >= GROUP:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        """The pieces of the documents that are held."""
        lengths, last, found = [len(ids) for _, _, ids, _ in self.held], -1, []
        for document, start, length, sequence, offset in balanced(lengths, self.capacity, self.linear):
            batch, row, ids, size = self.held[document]
            part, begin = ids[start : start + length], size - len(ids) + start
            found.append((batch, row, part, begin, size, self.sequence + sequence, offset))
            last = max(last, sequence)
            if len(found) == ROWS:
                yield self.pieces(found)
                found = []
        if found:
            yield self.pieces(found)
        self.sequence += last + 1
        self.held, self.tokens = [], 0


def packing_batches(tables, capacity: int, linear: int, end: int, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = encoder_of(tables.value), Packer(capacity, linear, schema)
        for batch in batches:
            kept = batch.select(range(batch.num_columns - 1))
            for row, text in enumerate(batch.column(batch.num_columns - 1)):
                ids = np.append(encoder.encode(text.as_py() or ""), np.uint32(end))
                yield from packer.add(kept, row, ids)
        yield from packer.flush()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    kept: list[str],
    capacity: int = LENGTH,
    linear: int = COST,
    end: int = END,
) -> DataFrame:
    """A row for each piece: the columns ``kept`` of ``docs``, and

    - start, length and ids (32-bit little-endian numbers) of the piece in its document, whose
      number of tokens, the token ``end`` among them, is doc_tokens,
    - sequence_id, and offset, the piece's place there; cost, its share of the sequence's.

    Sequences have ``capacity`` tokens, or a power of two. The tokenizer's file is read by the driver
    and goes to the workers once.
    """
    with open(tokenizer, encoding="utf-8") as file:
        tables = docs.sparkSession.sparkContext.broadcast({"file": file.read()})
    kept = [name for name in kept if name not in PIECE]
    rows = docs.select(*[F.col(f"`{name}`") for name in kept], F.col("text").alias("__text"))
    schema = StructType(rows.schema.fields[:-1])
    for name, kind in PIECE.items():
        schema = schema.add(name, kind)
    return rows.mapInArrow(packing_batches(tables, capacity, linear, end, to_arrow_schema(schema)), schema)
