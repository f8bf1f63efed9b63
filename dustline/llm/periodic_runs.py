"""Periodic runs of words, by recompression.

A run is a stretch of words in which words a period apart are identical, as long as
``least_length`` and as ``least_repeats`` times its smallest period, and that no neighbouring
word extends. Texts are read in groups of about ``GROUP`` words, parted by symbols that occur
once. The words of a group become a run-length grammar: in turn, blocks of one symbol
are replaced (each length by a symbol of its own), then pairs of symbols from two halves of the
alphabet, until no symbol occurs twice. Equal stretches are parsed alike but for their ends, so
the grammar tells how far two places agree in a few steps up its levels and a few down.

A run of period q has at least ``least - q`` places in a row whose word comes again q words
later, ``least`` being its least length. A grid of that step meets it: over all periods a harmonic
sum of candidates, n log n for n words. Where both words of a candidate are equal, the grammar
gives the exact extension to either side. Of the periods of one stretch the smallest is kept.

Words are maximal sequences without white space. Null, empty and blank texts have no words, no runs
and an empty collapsed text. Long texts are read whole, in a group of their own; the grammar
takes some 100 bytes for each of their words, whatever its period. Repeated rows and texts get the
same runs each, an empty table none. Columns of the input pass through if they are named in ``kept``.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import compress, count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A run is at least so long, and so many times its period.
LEAST_LENGTH, LEAST_REPEATS = 6, 4
#: Words, or rows, of a grammar; a text of more words has one of its own.
GROUP = 200_000
#: Candidates that are looked at together.
CANDIDATES = 1 << 21

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = ArrayType(StructType().add("start", "long").add("length", "long").add("period", "long"))


def halves(symbols: int, turn: int) -> np.ndarray:
    """One of two halves for each symbol, other ones in each turn."""
    mixed = (np.arange(1, symbols + 1, dtype=np.uint64) + np.uint64(turn << 32)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63)).astype(bool)


class Grammar:
    """Symbols, level by level, each level below the one that is made from it.

    All levels lie one after the other in ``symbol``; ``child`` is the first node below a node and
    ``parent`` the one above it. Symbols are compared within a level only.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        levels, starts, self.in_blocks = [symbols], [], []
        turn = 0
        while (found := int(levels[-1].max()) + 1) < len(levels[-1]):
            if turn % 2 == 0:
                opens, inner = self._blocks(levels[-1])
            else:
                opens, inner = self._pairs(levels[-1], halves(found, turn))
            turn += 1
            if len(opens) == len(levels[-1]):
                continue
            key = levels[-1][opens] * (int(inner.max()) + 1) + inner
            self.in_blocks.append(turn % 2 == 1)
            starts.append(opens)
            levels.append(pd.factorize(key)[0])
        sizes = [len(level) for level in levels]
        first = np.cumsum([0, *sizes])
        end = int(first[-1])
        # A node above the top, of which nothing is a child, and one more to look past it.
        self.symbol = np.concatenate([*levels, [-1]]).astype(np.int32)
        self.child = np.full(end + 2, -1, np.int32)
        self.parent = np.full(end + 1, end, np.int32)
        for level, opens in enumerate(starts):
            low, high = first[level], first[level + 1]
            self.child[high : high + len(opens)] = low + opens
            inside = np.zeros(sizes[level], np.int32)
            inside[opens] = 1
            self.parent[low:high] = high - 1 + np.cumsum(inside)
        self.child[end] = first[-2]
        self.top = end
        self.in_blocks = np.array([*self.in_blocks, False])

    @staticmethod
    def _blocks(level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        opens = np.flatnonzero(np.r_[True, level[1:] != level[:-1]])
        return opens, np.diff(np.r_[opens, len(level)])

    @staticmethod
    def _pairs(level: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of both orders of the halves, the one with more pairs."""
        side = half[level]
        up, down = ~side[:-1] & side[1:], side[:-1] & ~side[1:]
        pair = up if np.count_nonzero(up) >= np.count_nonzero(down) else down
        opens = np.flatnonzero(~np.r_[False, pair])
        second = np.zeros(len(level), np.int64)
        second[:-1][pair] = level[1:][pair] + 1
        return opens, second[opens]

    def agree(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from places ``x`` and ``y`` on, to the right (step 1) or to
        the left (step -1). Places of a pair differ.

        A pair of nodes goes up while their parents are alike and begin with them, passes by
        each other while they are alike, and goes down where they are not.
        """
        child, parent, symbol = self.child, self.parent, self.symbol
        begun, out = x, np.zeros(len(x), np.int64)
        place, level = np.arange(len(x)), np.zeros(len(x), np.int32)

        def outer(node: np.ndarray) -> np.ndarray:
            return child[node] if step > 0 else child[node + 1] - 1

        def left(node: np.ndarray, above: np.ndarray) -> np.ndarray:
            """Nodes of the parent from this one on."""
            return child[above + 1] - node if step > 0 else node - child[above] + 1

        while len(place):
            over, under = parent[x], parent[y]
            up = (symbol[over] == symbol[under]) & (over != self.top)
            up &= (outer(over) == x) & (outer(under) == y)
            alike = symbol[x] == symbol[y]
            ended = ~alike & (level == 0)
            if ended.any():
                out[place[ended]] = np.abs(x[ended] - begun[place[ended]])
                going = ~ended
                place, level, x, y = place[going], level[going], x[going], y[going]
                over, under, up, alike = over[going], under[going], up[going], alike[going]
            block = self.in_blocks[level] & (over != self.top)
            passed = np.where(block, np.minimum(left(x, over), left(y, under)), 1) * step
            down = ~up & ~alike
            x, y = (
                np.where(up, above, np.where(alike, node + passed, outer(node))).astype(np.int32)
                for node, above in ((x, over), (y, under))
            )
            level = level + up - down
        return out


def candidates(first: np.ndarray, words: np.ndarray, least_length: int, least_repeats: int) -> Iterator:
    """The grid: places and periods, for texts that begin at ``first`` and have ``words``."""
    periods = np.where(words >= least_length, words // least_repeats, 0)
    text = np.repeat(np.arange(len(words)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(least_length, least_repeats * period) - period
    amount = (words[text] - period - 1) // step + 1
    upto = np.cumsum(amount)
    start = 0
    while start < len(text):
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + CANDIDATES, "right")))
        some = slice(start, end)
        each = np.repeat(np.arange(start, end), amount[some])
        number = np.arange(len(each)) - np.repeat(upto[some] - amount[some] - before, amount[some])
        yield first[text[each]] + number * step[each], period[each]
        start = end


def find_runs(
    symbols: np.ndarray, first: np.ndarray, words: np.ndarray, least_length: int, least_repeats: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, by start, then period.

    Texts begin at ``first`` in ``symbols`` and have so many ``words``; before, between and
    after them are symbols that occur once. Symbols are 0, 1, 2, ...
    """
    grammar = None
    found: list[np.ndarray] = []
    for place, period in candidates(first, words, least_length, least_repeats):
        same = symbols[place] == symbols[place + period]
        place, period = place[same].astype(np.int32), period[same].astype(np.int32)
        if not len(place):
            continue
        grammar = grammar or Grammar(symbols)
        right = grammar.agree(place, place + period, 1)
        left = grammar.agree(place - 1, place - 1 + period, -1)
        run = np.stack([place - left, left + right + period, period]).astype(np.int64)
        found.append(run[:, run[1] >= np.maximum(least_length, least_repeats * run[2])])
    runs = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
    runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
    if runs.shape[1]:
        new = (runs[:2, 1:] != runs[:2, :-1]).any(axis=0)
        runs = runs[:, np.r_[True, new]]
        runs = runs[:, np.lexsort((runs[2], runs[0]))]
    return runs[0], runs[1], runs[2]


def runs_of_texts(texts: list[list[bytes]], least_length: int, least_repeats: int) -> tuple:
    """For texts as lists of words: runs as an Arrow array, and the collapsed texts."""
    words = np.array([len(text) for text in texts], np.int64)
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    # A separator before each text and after the last.
    first = np.cumsum(words + 1) - words
    symbols = np.empty(int(words.sum()) + len(texts) + 1, np.int64)
    for text, start in zip(texts, first.tolist(), strict=True):
        symbols[start : start + len(text)] = np.fromiter(map(numbers.__getitem__, text), np.int64, len(text))
    symbols[np.r_[first - 1, len(symbols) - 1]] = len(numbers) + np.arange(len(texts) + 1)

    start, length, period = find_runs(symbols, first, words, least_length, least_repeats)
    text = np.searchsorted(first, start, "right") - 1
    rows = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(texts)))]).astype(np.int32)
    columns = [pa.array(start - first[text]), pa.array(length), pa.array(period)]
    runs = pa.ListArray.from_arrays(pa.array(rows), pa.StructArray.from_arrays(columns, fields=list(RUN)))

    gone = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, start + length, -1)
    stay = np.cumsum(gone)[:-1] == 0
    collapsed = [
        b" ".join(words if kept.all() else compress(words, kept))
        for words, begin in zip(texts, first.tolist(), strict=True)
        for kept in (stay[begin : begin + len(words)],)
    ]
    return runs, pa.array(collapsed, pa.binary()).cast(pa.string())


def run_batches(least_length: int, least_repeats: int, names: list[str]):
    def out(batch: pa.RecordBatch, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of_texts(texts, least_length, least_repeats)
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, size, begun = [], 0, 0
            for row, text in enumerate(batch.column(batch.num_columns - 1)):
                words = (text.as_py() or b"").split()
                if texts and size + len(words) > GROUP:
                    yield out(batch.slice(begun, row - begun), texts)
                    texts, size, begun = [], 0, row
                texts.append(words)
                size += len(words) + 1
            if texts:
                yield out(batch.slice(begun), texts)

    return run


def periodic_runs(
    docs: DataFrame,
    kept: list[str],
    least_length: int = LEAST_LENGTH,
    least_repeats: int = LEAST_REPEATS,
) -> DataFrame:
    """The columns ``kept`` of ``docs``, and of each text:

    - runs: an array of (start, length, period) in words, by start, then period,
    - collapsed: the words that no run contains after its first period, parted by a blank.

    Runs take at least two repeats to tell periods apart, so ``least_repeats`` is 2 or more.
    """
    if least_repeats < 2 or least_length < 2:
        raise ValueError("runs of fewer than two repeats or words")
    kept = [name for name in kept if name not in ("runs", "collapsed")]
    # Bytes part at white space as words are defined here; texts may part at more.
    text = F.col("text").cast("binary").alias("__text")
    rows = docs.select(*[F.col(f"`{name}`") for name in kept], text)
    schema = StructType(rows.schema.fields[:-1]).add("runs", RUNS).add("collapsed", "string")
    names = [*kept, "runs", "collapsed"]
    return rows.mapInArrow(run_batches(least_length, least_repeats, names), schema)
