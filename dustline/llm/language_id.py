"""Language identification by words first, falling back to character n-grams.

A model knows, for each language, the log frequency of frequent words and of the character
n-grams that words are made of. A word that is known scores by its own frequencies. One that is
not is read from its start, at each place by the longest n-gram that is known, trying shorter
ones in turn; the mean of their log frequencies stands for the word. A text's language is
the one with the largest sum over all its words, its score that language's share of the
likelihood.

Words are runs of letters in lower case. The model is fitted on a bounded sample of the rows
to learn from, drawn evenly by hash in each language, and it keeps a bounded number of words
and n-grams, those with the largest share of a language. Its tables are bounded by bytes, so with
more than some 200 languages they have fewer entries. A long text is scored in stretches of words;
words of any length are read whole. A null text, or one without letters, is ``und`` with score 0, and so is all without any row to learn from. Rows without
lang are not learned from. Of equal scores the first language by code points wins. Repeated
rows are scored alike. Other columns of the input play no part.
"""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dustline.sources.shared import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "und"
LONGEST_GRAM = 5
#: The sample: documents of a language, about, and documents and bytes of text in all.
SAMPLE_EACH = 4000
SAMPLE_DOCS = 40_000
SAMPLE_BYTES = 200_000_000
#: Words and n-grams that a model keeps.
WORDS = 60_000
GRAMS = 60_000
#: Added to every count.
SMOOTHING = 0.5
#: Bytes of each table of log frequencies, of words, n-grams and remembered words.
TABLE_BYTES = 48_000_000
#: Unknown words that a worker remembers the scores of, and their characters in all.
REMEMBERED = 250_000
REMEMBERED_CHARS = 32_000_000
#: Words of a text that are scored at once.
STRETCH = 10_000

ASCII_WORD = re.compile("[a-z]+")
LETTERS = regex.compile(r"\p{L}+")


def _short_letters() -> re.Pattern:
    """What ``LETTERS`` finds in texts without code points above U+FFFF, as a pattern of ``re``.

    That takes two thirds of the time.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    runs = "".join(f"{m[0][0]}-{m[0][-1]}" for m in LETTERS.finditer(every))
    return re.compile(f"[{runs}]+")


SHORT_LETTERS = _short_letters()


def words_of(text: str) -> list[str]:
    lowered = text.lower()
    if lowered.isascii():
        return ASCII_WORD.findall(lowered)
    is_short = len(lowered.encode("utf-16-le")) == 2 * len(lowered)
    return (SHORT_LETTERS if is_short else LETTERS).findall(lowered)


def grams_of(word: str, size: int) -> Iterator[str]:
    """n-grams of a word between blanks, so that its ends tell."""
    padded = f" {word} "
    return (padded[i : i + size] for i in range(len(padded) - size + 1))


def counted_batches(kind: str):
    """Counts of words, from (lang, text); or of n-grams, from (lang, gram, n) of words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = defaultdict(Counter)
            columns = [column.to_pylist() for column in batch.columns]
            if kind == "words":
                for lang, text in zip(*columns, strict=True):
                    counts[lang].update(words_of(text))
            else:
                for lang, word, n in zip(*columns, strict=True):
                    for size in range(1, LONGEST_GRAM + 1):
                        for gram in grams_of(word, size):
                            counts[lang][gram] += n
            rows = [(lang, g, n) for lang, of in counts.items() for g, n in of.items()]
            arrays = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(arrays[0], pa.string()), pa.array(arrays[1], pa.string()),
                 pa.array(arrays[2], pa.int64())],
                names=["lang", "gram", "n"],
            )

    return run


def equal_part(needs: list[int], total: int) -> int:
    """The part that each may have of a total, if those that need less leave the rest to others."""
    for place, need in enumerate(sorted(needs)):
        part = total // (len(needs) - place)
        if need > part:
            return part
        total -= need
    return max(needs, default=0)


def sample(rows: DataFrame) -> DataFrame:
    """A bounded sample of ``rows`` (lang, text, and doc_id to draw by), written.

    Rows are drawn by their hash, at least those of the least hash of each language. Should they
    be more than the bounds allow, each language gets an equal part of rows and bytes, in which
    those with less stay whole; the rest of a language is drawn by hash, texts of more than a
    hundredth of its part last, and one text at least. Repeated rows are counted one by one.
    """
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    counts = rows.groupBy("lang").agg(F.count("*").alias("docs"), F.min(draw).alias("least"))
    counts = staged(counts, "langid-counts")
    of_share = (draw * F.col("docs") < SAMPLE_EACH) | (draw == F.col("least"))
    drawn = rows.join(counts, "lang").where(of_share)
    drawn = drawn.select("lang", "text", F.xxhash64("doc_id", "text").alias("key"))
    sizes = drawn.withColumn("size", F.octet_length("text").cast("long"))
    needs = sizes.groupBy("lang").agg(F.count("*").alias("docs"), F.sum("size").alias("bytes"))
    needs = needs.select("docs", "bytes").collect()
    docs, size = [r["docs"] for r in needs], [r["bytes"] for r in needs]
    if sum(docs) > SAMPLE_DOCS or sum(size) > SAMPLE_BYTES:
        parts = equal_part(docs, SAMPLE_DOCS), equal_part(size, SAMPLE_BYTES)
        alike = sizes.groupBy("lang", "key", "size").agg(F.count("*").alias("n"))
        chosen = F.broadcast(staged(_parted(staged(alike, "langid-sizes"), *parts), "langid-chosen"))
        texts = drawn.join(chosen.select("lang", "key"), ["lang", "key"])
        texts = texts.groupBy("lang", "key").agg(F.first("text").alias("text"))
        drawn = texts.join(chosen, ["lang", "key"])
        drawn = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), "n")))
    return staged(drawn.select("lang", "text"), "langid-sample")


def _parted(alike: DataFrame, docs: int, size: int) -> DataFrame:
    """lang, key and n of ``alike`` (lang, key, size and n rows) within each language's part."""
    all_bytes = F.sum(F.col("size") * F.col("n"))
    is_long = (F.col("size") > size // 100) & (F.col("bytes") > size)
    known = alike.withColumn("bytes", all_bytes.over(Window.partitionBy("lang")))
    order = Window.partitionBy("lang").orderBy(is_long, F.when(is_long, F.col("size")), "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    known = known.select(
        "lang",
        "key",
        "n",
        "size",
        F.row_number().over(order).alias("place"),
        (docs - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("docs"),
        (size - F.coalesce(all_bytes.over(before), F.lit(0))).alias("left"),
    )
    fits = F.least("n", "docs", F.floor(F.try_divide("left", "size")))
    n = F.when(F.col("place") == 1, F.greatest(F.lit(1), fits)).otherwise(fits)
    return known.select("lang", "key", n.cast("int").alias("n")).where("n > 0")


def _logs(
    counts: DataFrame, most: int, languages: list[str], in_all: dict[tuple[str, int], int], is_word: bool
) -> tuple[dict[str, int], np.ndarray]:
    """The log frequencies, a row each, of those with the largest share of some language."""
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(totals, "lang").groupBy("gram").agg(
        F.max(F.col("n") / F.col("total")).alias("share")
    )
    most = min(most, TABLE_BYTES // (4 * max(1, len(languages))))
    chosen = staged(shares.orderBy(F.desc("share"), "gram").limit(most), "langid-frequent")
    places = {r["gram"]: i for i, r in enumerate(chosen.select("gram").orderBy("gram").toLocalIterator())}
    kinds = Counter(0 if is_word else len(gram) for gram in places)

    def log(n: int, lang: str, kind: int) -> float:
        return float(np.log((n + SMOOTHING) / (in_all.get((lang, kind), 0) + SMOOTHING * kinds[kind])))

    absent = {kind: [log(0, lang, kind) for lang in languages] for kind in kinds}
    table = np.zeros((len(places), len(languages)), np.float32)
    for gram, place in places.items():
        table[place] = absent[0 if is_word else len(gram)]
    columns = {lang: column for column, lang in enumerate(languages)}
    for gram, lang, n in counts.join(chosen, "gram").select("gram", "lang", "n").toLocalIterator():
        table[places[gram], columns[lang]] = log(n, lang, 0 if is_word else len(gram))
    return places, table


def fit(rows: DataFrame) -> dict:
    """A model of ``rows`` (lang and text, neither null, and doc_id).

    It is some 100 MB at most, as both of its tables are bounded by ``TABLE_BYTES``.
    """
    drawn = sample(rows)
    schema = "lang string, gram string, n long"
    total = F.sum("n").cast("long").alias("n")
    words = drawn.mapInArrow(counted_batches("words"), schema).groupBy("lang", "gram").agg(total)
    words = staged(words, "langid-words")
    grams = words.mapInArrow(counted_batches("grams"), schema).groupBy("lang", "gram").agg(total)
    grams = staged(grams, "langid-grams")
    size = F.length("gram").alias("size")
    in_all = {(r["lang"], 0): r["n"] for r in words.groupBy("lang").agg(total).collect()}
    of_size = grams.groupBy("lang", size).agg(total).collect()
    in_all |= {(r["lang"], r["size"]): r["n"] for r in of_size}
    languages = sorted(lang for lang, n in in_all if n == 0)
    known, word_logs = _logs(words, WORDS, languages, in_all, True)
    parts, gram_logs = _logs(grams, GRAMS, languages, in_all, False)
    return {
        "languages": languages, "words": known, "word_logs": word_logs, "grams": parts, "gram_logs": gram_logs
    }


class Scorer(dict):
    """The place of each word's scores in a table that grows by words that are not known."""

    def __init__(self, model: dict) -> None:
        super().__init__(model["words"])
        self.languages, self.grams, self.gram_logs = model["languages"], model["grams"], model["gram_logs"]
        self.known, self.chars = len(self), 0
        width = len(self.languages)
        more = max(1, min(REMEMBERED, TABLE_BYTES // (4 * max(1, width))))
        self.stretch = min(STRETCH, more)
        self.table = np.zeros((self.known + more, width), np.float32)
        self.table[: self.known] = model["word_logs"][: self.known]

    def backed_off(self, words: list[str]) -> np.ndarray:
        """The mean log frequencies of the n-grams that each word is read by; zeros if there are none."""
        grams, found, counts = self.grams, [], []
        for word in words:
            padded = f" {word} "
            places = [grams.get(padded[i : i + LONGEST_GRAM]) for i in range(len(padded))]
            if None in places:
                for i, place in enumerate(places):
                    end = i + LONGEST_GRAM - 1
                    while place is None and end > i:
                        place = grams.get(padded[i:end])
                        end -= 1
                    places[i] = place
                places = [place for place in places if place is not None]
            found += places
            counts.append(len(places))
        means = np.zeros((len(words), len(self.languages)))
        counts = np.array(counts)
        read = counts > 0
        if found:
            starts = (np.cumsum(counts) - counts)[read]
            sums = [np.add.reduceat(column[found], starts, dtype=float) for column in self.gram_logs.T]
            means[read] = np.stack(sums, axis=1) / counts[read, None]
        return means

    def remember(self, words: list[str]) -> None:
        """Put the scores of ``words``, none of which has a place, in the table."""
        place = len(self)
        self.table[place : place + len(words)] = self.backed_off(words)
        self.update(zip(words, range(place, place + len(words)), strict=True))
        self.chars += sum(map(len, words))

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text or "")
        if not words or not self.languages:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.languages))
        for start in range(0, len(words), self.stretch):
            some = words[start : start + self.stretch]
            if len(self) + len(some) > len(self.table) or self.chars > REMEMBERED_CHARS:
                for word in list(self)[self.known :]:
                    del self[word]
                self.chars = 0
            new = [word for word in dict.fromkeys(some) if word not in self]
            if new:
                self.remember(new)
            places = np.fromiter(map(self.__getitem__, some), np.int64, len(some))
            total += self.table[places].sum(axis=0, dtype=float)
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def scorer_of(model: dict) -> Scorer:
    """The scorer of a model that was sent to a worker, which keeps it for its later tasks."""
    if "scorer" not in model:
        model["scorer"] = Scorer(model)
    return model["scorer"]


def predict_batches(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(model.value)
        for batch in batches:
            found = [scorer.predict(text.as_py()) for text in batch.column("__text")]
            names = batch.schema.names[:-1]
            columns = [batch.column(name) for name in names]
            columns.append(pa.array([lang for lang, _ in found], pa.string()))
            columns.append(pa.array([score for _, score in found], pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: dict, kept: list[str]) -> DataFrame:
    """The columns ``kept`` of ``docs`` with lang_pred and score; only texts are looked at."""
    rows = docs.select(*kept, F.col("text").alias("__text"))
    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(predict_batches(sent), schema)


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: the CRC-32 of doc_id as text, a null as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % folds


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score; learned from the rows that are not held out."""
    held = fold(F.col("doc_id"), folds) == held_out
    learned = docs.where(~held & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = fit(learned.select("doc_id", "lang", "text"))
    rows = docs.select("doc_id", "text", held.alias("held_out"))
    return predict(rows, model, ["doc_id", "held_out"])
