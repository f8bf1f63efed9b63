"""Quality rules with thresholds that adapt to each language and source.

A document is measured in one pass: shares of symbols, of lines that repeat an earlier one and
of words in repeated 3-word windows, and the mean length of its words. For each language and
source a quantile sketch of every measure is kept: the number of documents in each of a bounded
number of bins, which are equal but for words of more than 81 code points, where a bin is as
wide as a 4,096th of its values at most. Sketches merge by adding the counts of a bin, in any
order and without loss, and a quantile read from one is off by a bin at most. Thresholds are a
fence round the quartiles, as wide as some times their distance but no narrower than a
tolerance; a document's own value is held against them, however large it is. A
language and source with few documents gets the merged sketch of its language, a language with
few that of all documents. The thresholds are joined to the documents by language and source.

Null and empty texts have no words and fail the base rules; documents that do are not
sketched. A null language or source is a group of its own. Repeated rows count as often as
they occur. In an empty table, or where no document passes the base rules, there are no
thresholds to fail. Long texts are measured whole. Two windows count as equal if their 64-bit hashes are. Other columns of
the input play no part; those with the names of results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dustline.llm.common import SPACE, WORD, bound, staged_small
from dustline.sources.shared import staged

MIN_WORDS = 50
#: Of 100 words, so many may lie in repeated windows.
MAX_REPEATED = 50
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3

#: Documents that a sketch needs before its thresholds are used.
MIN_DOCS = 100
#: Distances between quartiles that a measure may lie off them.
FENCE = 3
#: Bins that the fence spans at least: thousandths of a share, hundredths of a code point.
TOLERANCE = {"symbols": 50, "lines": 400, "repeats": 300, "length": 150}
#: Binary digits of a value that tell its bin: values of no more have a bin each.
DIGITS = 13
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _repeated_words(words: Column) -> Column:
    """Words in windows that occur twice or more, the first occurrence included."""

    def window(start: Column) -> Column:
        return F.xxhash64(*[F.get(words, start + i) for i in range(WINDOW)])

    def covered(hashes: Column) -> Column:
        places = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def starts(ordered: Column) -> Column:
            def twice(x: Column, i: Column) -> Column:
                before = F.when(i > 0, F.get(ordered, i - 1)["h"])
                after = F.get(ordered, i + 1)["h"]
                return before.eqNullSafe(x["h"]) | after.eqNullSafe(x["h"])

            return F.filter(ordered, twice)

        def every(x: Column) -> Column:
            return F.array(*[x["i"] + i for i in range(WINDOW)])

        repeated = bound(F.sort_array(places), starts)
        return F.size(F.array_distinct(F.flatten(F.transform(repeated, every))))

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window)
    found = bound(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0),
    )
    return F.when(F.size(words) >= WINDOW, found).otherwise(0)


def counts(text: Column) -> Column:
    """A struct of what is counted in a text."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, f"{SPACE}+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    of_words = bound(
        words,
        lambda w: F.struct(F.size(w).alias("n"), _repeated_words(w).alias("repeated")),
    )
    of_lines = bound(
        lines,
        lambda x: F.struct(
            F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("repeated")
        ),
    )
    return F.struct(
        of_words.alias("words"),
        F.length(F.regexp_replace(text, f"{SPACE}+", "")).alias("chars"),
        (F.length(text) - F.length(F.regexp_replace(text, f"{SYMBOLS}+", ""))).alias("symbols"),
        of_lines.alias("lines"),
    )


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and a struct ``__q`` of counts."""
    found = docs.select(*keep, counts(F.col("text")).alias("__c"))
    values = {
        "n_words": "words.n",
        "word_chars": "chars",
        "n_symbols": "symbols",
        "n_lines": "lines.n",
        "n_dup_lines": "lines.repeated",
        "n_repeat_words": "words.repeated",
    }
    parts = [F.col(f"__c.{path}").cast("long").alias(name) for name, path in values.items()]
    return found.select(*keep, F.struct(*parts).alias("__q"))


def _count(name: str) -> Column:
    return F.col(f"__q.{name}")


def base_failed() -> Column:
    repeated = 100 * _count("n_repeat_words") > MAX_REPEATED * _count("n_words")
    return (_count("n_words") < MIN_WORDS) | repeated


def values() -> dict[str, Column]:
    """Each measure in whole numbers; for documents that have words."""

    def share(part: str, whole: str, scale: int) -> Column:
        return F.floor(F.try_divide(scale * _count(part), _count(whole)))

    return {
        "symbols": share("n_symbols", "word_chars", 1000),
        "lines": share("n_dup_lines", "n_lines", 1000),
        "repeats": share("n_repeat_words", "n_words", 1000),
        "length": share("word_chars", "n_words", 100),
    }


def width(value: Column) -> Column:
    """How many values share the bin of ``value``: one, or a power of two for large ones."""
    more = F.greatest(F.lit(0), F.length(F.bin(value)) - DIGITS)
    return F.call_function("shiftleft", F.lit(1).cast("long"), more)


def bins() -> dict[str, Column]:
    """The bin of each measure: the least value in it."""
    return {name: value - value % width(value) for name, value in values().items()}


def sketches(rows: DataFrame) -> DataFrame:
    """For each lang and source a sketch of every measure: lang, source, measure, bin, docs."""
    each = [F.struct(F.lit(name).alias("measure"), b.alias("bin")) for name, b in bins().items()]
    passed = rows.where(~base_failed())
    return (
        passed.select("lang", "source", F.explode(F.array(*each)).alias("x"))
        .groupBy("lang", "source", "x.measure", "x.bin")
        .agg(F.count("*").alias("docs"))
    )


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of all that has the same values of ``by`` as one."""
    return sketch.groupBy(*by, "measure", "bin").agg(F.sum("docs").alias("docs"))


def fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """docs, low and high of each measure, a row for each group: the thresholds of sketches."""
    key = Window.partitionBy(*by, "measure")
    upto = key.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sketch.select(
        *by, "measure", "bin", F.sum("docs").over(upto).alias("upto"), F.sum("docs").over(key).alias("n")
    )

    def quantile(quarters: int) -> Column:
        return F.min(F.when(4 * F.col("upto") >= quarters * F.col("n"), F.col("bin")))

    # From the least value of the lower bin to the largest of the upper one, so that no document
    # between the quartiles is beyond a fence.
    top = (quantile(3) + width(quantile(3)) - 1).alias("q3")
    quartiles = ranked.groupBy(*by, "measure").agg(F.max("n").alias("n"), quantile(1).alias("q1"), top)
    tolerance = F.create_map(*[F.lit(x) for pair in TOLERANCE.items() for x in pair])
    fence = F.greatest(FENCE * (F.col("q3") - F.col("q1")), tolerance[F.col("measure")])
    limits = F.struct((F.col("q1") - fence).alias("low"), (F.col("q3") + fence).alias("high"))
    columns = [
        F.max(F.when(F.col("measure") == name, limits)).alias(name) for name in TOLERANCE
    ]
    return quartiles.groupBy(*by).agg(F.max("n").alias("docs"), *columns)


def thresholds(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The thresholds to use for each lang and source: a struct for each measure."""
    sketch = staged_small(sketches(rows), "quality-sketches", len(TOLERANCE) * rows.count())
    groups = sketch.count()
    fine = fences(sketch, ["lang", "source"]).alias("f")
    by_lang = fences(merged(sketch, ["lang"]), ["lang"])
    by_lang = staged_small(by_lang, "quality-languages", groups).alias("l")
    total = fences(merged(sketch, []), []).first()
    joined = fine.join(by_lang, F.expr("f.lang <=> l.lang"))

    def chosen(name: str) -> Column:
        overall = F.struct(
            F.lit(total[name]["low"] if total and total[name] else None).cast("long").alias("low"),
            F.lit(total[name]["high"] if total and total[name] else None).cast("long").alias("high"),
        )
        return (
            F.when(F.col("f.docs") >= min_docs, F.col(f"f.{name}"))
            .when(F.col("l.docs") >= min_docs, F.col(f"l.{name}"))
            .otherwise(overall)
            .alias(name)
        )

    limits = F.struct(*[chosen(name) for name in TOLERANCE]).alias("__t")
    chosen_limits = joined.select("f.lang", "f.source", limits)
    return staged_small(chosen_limits, "quality-thresholds", groups)


def judged(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``rows`` (lang, source, ``__q``; written) with base_failed, failed and kept.

    ``failed`` lists the measures beyond their thresholds. A document that passes the base
    rules always finds its thresholds, for its own group was sketched with it.
    """
    limits = thresholds(rows, min_docs).alias("t")
    joined = rows.alias("d").join(
        limits, F.expr("d.lang <=> t.lang AND d.source <=> t.source"), "left"
    )
    joined = joined.select("d.*", F.coalesce(base_failed(), F.lit(True)).alias("base_failed"), "__t")
    beyond = [
        F.when(
            (b > F.col(f"__t.{name}.high"))
            | (F.lit(name == "length") & (b < F.col(f"__t.{name}.low"))),
            F.lit(name),
        )
        for name, b in values().items()
    ]
    failed = F.when(~F.col("base_failed"), F.array_compact(F.array(*beyond)))
    failed = F.coalesce(failed, F.array().cast("array<string>")).alias("failed")
    judged_rows = joined.select(*rows.columns, "base_failed", failed)
    kept = ~F.col("base_failed") & (F.size("failed") == 0)
    return judged_rows.withColumn("kept", kept)


def judge(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, the counts, base_failed, failed and kept: a row for each row of ``docs``."""
    rows = staged(measured(docs, ["doc_id", "lang", "source"]), "quality-measures")
    found = judged(rows, min_docs)
    return found.select(
        "doc_id", *[F.col(f"__q.{name}") for name in COUNTS], "base_failed", "failed", "kept"
    )


def keep(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("__doc")
    rows = measured(docs.select("lang", "source", "text", whole), ["lang", "source", "__doc"])
    found = judged(staged(rows, "quality-documents"), min_docs)
    return found.where("kept").select("__doc.*")
