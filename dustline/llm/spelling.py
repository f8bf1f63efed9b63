"""Groups of spelling variants, by PartEnum signatures.

Two words are near if one inserted, deleted or replaced code point makes one of the other. The
letters of a word, each with the number of its occurrence, are a binary vector; vectors of near
words of the same length differ in two places, those of others in one. The places are parted by
letter: vectors that differ in d of k parts at most agree in some k - d of them, so each choice
of so many parts is a signature, and near words share one at least. Signatures are joined by
equality and what they bring together is verified.

Letters alone bring together what is written in another order, words made of the same syllables
above all. One change leaves one half of a word as it is, so a signature is of one half, as it is written,
and of the letters of the rest: an exact condition too, by which no near words are lost.

A word's form is its near word of largest count, if that is ``TIMES`` its own at least; ties take the smallest
in code-point order. Counts double along forms, so a chain of them has 62 words at most, and its
ends are found by doubling steps, six at most. Null and empty words are left out, repeated ones
are added up, an empty table has no groups. Long words are compared whole. Other columns of the input
play no part.
"""

from __future__ import annotations

import itertools
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dustline.llm.common import bound, staged_small
from dustline.sources.shared import staged

#: What no word has, and the bounds of words that are grouped.
NO_LETTERS = r"[^A-Za-zÀ-ÿ]+"
LEAST_POINTS, LEAST_COUNT = 5, 3
#: How many times as frequent as a word its form is.
TIMES = 2
#: Parts of the letters: for vectors that differ in two places, and in one.
PARTS_OF_TWO, PARTS_OF_ONE = 4, 3


def letter_runs(docs: DataFrame) -> DataFrame:
    """doc_id and run: each maximal sequence of letters, A to Z in lower case.

    A null text has none.
    """
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return docs.select("doc_id", F.explode(F.split(lower, NO_LETTERS)).alias("run")).where("run <> ''")


def count_words(
    runs: DataFrame, least_points: int = LEAST_POINTS, least_count: int = LEAST_COUNT
) -> DataFrame:
    """word and n: the distinct values of ``run`` that are long and frequent enough."""
    words = runs.where(F.length("run") >= least_points).groupBy(F.col("run").alias("word"))
    return words.agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def signatures(case: str, word: Column, shorter: Column, parts: int, differing: int) -> Column:
    """Signatures of a word for pairs whose shorter word has ``shorter`` code points."""
    length, half = F.length(word), F.floor(shorter / 2).cast("int")
    choices = list(itertools.combinations(range(parts), parts - differing))

    def of_side(side: Column) -> Column:
        letters = F.array_sort(F.split(side["rest"], ""))
        part = F.transform(
            F.sequence(F.lit(0), F.lit(parts - 1)),
            lambda k: F.array_join(F.filter(letters, lambda c: F.ascii(c) % parts == k), ""),
        )
        return bound(part, lambda p: F.array(*[
            F.xxhash64(
                F.lit(case), side["place"], shorter, side["half"], F.lit(str(choice)), *[p[k] for k in choice]
            )
            for choice in choices
        ]))

    first, rest = F.substring(word, F.lit(1), half), F.substring(word, half + 1, length - half)
    last, before = F.substring(word, length - half + 1, half), F.substring(word, F.lit(1), length - half)
    sides = F.array(
        *[
            F.struct(F.lit(place).alias("place"), own.alias("half"), other.alias("rest"))
            for place, (own, other) in enumerate([(first, rest), (last, before)])
        ]
    )
    return F.flatten(F.transform(sides, of_side))


def near_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b and n_b: each pair of near words once; ``words`` has word and n, each word once.

    Of words that differ in length a is the shorter one, of others the smaller one.
    """
    word, length = F.col("word"), F.length("word")
    alike = signatures("two", word, length, PARTS_OF_TWO, 2)
    as_shorter = signatures("one", word, length, PARTS_OF_ONE, 1)
    as_longer = signatures("one", word, length - 1, PARTS_OF_ONE, 1)

    def signed(other: Column, name: str) -> DataFrame:
        signature = F.explode(F.array_distinct(F.concat(alike, other))).alias("signature")
        return words.select(word.alias(name), F.col("n").alias(f"n_{name}"), signature)

    longer = F.length("b") - F.length("a")
    possible = (longer == 1) | (longer == 0) & (F.col("a") < F.col("b"))
    pairs = signed(as_shorter, "a").join(signed(as_longer, "b"), "signature")
    pairs = pairs.where(possible & (F.levenshtein("a", "b", 1) == 1))
    return pairs.select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame, rows: int) -> DataFrame:
    """word and root, the end of the chain of forms, of each word of ``forms`` (word, form).

    Each step doubles the links that a word has followed.
    """
    ends = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = ends.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        step = staged_small(step, "spelling-roots", rows)
        ends = step.select("word", "root")
        if step.where("moved").isEmpty():
            return ends


def group_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form, form_n and root: a row for each word of ``words`` (word and n)."""
    counted = words.where("word <> ''").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    counted = staged(counted, "spelling-words")

    def seen_from(word: str, other: str) -> Column:
        less = (-F.col(f"n_{other}")).alias("less")
        return F.struct(F.col(word).alias("word"), less, F.col(other).alias("other"))

    both = F.array(seen_from("a", "b"), seen_from("b", "a"))
    near = near_pairs(counted).select(F.inline(both))
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct("less", "other")).alias("best")
    )
    frequent = -F.col("best.less") >= times * F.col("n")
    formed = staged(
        counted.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, F.col("best.other")).alias("form"),
            F.when(frequent, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    linked = formed.where(F.col("form").isNotNull())
    found = roots(linked, linked.count())
    return formed.join(found, "word", "left").select(
        *formed.columns, F.coalesce("root", "word").alias("root")
    )
