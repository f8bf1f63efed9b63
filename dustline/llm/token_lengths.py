"""Token counts as an exact histogram of encoded lengths.

Documents are encoded, and all that is kept of one is its number of tokens: documents are
counted by length where they lie, before anything is shuffled. The histogram has a row for each
length that occurs, however many documents there are. Suffix sums over it, from the longest
length down, answer for every context limit how many tokens the corpus has, what share
of documents fits and how many tokens are left if each document is cut at the limit.

A null text has no tokens, like an empty one; a long one is encoded whole, in stretches. Repeated rows count as often as they occur. An
empty table has an empty histogram. Other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dustline.llm.bpe import transcode
from dustline.llm.common import running_total
from dustline.sources.shared import staged


def histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """length and n_docs: a row for each length that occurs."""
    lengths = transcode(docs.select("text"), tokenizer, [], ("n_tokens",))
    counted = lengths.groupBy(F.col("n_tokens").alias("length"))
    return counted.agg(F.count("*").alias("n_docs"))


def suffix_sums(lengths: DataFrame) -> DataFrame:
    """``lengths`` (length, n_docs; written) with, for each length as a context limit:

    - docs_from and tokens_from: documents at least as long, and their tokens,
    - docs_within and share_within: documents that fit, as a number and as a share,
    - tokens: of all documents; truncated_tokens: of all documents, each cut at the limit.

    A limit C between two lengths has the docs_from and tokens_from of the next longer length;
    cut at C, the corpus has tokens - tokens_from + C * docs_from.
    """
    counted = lengths.withColumn("__tokens", F.col("length") * F.col("n_docs"))
    order = [F.col("length").desc()]
    most = lengths.count()
    sums = running_total(counted, order, "n_docs", "docs_from", "lengths-docs", most)
    sums = running_total(sums, order, "__tokens", "tokens_from", "lengths-tokens", most)
    total = counted.agg(F.sum("n_docs").alias("docs"), F.sum("__tokens").alias("tokens")).first()
    docs, tokens = total["docs"] or 0, total["tokens"] or 0
    within = F.lit(docs) - F.col("docs_from") + F.col("n_docs")
    cut = F.lit(tokens) - F.col("tokens_from") + F.col("length") * F.col("docs_from")
    return sums.select(
        "length",
        "n_docs",
        "docs_from",
        "tokens_from",
        within.cast("long").alias("docs_within"),
        (within / F.lit(float(max(docs, 1)))).alias("share_within"),
        F.lit(tokens).cast("long").alias("tokens"),
        cut.cast("long").alias("truncated_tokens"),
    )


def quantiles(sums: DataFrame, shares: Iterable[float]) -> DataFrame:
    """share and length: the least length within which at least that share of documents fits."""
    wanted = F.explode(F.array(*[F.lit(float(share)) for share in shares]))
    fits = sums.select(wanted.alias("share"), "share_within", "length")
    fits = fits.where(F.col("share_within") >= F.col("share"))
    return fits.groupBy("share").agg(F.min("length").alias("length"))


def at_limits(sums: DataFrame, limits: Iterable[int]) -> DataFrame:
    """For each context limit: docs_beyond it, and truncated_tokens of all documents."""
    wanted = F.explode(F.array(*[F.lit(int(limit)).cast("long") for limit in limits]))
    cut = F.least("length", "context")
    return (
        sums.select(wanted.alias("context"), "length", "n_docs")
        .groupBy("context")
        .agg(
            F.sum(F.when(F.col("length") > F.col("context"), F.col("n_docs")).otherwise(0)).alias(
                "docs_beyond"
            ),
            F.sum(cut * F.col("n_docs")).alias("truncated_tokens"),
        )
    )


def token_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The histogram of ``docs`` with its suffix sums."""
    return suffix_sums(staged(histogram(docs, tokenizer), "lengths-histogram"))
