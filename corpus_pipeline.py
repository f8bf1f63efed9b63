"""From raw documents to a tokenized mix, stage by stage.

Every stage takes all rows that the one before it kept and decides on their whole texts. All
but the last return the columns of ``documents``. What comes into a stage is a table as it was read
from its files.

Null and empty texts fail the quality rules, so later stages meet none of ``documents``; given some, they
count them as empty: one of them stays after exact dedup, they take no words of the mix, and
have no ids. Null ids, languages and sources pass through. Long texts are worked on whole, repeated rows
are copies, ties go to the smaller doc_id, and an empty table gives an empty one. Columns beside those
of ``documents``, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dustline.llm import bpe, exact_dedup, mixing, quality_rules, simhash
from dustline.llm.common import documents
from dustline.llm.queries import tokenizer
from dustline.sources.shared import staged


def pass_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the adaptive thresholds reject."""
    return quality_rules.keep(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs, written=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.deduplicate(docs, simhash.SHINGLE, simhash.RADIUS, written=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs, written=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source with n_tokens, ids and decoded, what the ids stand for."""
    return bpe.transcode(docs, tokenizer(), ["doc_id", "lang", "source"])


STAGES = [
    ("quality rules", pass_quality_rules),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("bpe encoding and decoding", encode),
]

#: SQL has no XXH64 for the fingerprints of near copies; the tests hold the stages against
#: plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next one reads it."""
    docs = documents(spark, sf_dir)
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = staged(docs, "pipeline")
    return docs
