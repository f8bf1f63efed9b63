"""The registered query of each operator: digests of its result over all documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dustline.llm import (
    bpe,
    exact_dedup,
    language_id,
    mixing,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    spelling,
    token_lengths,
)
from dustline.llm.common import ROW, WORD, bound, documents, numbered

#: The tokenizers of the registered queries. The BPE automaton takes the path of any of its kind
#: and refuses others; packing takes any.
TOKENIZER = "word_bpe_49k.json"
PACKED_TOKENIZER = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = mixing.word_count(F.col("text")).alias("size")
    sized = numbered(documents(spark, sf_dir).select("doc_id", "source", size), "mix-sized")
    return mixing.mix_plan(sized).drop(ROW)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).withColumn(
        "failed", F.array_join("failed", ",")
    )


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.find_near_copies(documents(spark, sf_dir))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(documents(spark, sf_dir))

    def listed(findings: Column) -> Column:
        each = F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
        return F.array_join(each, ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")

    base = F.filter("findings", lambda x: x["kind"].isin(*secret_scan.BASE))
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in secret_scan.BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("findings")).alias("spans"),
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.transcode(documents(spark, sf_dir), tokenizer(), ["doc_id"])
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir), [1.0] * sharding.SHARDS)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.select("doc_id", F.col("quality").alias("label"))
    return quality_classifier.classify(documents(spark, sf_dir), labels)


def op10_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lengths.token_lengths(documents(spark, sf_dir), tokenizer())


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; of a tenth of the documents, by hash, the words from one on repeat.

    In these, each word from place a on becomes that of place a + (i - a) % p.
    """
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    drawn = F.floor(hashed / 10).cast("long")

    def repeated(x: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(x["words"]) - 1)
        again = lambda i: F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"])
        return F.array_join(F.transform(places, lambda i: F.get(x["words"], again(i))), " ")

    def placed(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = drawn % n
        p = 1 + F.floor((n - a) / (3 + drawn % 8)).cast("long")
        whole = F.struct(words.alias("words"), a.cast("int").alias("a"), p.cast("int").alias("p"))
        return F.when(n > 0, bound(whole, repeated)).otherwise(F.col("text"))

    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    text = F.when(hashed % 10 == 0, bound(words, placed)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_repeats(documents(spark, sf_dir))
    found = periodic_runs.periodic_runs(docs, ["doc_id"])
    # The longest run; of equal ones the first, then that of the smallest period.
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run")))
    )["run"]
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    longest = found.withColumn("__best", best)
    exponent = F.floor(1000 * F.col("__best.length") / F.col("__best.period"))
    return longest.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"__best.{name}").alias(name) for name in ("start", "length", "period")],
        exponent.cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), tokenizer(PACKED_TOKENIZER), ["doc_id"])
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "cost",
    )


def with_slips(runs: DataFrame) -> DataFrame:
    """``runs`` with one code point less where 97 divides the hash of doc_id and run."""
    hashed = F.crc32(F.concat_ws(":", F.col("doc_id").cast("string"), "run").cast("binary"))
    place = (hashed % F.length("run")).cast("int")
    less = F.concat(
        F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run"))
    )
    return runs.select("doc_id", F.when(hashed % 97 == 0, less).otherwise(F.col("run")).alias("run"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = with_slips(spelling.letter_runs(documents(spark, sf_dir)))
    return spelling.group_variants(spelling.count_words(runs))


def queries() -> dict[str, Query]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_language_id": op3_language_id,
        "op4_quality_rules": op4_quality_rules,
        "op5_simhash_dedup": op5_simhash_dedup,
        "op6_secret_scan": op6_secret_scan,
        "op7_bpe": op7_bpe,
        "op8_rendezvous_shards": op8_rendezvous_shards,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_token_lengths": op10_token_lengths,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_packing": op12_packing,
        "op13_spelling_variants": op13_spelling_variants,
    }
