"""Secret scans over an incremental ledger of blobs.

The unit that is scanned is a blob: a text under its content address, the SHA-256 of its
UTF-8. Every path and every historical version of a path that holds the same text refers to
the same blob. The ledger records which versions of which rules have scanned a blob, with a
row for each finding. A run adds what is missing only: blobs that the ledger does not have,
and for those it has, rules with a version that it has not seen. Findings are then joined
back to all rows that hold the blob.

A null text is the empty blob, which has no finding. Long texts are scanned whole. Equal rows share a blob and each get its
findings. An empty table adds nothing. Other columns of the input play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dustline.llm.common import bound, files_for
from dustline.sources.shared import new_folder, staged

#: Addresses that are sent to all tasks at most, some 30 MB.
SENT = 200_000

PAIRS = "blob string, rule string"
FINDINGS = "blob string, rule string, start int, end int"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match of ``pattern`` is a finding if its group ``tested`` has
    ``least`` code points; matches do not overlap, also those that are no finding. A text
    without ``hint`` has none, which is quicker to see."""

    kind: str
    version: int
    pattern: str
    tested: int = 0
    least: int = 0
    hint: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


ASSIGNED = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
#: In the order in which findings with one start are listed. The first three are the base.
RULES = [
    Rule("assign", 1, ASSIGNED + r"([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, "PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 0, "eyJ"),
]
BASE = ("assign", "access", "hex")


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


class Ledger:
    """Scanned pairs of blob and rule, and their findings, as tables below one folder."""

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark = spark
        self.path = path or new_folder(spark, "secret-ledger")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not files.exists(path):
            columns = [column.split() for column in schema.split(", ")]
            return self.spark.range(0).select(
                *[F.lit(None).cast(kind).alias(column) for column, kind in columns]
            )
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def pairs(self) -> DataFrame:
        return self._read("pairs", PAIRS)

    def findings(self) -> DataFrame:
        """Each finding once, also if a run wrote findings and was lost before their pairs."""
        return self._read("findings", FINDINGS).distinct()

    def add(self, pairs: DataFrame, findings: DataFrame, files: int) -> None:
        """Findings first: a pair that is in the ledger has all its findings there."""
        findings.coalesce(files).write.mode("append").parquet(f"{self.path}/findings")
        pairs.coalesce(files).write.mode("append").parquet(f"{self.path}/pairs")


def _matches(text: Column, rule: Rule) -> Column:
    """For each match the code points from the end of the one before to its start, its own,
    and those of the tested group. What follows the last match is of no use."""

    def parts(group: int) -> Column:
        return F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group))

    def lengths(x: Column) -> Column:
        def of_match(own: Column, place: Column) -> Column:
            gap, tested = F.get(x["gaps"], place), F.get(x["tested"], place)
            return F.struct(*[
                F.length(part).alias(name)
                for name, part in (("gap", gap), ("own", own), ("tested", tested))
            ])

        return F.transform(x["own"], of_match)

    found = F.struct(
        F.split(text, rule.pattern, -1).alias("gaps"),
        parts(0).alias("own"),
        parts(rule.tested).alias("tested"),
    )
    found = bound(found, lengths)
    possible = text.contains(rule.hint) if rule.hint else F.lit(True)
    return F.when(possible & text.rlike(rule.pattern), found)


def due_pairs(blobs: DataFrame, ledger: Ledger, rules: list[Rule]) -> DataFrame:
    """blob and due: the rules that have not scanned it, for each of ``blobs`` that has any.

    No text takes part. Of the ledger only the pairs of these blobs are grouped.
    """
    names = [rule.name for rule in rules]
    known = ledger.pairs().where(F.col("rule").isin(names)).join(blobs, "blob", "left_semi")
    known = known.groupBy("blob").agg(F.collect_set("rule").alias("known"))
    none = F.array().cast("array<string>")
    due = F.array_except(F.array(*map(F.lit, names)), F.coalesce("known", none))
    return blobs.join(known, "blob", "left").select("blob", due.alias("due")).where(F.size("due") > 0)


def scan(docs: DataFrame, ledger: Ledger, rules: list[Rule] = RULES) -> int:
    """Bring the ledger up to all texts of ``docs`` and all ``rules``; how many blobs were due.

    The ledger is asked first, by content addresses alone. Only texts of blobs that are due are
    shuffled, once, and one copy for each task that reads it. The texts of one blob meet in one row, so a text
    that makes up much of the corpus costs nothing. Where due blobs are few, their addresses are sent to
    where texts are read; where they are most of them, or more than can be sent, a copy of each text is
    shuffled before it meets what is due.
    """
    return scan_blobs(docs, blobs_of(docs), ledger, rules)


def blobs_of(docs: DataFrame) -> DataFrame:
    """The content addresses of ``docs``, each once."""
    return staged(docs.select(blob_of(F.col("text")).alias("blob")).distinct(), "secret-blobs")


def scan_blobs(docs: DataFrame, blobs: DataFrame, ledger: Ledger, rules: list[Rule]) -> int:
    """:func:`scan` of ``docs`` whose addresses are known."""
    address = blob_of(F.col("text")).alias("blob")
    due = staged(due_pairs(blobs, ledger, rules), "secret-due")
    amount = due.count()
    if not amount:
        return 0
    texts = docs.select(address, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    if amount <= SENT and 2 * amount <= blobs.count():
        texts = texts.join(F.broadcast(due.select("blob")), "blob", "left_semi")
    todo = texts.groupBy("blob").agg(F.first("text").alias("text")).join(due, "blob")

    def matches(rule: Rule) -> Column:
        found = F.when(F.array_contains("due", rule.name), _matches(F.col("text"), rule))
        none = F.array().cast("array<struct<gap:int,own:int,tested:int>>")
        return F.struct(F.lit(rule.name).alias("rule"), F.coalesce(found, none).alias("matches"))

    scanned = staged(
        todo.select("blob", "due", F.array(*map(matches, rules)).alias("found")), "secret-scans"
    )
    each = scanned.select("blob", F.explode("found").alias("f")).select(
        "blob", "f.rule", F.posexplode("f.matches").alias("place", "m")
    )
    # Matches of one text and rule: a window no larger than a text.
    upto = Window.partitionBy("blob", "rule").orderBy("place")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("m.gap") + F.col("m.own")).over(upto)
    least = F.create_map(*[F.lit(x) for rule in rules for x in (rule.name, rule.least)])
    placed = each.select("blob", "rule", "m", end.cast("int").alias("end"))
    findings = placed.where(F.col("m.tested") >= least[F.col("rule")]).select(
        "blob", "rule", (F.col("end") - F.col("m.own")).alias("start"), "end"
    )
    pairs = scanned.select("blob", F.explode("due").alias("rule"))
    ledger.add(pairs, findings, files_for(amount * len(rules)))
    return amount


def find_secrets(
    docs: DataFrame, ledger: Ledger | None = None, rules: list[Rule] = RULES
) -> DataFrame:
    """doc_id, blob and findings of each row of ``docs``.

    ``findings`` is an array of (start, place of the rule in ``rules``, kind, end) in order;
    places are code points, the end is exclusive.
    """
    ledger = ledger or Ledger(docs.sparkSession)
    blobs = blobs_of(docs)
    scan_blobs(docs, blobs, ledger, rules)
    names = [rule.name for rule in rules]
    place = F.create_map(*[F.lit(x) for i, name in enumerate(names) for x in (name, i)])
    kinds = F.create_map(*[F.lit(x) for rule in rules for x in (rule.name, rule.kind)])
    finding = F.struct(
        "start", place[F.col("rule")].alias("place"), kinds[F.col("rule")].alias("kind"), "end"
    )
    held = docs.select("doc_id", blob_of(F.col("text")).alias("blob"))
    here = ledger.findings().where(F.col("rule").isin(names)).join(blobs, "blob", "left_semi")
    by_blob = here.groupBy("blob").agg(F.sort_array(F.collect_list(finding)).alias("findings"))
    by_blob = staged(by_blob, "secret-findings")
    none = F.array().cast(by_blob.schema["findings"].dataType)
    return held.join(by_blob, "blob", "left").select(
        "doc_id", "blob", F.coalesce("findings", none).alias("findings")
    )
