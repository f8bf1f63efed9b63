"""Appending CSV files to one table, each file once.

A load writes the rows of all files that are due to a folder of its own, then a manifest that names
the files, then shows the folder to the table as a partition of its own. A folder without a complete manifest is never
seen; a manifest whose folder is not shown yet, as its run ended in between, is shown by the next run.
So rows come all or none, and a run that is tried again adds nothing twice.

The manifests are the ledger. A file is due if the ledger does not have its address, or has it
with another size or another content: one that was only touched is not. The content is told by a
digest of its lines, whatever their order, that splits of a file are summed up to.

Two runs at a time cannot both write the next manifest; the slower one fails and adds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from dustline.functions.names import column_names, quoted
from dustline.functions.text import NULL_TOKENS
from dustline.operators.text_tables import RAW, fault_text, literal, new_content, text_columns, too_long
from dustline.sources.csv_files import FILE, CsvSource, csv_pattern, read_heads, read_records
from dustline.sources.manifests import Manifests

#: The table's own column beside those of the files, whose names have no hyphen.
LOAD = "load-id"
ENTRY = "address string, path string, size long, modified long, digest string, folder string"


@dataclass(frozen=True)
class Load:
    """Rows that are written and not committed yet."""

    number: str
    folder: str
    files: tuple[tuple[str, str, int, int, str], ...]
    rows: int


def entries(load: Load) -> Iterator[dict]:
    """What the manifest of a load says of each file."""
    for address, path, size, modified, digest in load.files:
        entry = {"address": address, "path": path, "size": size, "modified": modified, "digest": digest}
        yield entry | {"folder": load.folder}


def csv_files_of(folder: str) -> str:
    """The pattern of the ``.csv`` files, or folders of part files, directly below a folder."""
    return f"{csv_pattern(folder.rstrip('/'))}/*.csv"


def name_files(listed: DataFrame) -> DataFrame:
    """Address, path, size and time of files that Spark lists as binary ones, empty ones left out."""
    return listed.select(
        F.col("_metadata.file_path").alias("address"),
        "path",
        F.col("length").alias("size"),
        F.unix_micros("modificationTime").alias("modified"),
    ).where("size > 0")


class AppendTable:
    """A table of text columns that grows by loads, below ``location`` or its database's folder."""

    def __init__(self, spark: SparkSession, table: str, database: str, location: str | None = None) -> None:
        self.spark, self.table, self.database = spark, table, database
        self.name = quoted(database, table)
        base = location or spark.catalog.getDatabase(database).locationUri
        self.base, self.location = f"{base.rstrip('/')}/{table}", location
        self.manifests = Manifests(spark, f"{self.base}/_loads")

    def ledger(self) -> DataFrame:
        """A row for each file of each committed load."""
        return self.manifests.read(ENTRY).withColumnRenamed("number", "load")

    def _digests(self, paths: Sequence[str]) -> DataFrame:
        """The digest of each file's lines by its address."""
        lines = self.spark.read.option("lineSep", "\n").text([csv_pattern(p) for p in paths])
        mixed = F.xxhash64("value")
        digest = F.concat_ws(
            ":", F.count(F.lit(1)), F.sum(mixed.cast("decimal(38,0)")), F.hex(F.bit_xor(mixed))
        )
        return lines.groupBy(F.col("_metadata.file_path").alias("address")).agg(digest.alias("digest"))

    def due(self, folder: str) -> list[tuple[str, str, int, int, str]]:
        """Address, path, size, time and digest of the files of ``folder`` that are to be loaded."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        try:
            listed = listed.load(csv_files_of(folder))
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return []  # a folder without any
        return self.changed(self.unloaded(name_files(listed)))

    def unloaded(self, listed: DataFrame) -> list[Row]:
        """Of files that are listed (see ``name_files``) those whose size or time the ledger does not have."""
        last = self.ledger().groupBy("address").agg(
            F.max(F.struct("load", "size", "modified", "digest")).alias("last")
        )
        same = (F.col("last.size") == F.col("size")) & (F.col("last.modified") == F.col("modified"))
        changed = listed.join(last, "address", "left").where(F.col("last").isNull() | ~same)
        return changed.select("address", "path", "size", "modified", "last.digest").collect()

    def changed(self, rows: Sequence[Row]) -> list[tuple[str, str, int, int, str]]:
        """Of files that ``unloaded`` gives those with another content than the ledger has."""
        if not rows:
            return []
        digests = {r["address"]: r["digest"] for r in self._digests([r["path"] for r in rows]).collect()}
        return sorted(
            (r["address"], r["path"], r["size"], r["modified"], digests[r["address"]])
            for r in rows
            if digests[r["address"]] != r["digest"]
        )

    def stage(
        self, folder: str, null_tokens: Sequence[str] = NULL_TOKENS, split_bytes: int | None = None
    ) -> Load | None:
        """Write the rows of all files that are due; nothing sees them yet.

        Files need the columns of the table, or of each other if there is none. One that has
        others, or a record with too many fields, fails the load.
        """
        return self.stage_files(self.due(folder), null_tokens, split_bytes)

    def stage_files(
        self,
        files: Sequence[tuple[str, str, int, int, str]],
        null_tokens: Sequence[str] = NULL_TOKENS,
        split_bytes: int | None = None,
    ) -> Load | None:
        """Like ``stage``, of files that are named by address, path, size, time and digest."""
        if not files:
            return None
        sources = [CsvSource(path.rsplit("/", 1)[-1], path, ((path, size, address),)) for address, path, size, *_ in files]
        heads = read_heads(self.spark, sources)
        headed = [source for source in sources if source.path in heads]
        if not headed:
            raise ValueError("no header")
        columns = [c for c in self.spark.table(self.name).columns if c != LOAD] if self.exists() else None
        for source in headed:
            names = column_names(heads[source.path])
            columns = columns or names
            if names != columns:
                raise ValueError(f"{source.path} has columns {names}, not {columns}")
        records = read_records(self.spark, headed, len(columns), split_bytes)
        rows = text_columns(records, columns, null_tokens)
        seen = Observation()
        rows = rows.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(too_long(len(columns)), 1)).alias("faults")
        ).drop(RAW, FILE)
        content = new_content(self.spark, self.database, self.table, self.location)
        rows.write.parquet(content)
        counts = seen.get
        if counts["faults"]:
            raise ValueError(fault_text(counts["faults"], len(columns)))
        return Load(self.manifests.next_number(), content, tuple(files), counts["rows"])

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def commit(self, load: Load) -> None:
        """Write the manifest of a load: from now on its files are loaded."""
        self.manifests.write(load.number, entries(load))

    def publish(self) -> list[str]:
        """Show all committed loads to the table, and return those it did not show before.

        Each is one change of the catalog; a table without any is made.
        """
        committed = {r["load"]: r["folder"] for r in self.ledger().select("load", "folder").distinct().collect()}
        if not committed:
            return []
        if not self.exists():
            schema = self.spark.read.parquet(committed[min(committed)]).schema
            columns = ", ".join(f"{quoted(name)} STRING" for name in [*schema.names, LOAD])
            self.spark.sql(
                f"CREATE TABLE {self.name} ({columns}) USING parquet"
                f" PARTITIONED BY ({quoted(LOAD)}) LOCATION {literal(f'{self.base}/shown')}"
            )
        shown = self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()
        shown = {row[0].split("=", 1)[1] for row in shown}
        new = sorted(committed.keys() - shown)
        for number in new:
            self.spark.sql(
                f"ALTER TABLE {self.name} ADD IF NOT EXISTS PARTITION ({quoted(LOAD)} = '{number}')"
                f" LOCATION {literal(committed[number])}"
            )
        if new:
            self.spark.catalog.refreshTable(self.name)
        return new


def append_folder(
    spark: SparkSession,
    folder: str,
    table: str,
    database: str,
    location: str | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    split_bytes: int | None = None,
) -> DataFrame:
    """Load the ``.csv`` files of a folder that the table does not have yet, in one commit.

    Returns a row for each file loaded now: path, size, load. First finishes what an earlier
    run had committed and not shown.
    """
    target = AppendTable(spark, table, database, location)
    target.publish()
    load = target.stage(folder, null_tokens, split_bytes)
    if load:
        target.commit(load)
        target.publish()
    files = [(path, size, load.number) for _, path, size, *_ in load.files] if load else []
    return spark.createDataFrame(files, "path string, size long, load string")
