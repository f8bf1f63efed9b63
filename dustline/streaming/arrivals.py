"""CSV files as they arrive in a folder, each loaded once into one table.

A stream notices files: its checkpoint knows which it has seen, and its sink, a log of names, takes
each batch once. Content is not read there. Then the files that the log has and the table's
ledger has not are loaded (see ``plans.append``), in groups of a bounded number, each in one commit.
So a run may end anywhere: what the stream has not finished is noticed again and logged once, and
what is logged and not loaded is loaded by the next run.

A file at fault, with other columns than the table, with records of too many fields, or gone before it was
loaded, is set aside with its error and not tried again; others go on. It is found by halves, so it costs
some twice the logarithm of its group in failed loads. Anything else, like a lost cluster, ends the run and
sets nothing aside.

The stream knows a file by its path: one that is written again in its place is not noticed, and a corrected
one needs a new name. Files must come whole, written elsewhere and moved. ``append_folder`` lists the
folder again instead, finds files that have changed, and may be used on the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from dustline.functions.text import NULL_TOKENS
from dustline.plans.append import AppendTable, csv_files_of, name_files
from dustline.sources.manifests import Manifests

BINARY = "path string, modificationTime timestamp, length long, content binary"
NAMES = "address string, path string, size long, modified long"
STATUS = "path string, size long, load string, error string"


class Arrivals:
    """The files of a folder on their way to a table.

    ``batch_files`` bounds what a batch of the stream notices and what a load takes.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        table: str,
        database: str,
        location: str | None = None,
        batch_files: int = 10_000,
    ) -> None:
        self.spark, self.folder, self.batch_files = spark, folder, batch_files
        self.target = AppendTable(spark, table, database, location)
        self.base = f"{self.target.base}/_arrivals"
        self.log, self.checkpoint = f"{self.base}/log", f"{self.base}/checkpoint"
        self._set_aside = Manifests(spark, f"{self.base}/set-aside")

    def notice(self) -> None:
        """Log the names of all files that have come since the last time, batch by batch."""
        files = (
            self.spark.readStream.format("binaryFile")
            .schema(BINARY)
            .option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", self.batch_files)
            .load(csv_files_of(self.folder))
        )
        # Names of a bounded number of files, whatever is in these: one small file of the log.
        stream = name_files(files).coalesce(1).writeStream.format("parquet")
        stream = stream.option("path", self.log).option("checkpointLocation", self.checkpoint)
        stream.trigger(availableNow=True).start().awaitTermination()

    def noticed(self) -> DataFrame:
        """Names of all files that the stream has logged."""
        try:
            return self.spark.read.schema(NAMES).parquet(self.log)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], NAMES)  # nothing has come yet

    def set_aside(self) -> DataFrame:
        """Names of files at fault, with their errors."""
        return self._set_aside.read(f"{NAMES}, error string").drop("number")

    def load(
        self, null_tokens: Sequence[str] = NULL_TOKENS, split_bytes: int | None = None
    ) -> list[tuple[str, int, str | None, str | None]]:
        """Load what is logged and not loaded: path, size, load and error of each file."""
        self.target.publish()
        at_fault = self.set_aside().select("address", "size", "modified")
        open_files = self.noticed().join(at_fault, ["address", "size", "modified"], "left_anti")
        rows = sorted(self.target.unloaded(open_files), key=lambda row: row["address"])
        status = []
        for start in range(0, len(rows), self.batch_files):
            status += self._load(rows[start : start + self.batch_files], null_tokens, split_bytes)
        return status

    def _load(
        self, rows: Sequence[Row], null_tokens: Sequence[str], split_bytes: int | None
    ) -> list[tuple[str, int, str | None, str | None]]:
        try:
            load = self.target.stage_files(self.target.changed(rows), null_tokens, split_bytes)
        except (AnalysisException, ValueError) as problem:
            if isinstance(problem, AnalysisException) and problem.getCondition() != "PATH_NOT_FOUND":
                raise
            if len(rows) > 1:
                halves = rows[: len(rows) // 2], rows[len(rows) // 2 :]
                return [file for half in halves for file in self._load(half, null_tokens, split_bytes)]
            error = str(problem).strip().split("\n")[0]
            name = {key: rows[0][key] for key in ("address", "path", "size", "modified")}
            self._set_aside.write(self._set_aside.next_number(), [name | {"error": error}])
            return [(name["path"], name["size"], None, error)]
        if load is None:
            return []
        self.target.commit(load)
        self.target.publish()
        return [(path, size, load.number, None) for _, path, size, *_ in load.files]


def append_arrivals(
    spark: SparkSession,
    folder: str,
    table: str,
    database: str,
    location: str | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    split_bytes: int | None = None,
    batch_files: int = 10_000,
) -> DataFrame:
    """Load the ``.csv`` files that have come to a folder since the last run.

    Returns a row for each file now loaded or set aside: path, size, load, error. To follow a
    folder run it again and again; each run takes up what an earlier one left.
    """
    arrivals = Arrivals(spark, folder, table, database, location, batch_files)
    arrivals.notice()
    return spark.createDataFrame(arrivals.load(null_tokens, split_bytes), STATUS)
