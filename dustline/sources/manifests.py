"""Numbered manifests in a folder: what a run has committed, all of it or nothing."""

from __future__ import annotations

import json
from collections.abc import Iterable
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Manifests:
    """Files of one JSON object a line below a folder, each written once.

    The last line of a manifest has the number of the others; one without it was not finished and
    counts for nothing. A number can be written by one run only, so of two runs at a time one fails.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        hadoop = spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self._path(self.folder).getFileSystem(hadoop)

    def next_number(self) -> str:
        folder = self._path(self.folder)
        found = self._files.listStatus(folder) if self._files.exists(folder) else []
        taken = [status.getPath().getName().removesuffix(".json") for status in found]
        return f"{max((int(n) for n in taken if n.isdigit()), default=0) + 1:08d}"

    def lines(self, number: str, entries: Iterable[dict[str, Any]]) -> list[str]:
        written = [json.dumps(entry | {"number": number}) for entry in entries]
        return [*written, json.dumps({"number": number, "entries": len(written)})]

    def write(self, number: str, entries: Iterable[dict[str, Any]]) -> None:
        """Commit: what the entries name is there from now on."""
        try:
            out = self._files.create(self._path(f"{self.folder}/{number}.json"), False)
        except Py4JJavaError as problem:
            if "AlreadyExists" not in problem.java_exception.getClass().getName():
                raise
            raise RuntimeError(f"{number} of {self.folder} was written by another run") from None
        for line in self.lines(number, entries):
            out.write(bytearray(f"{line}\n".encode()))
        out.close()

    def read(self, schema: str) -> DataFrame:
        """``number`` and the columns of ``schema`` of each entry that is committed."""
        if not self._files.exists(self._path(self.folder)):
            return self.spark.createDataFrame([], f"number string, {schema}")
        lines = self.spark.read.schema(f"number string, {schema}, entries int").json(self.folder)
        counted = lines.groupBy("number").agg(
            F.count(F.when(F.col("entries").isNull(), 1)).alias("found"), F.max("entries").alias("entries")
        )
        whole = counted.where(F.col("found") == F.col("entries")).select("number")
        return lines.where(F.col("entries").isNull()).drop("entries").join(whole, "number", "left_semi")
