"""The usage report from partial aggregates that are kept, so that each row of a history is read once.

A history grows by arrivals, which a column of it tells apart: the day its rows were loaded, say, by
which it is partitioned. What arrives may be of any time, so late rows are like others. A run reads the
arrivals that the state does not have, reduces them to a row for each day, object and user, and
commits these by a manifest that names the arrivals. A run that ends before that adds nothing, and
one that is tried again adds nothing twice. Rows of the state merge by maximum and sum, in any order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dustline.operators.usage import PAIR
from dustline.plans.audit import Moment, report_unused
from dustline.sources.manifests import Manifests

PARTIAL = "day date, base_object_name string, user_name string, last_any timestamp, n_any long, last_ddl timestamp, n_ddl long"
ENTRY = "arrival string, folder string, replaces array<string>"


class UsageState:
    """Partial aggregates of a history below one folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.manifests = Manifests(spark, f"{self.path}/_runs")

    def _entries(self) -> DataFrame:
        entries = self.manifests.read(ENTRY)
        gone = entries.select(F.explode("replaces").alias("number")).distinct()
        return entries.join(gone, "number", "left_anti")

    def arrivals(self) -> list[str]:
        """What the state has read."""
        found = self._entries().where(F.col("arrival").isNotNull()).select("arrival").distinct()
        return sorted(row["arrival"] for row in found.collect())

    def new_rows(self, history: DataFrame, column: str) -> DataFrame:
        """The rows of arrivals that the state does not have; a filter that prunes partitions.

        Rows without an arrival are an error, as nothing could say that they were read.
        """
        there = [row[0] for row in history.select(F.col(column)).distinct().collect()]
        if None in there:
            raise ValueError(f"rows without {column}")
        known = set(self.arrivals())
        names = {str(value): value for value in there}
        return history.where(F.col(column).isin([names[n] for n in sorted(names.keys() - known)]))

    def catch_up(self, history: DataFrame, column: str) -> list[str]:
        """Read what has arrived since, and return it.

        ``history`` is an access history (see ``access_history``) with ``column`` beside.
        """
        new = self.new_rows(history, column)
        changed = F.col("object_modified_by_ddl").isNotNull()
        time = F.col("query_start_time").cast("timestamp")
        partial = (
            new.where(F.col("user_name").isNotNull())
            .groupBy(F.to_date(time).alias("day"), *[F.col(name).alias(name) for name in PAIR])
            .agg(
                F.max(time).alias("last_any"),
                F.count(F.lit(1)).alias("n_any"),
                F.max(F.when(changed, time)).alias("last_ddl"),
                F.count(F.when(changed, 1)).alias("n_ddl"),
            )
        )
        arrived = sorted(str(row[0]) for row in new.select(F.col(column)).distinct().collect())
        if arrived:
            self._commit(partial, [{"arrival": name} for name in arrived])
        return arrived

    def _commit(self, partial: DataFrame, entries: list[dict]) -> None:
        number = self.manifests.next_number()
        folder = f"{self.path}/partial-{number}-{uuid.uuid4().hex}"
        partial.write.parquet(folder)
        self.manifests.write(number, [entry | {"folder": folder} for entry in entries])

    def partials(self) -> DataFrame:
        """day, the pair, and what merges: a row for each run that met a pair on a day."""
        folders = [row["folder"] for row in self._entries().select("folder").distinct().collect()]
        if not folders:
            return self.spark.createDataFrame([], PARTIAL)
        return self.spark.read.schema(PARTIAL).parquet(*sorted(folders))

    def by_day(self) -> DataFrame:
        """The state with one row for each day and pair."""
        merged = [F.max("last_any"), F.sum("n_any"), F.max("last_ddl"), F.sum("n_ddl")]
        names = ["last_any", "n_any", "last_ddl", "n_ddl"]
        grouped = self.partials().groupBy("day", *PAIR)
        return grouped.agg(*[part.alias(name) for part, name in zip(merged, names, strict=True)])

    def compact(self) -> None:
        """Merge all runs into one. Old folders stay for those who read them; nothing else does."""
        entries = self._entries().collect()
        if not entries:
            return
        replaced = sorted({row["number"] for row in entries})
        arrivals = sorted({row["arrival"] for row in entries})
        self._commit(
            self.by_day(), [{"arrival": arrival, "replaces": replaced} for arrival in arrivals]
        )

    def usage(self, ddl_only: bool = True) -> DataFrame:
        """The pairs with last_usage, usage_count and fan_out, as ``usage_with_fan_out`` has them."""
        last, uses = ("last_ddl", "n_ddl") if ddl_only else ("last_any", "n_any")
        met = F.when(F.col("base_object_name").isNull(), F.lit(1)).otherwise(F.col("met"))
        return (
            self.partials()
            .groupBy(*PAIR)
            .agg(F.max(last).alias("last_usage"), F.sum(uses).alias("usage_count"), F.sum("n_any").alias("met"))
            .where(F.col("usage_count") > 0)
            .select(*PAIR, "last_usage", "usage_count", met.alias("fan_out"))
        )

    def unused_objects(
        self, as_of: Moment = None, days: int = 90, multiplicity: str = "rows", ddl_only: bool = True
    ) -> DataFrame:
        """What ``unused_objects`` says of all that the state has read; the history is not read."""
        return report_unused(self.usage(ddl_only), as_of, days, multiplicity)
