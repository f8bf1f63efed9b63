"""Named relations: the access history, its reporting copy, and how they are kept."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dustline.functions.names import quoted
from dustline.sources.tables import ACCESS_HISTORY


def access_history(source: DataFrame, comments: Mapping[str, str] | None = None) -> DataFrame:
    """The 18 columns of an access history, in order, with the start time as timestamp.

    ``comments`` documents columns; the text stays with the schema and is stored when
    the result is kept as a table.
    """
    history = source.select(
        *[
            F.col(field.name).cast("timestamp").alias(field.name)
            if field.name == "QUERY_START_TIME"
            else F.col(field.name).alias(field.name)
            for field in ACCESS_HISTORY
        ]
    )
    for name, comment in (comments or {}).items():
        history = history.withMetadata(name, {"comment": comment})
    return history


def dim_access_history(history: DataFrame) -> DataFrame:
    """The reporting copy of the access history."""
    return history.select("*")


def materialize(
    df: DataFrame,
    name: str,
    kind: str = "table",
    database: str = "",
    path: str | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Keep ``df`` under a name, as a table or as a view of this session."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(quoted(name))
        return spark.table(quoted(name))
    if kind != "table":
        raise ValueError(f"kind must be table or view, not {kind!r}")
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    full_name = quoted(database, name)
    writer.saveAsTable(full_name)
    return spark.table(full_name)
