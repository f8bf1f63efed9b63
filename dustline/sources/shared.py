"""The shared folder for tables that a job writes on its way."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or by the session's checkpoint folder.

    It must be one that the driver and all executors reach; what a job writes on its way to a
    machine's own folder would be lost with the machine, so there is no default.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/dustline/{label}-{uuid.uuid4().hex}"


def remove_folders(spark: SparkSession, label: str) -> None:
    """Remove all that was staged under a label, when nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/dustline/{label}-*")
    files = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for found in files.globStatus(pattern) or []:
        files.delete(found.getPath(), True)


def staged(df: DataFrame, label: str, parts: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder, in folders by ``parts``, and go on from that table.

    Costly work is done once, and a lost executor costs a re-read, not a re-run.
    """
    path = new_folder(df.sparkSession, label)
    df.write.partitionBy(*parts).parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    return read.select(*[F.col(f"`{name}`") for name in df.columns]) if parts else read
