"""Schemas of the audited relations, and tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from dustline.functions.names import quoted

# The columns of an access history, in order.
ACCESS_HISTORY = StructType(
    [
        StructField("QUERY_ID", StringType()),
        StructField("QUERY_START_TIME", TimestampType()),
        StructField("USER_NAME", StringType()),
        StructField("PARENT_QUERY_ID", StringType()),
        StructField("OBJECT_MODIFIED_BY_DDL", StringType()),
        StructField("ROOT_QUERY_ID", StringType()),
        StructField("DIRECT_OBJECT_DOMAIN", StringType()),
        StructField("DIRECT_OBJECT_ID", LongType()),
        StructField("DIRECT_OBJECT_NAME", StringType()),
        StructField("DIRECT_OBJECT_STAGE_KIND", StringType()),
        StructField("BASE_OBJECT_DOMAIN", StringType()),
        StructField("BASE_OBJECT_ID", LongType()),
        StructField("BASE_OBJECT_NAME", StringType()),
        StructField("BASE_OBJECT_STAGE_KIND", StringType()),
        StructField("MODIFIED_OBJECT_DOMAIN", StringType()),
        StructField("MODIFIED_OBJECT_ID", LongType()),
        StructField("MODIFIED_OBJECT_NAME", StringType()),
        StructField("MODIFIED_OBJECT_STAGE_KIND", StringType()),
    ]
)

QUERY_LOG = StructType(
    [StructField("query_text", StringType()), StructField("end_time", TimestampType())]
)


def table(spark: SparkSession, name: str, schema: str = "", database: str = "") -> DataFrame:
    """A table by its one, two or three name parts, each taken literally."""
    return spark.table(quoted(database, schema, name))
