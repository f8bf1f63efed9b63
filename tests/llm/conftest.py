import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from samples import CLASHING, odd_rows

FIELDS = [
    ("doc_id", T.LongType()),
    ("text", T.StringType()),
    ("lang", T.StringType()),
    ("source", T.StringType()),
    ("n_chars", T.LongType()),
]


@pytest.fixture(scope="session")
def odd(spark):
    schema = T.StructType([T.StructField(*f) for f in FIELDS])
    return spark.createDataFrame(odd_rows(), schema).repartition(3).persist()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def clashing(odd):
    """``odd`` with more columns, whose names operators use themselves."""
    return odd.select("*", *[F.lit(f"own {name}").alias(name) for name in CLASHING])
