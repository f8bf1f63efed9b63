"""Many tables that are read together."""

import functools
from datetime import date

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import __spark_entry__ as registered
from dustline import ingest_folder, read_tables


def test_many_tables_are_one_scan(spark, database, tmp_path, capsys):
    """Other columns, odd places and an empty file; tasks do not grow in size with the tables."""
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(40):
        (folder / f"many {i}.csv").write_text(f"key,value\n{i},a\n{i},b\n" if i else "key,value\n")
    (folder / "turned.csv").write_text("value,key\nc,40\n")
    base = f"{tmp_path}/odd %20 place/größe+1"
    status = ingest_folder(spark, str(folder), database, location=base).collect()
    names = [row["table"] for row in status if row["error"] is None]
    assert len(names) >= 40
    tables = read_tables(spark, database, names)
    assert tables.columns == ["key", "value", "table"]
    expected = [(str(i), v, f"many_{i}") for i in range(1, 40) for v in "ab"] + [("40", "c", "turned")]
    assert sorted(map(tuple, tables.collect())) == sorted(expected)
    one_by_one = [spark.table(f"{database}.{name}").withColumn("table", F.lit(name)) for name in names]
    union = functools.reduce(DataFrame.unionByName, one_by_one)
    assert sorted(map(tuple, tables.collect())) == sorted(map(tuple, union.collect()))
    read_tables(spark, database, names).explain()
    assert capsys.readouterr().out.count("FileScan") == 2
    assert read_tables(spark, database, names[:2] * 2, column="value").columns == ["key", "value"]
    assert read_tables(spark, database, ["turned", "turned"]).count() == 2


def test_other_tables_are_refused(spark, database):
    spark.sql(f"CREATE VIEW IF NOT EXISTS {database}.seen AS SELECT 1 AS key")
    with pytest.raises(ValueError, match="not a table written here"):
        read_tables(spark, database, ["seen"])
    with pytest.raises(ValueError, match="no table"):
        read_tables(spark, database, [])


def test_workbook_ingest_reads_its_tables_in_one_scan(spark, tmp_path, capsys):
    orders = spark.range(0, 60_000, 997).select(
        F.col("id").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit("1-URGENT").alias("o_orderpriority"), F.lit(date(1996, 1, 2)).cast("timestamp_ntz").alias("o_orderdate"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = registered.queries()["workbook_ingest"](spark, str(tmp_path))
    found.explain()
    assert capsys.readouterr().out.count("FileScan") == 1
    assert found.select("table").distinct().count() == 12 and found.count() == 61
