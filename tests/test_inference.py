"""Inferred types against pandas, on cells that are almost something else."""

import io
import random

import pytest
from pyspark.sql import functions as F

from dustline import infer_types, ingest_folder, spell_as
from dustline.operators import inference
from dustline.plans.ingest import read_csv_text

pd = pytest.importorskip("pandas")

COLUMNS = [
    ["1", "2"], ["007", "+5"], ["1", ""], ["1", "2.50"], ["True", "FALSE"], ["true", ""], ["True", "1"],
    ["99999999999999999999", "1"], ["18446744073709551615", "1"], ["18446744073709551615", "-1"],
    ["18446744073709551615", ""], ["18446744073709551616", "1"], [" 1", "2 "], ["1e5", "2"], [".5", "5."],
    ["inf", "1"], ["-Infinity", "1"], ["+INF", ""], ["0x10", "1"], ["1_000", "2"], ["1,5", "2"], ["1e400", "1"],
    ["1e-400", "1"], ["123456789012345678", "1.5"], ["0.1", "1e16"], ["1e-5", "123456789.125"], ["NaN", "1"],
    ["", ""], ["-0", "0"], ["-0.0", "0"], ["1E5", "1"], ["1e", "2"], ["1e+05", "2"], ["TRUE ", "False"],
    ["tRue", "False"], ["9223372036854775808", "1"], ["-9223372036854775809", "1"],
    ["-9223372036854775808", "9223372036854775807"], ["1\xa0", "2"], ["\t1", "2"], ["--1", "2"], ["1d", "2"],
    ["1f", "2"], ["+", "1"], [".", "1"], ["1e5.5", "1"], ["00.10", "1"], ["4.35", "1e22"], ["True", "NA"],
    ["yes", "no"], ["1e0005", "2"], ["9007199254740993", ""], ["12345678", "0.0001"], ["1e15", "1e-4"],
    ["9999999999999998", "0.5"], ["1.5e300", "-2.5e-300"], ["x", ""], ["1", "null"], ["100", "1e7"],
]


def by_pandas(cells):
    text = "a,b\n" + "".join('"{}",x\n'.format(c.replace('"', '""')) for c in cells)
    column = pd.read_csv(io.StringIO(text))["a"].astype(object)
    return [str(v) for v in column.where(column.notna(), "")]


def spelled_here(spark, columns):
    """All columns at once, as cells of one table."""
    height = max(map(len, columns))
    assert all(len(c) == height for c in columns)
    names = [f"c{i}" for i in range(len(columns))]
    tokens = inference_tokens()
    rows = [tuple("" if c[r] in tokens else c[r] for c in columns) for r in range(height)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).coalesce(1)
    found = spell_as(df, infer_types(df)).collect()
    return [[row[n] for row in found] for n in names]


def inference_tokens():
    from dustline.functions.text import NULL_TOKENS

    return NULL_TOKENS


def test_like_pandas(spark):
    for cells, found in zip(COLUMNS, spelled_here(spark, COLUMNS), strict=True):
        assert found == by_pandas(cells), cells


@pytest.mark.parametrize("seed", range(3))
def test_random_columns_like_pandas(spark, seed):
    draw = random.Random(seed)

    def number():
        digits = str(draw.randrange(10 ** draw.randint(1, 14)))
        place = draw.randint(0, len(digits))
        return draw.choice(["", "-", "+"]) + draw.choice(
            [digits, f"{digits[:place]}.{digits[place:]}", f"{digits}e{draw.randint(-20, 8)}"]
        )

    pools = [
        lambda: number(),
        lambda: str(draw.randrange(-50, 50)),
        lambda: draw.choice(["true", "False", "TRUE"]),
        lambda: draw.choice(["1", "2.5", "", "NA", "7"]),
        lambda: draw.choice(["1", "", "x", " ", "true"]),
    ]
    columns = [[pool() for _ in range(4)] for pool in draw.choices(pools, k=60)]
    columns = [c for c in columns if not all(x in (".", "", "-.", "+.") for x in c)]
    for cells, found in zip(columns, spelled_here(spark, columns), strict=True):
        assert found == by_pandas(cells), cells


def test_types_merge_in_any_order():
    flags = [1 << i for i in range(8)]
    draw = random.Random(1)
    for _ in range(200):
        some = draw.choices(flags, k=draw.randint(0, 5))
        merged = 0
        for flag in some:
            merged |= flag
        assert inference.type_of(merged) in inference.TYPES
        assert inference.type_of(merged | inference.TEXT) == "text"
    assert inference.type_of(inference.EMPTY) == inference.type_of(0) == "empty"


def test_one_aggregate_and_odd_tables(spark, capsys):
    df = spark.range(1000).select(F.col("id").cast("string").alias("a.b"), F.lit(None).cast("string").alias("n"))
    assert infer_types(df) == {"a.b": "integer", "n": "empty"}
    assert infer_types(df.limit(0)) == {"a.b": "empty", "n": "empty"}
    assert infer_types(df, []) == {}
    assert [tuple(r) for r in spell_as(df, {"n": "empty"}).limit(1).collect()] == [("0", "")]
    df.agg(F.bit_or(inference.cell_kind(F.col("`a.b`")))).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "Python" not in plan


def test_long_cells_are_text(spark):
    df = spark.createDataFrame([("9" * 5000, "1." + "3" * 5000), ("1", "2")], "a string, b string")
    assert infer_types(df) == {"a": "text", "b": "decimal"}
    assert spell_as(df, infer_types(df)).first()["b"] == "1.3333333333333333"


@pytest.mark.parametrize("split_bytes", [None, 0])
def test_files_in_splits_have_one_type(spark, database, tmp_path, split_bytes):
    """A cell at the very end of a file changes how the first one is spelled."""
    lines = [f"{i},{i},{'true' if i % 2 else 'FALSE'},0{i}" for i in range(20_000)]
    lines[-1] = "19999,1.5,,x"
    (tmp_path / "kinds.csv").write_text("whole,num,truth,text\n" + "\n".join(lines) + "\n")
    (tmp_path / "bad.csv").write_text("a,b\n1,2,3\n")
    status = ingest_folder(spark, str(tmp_path), database, split_bytes=split_bytes, infer=True)
    errors = {r["table"]: r["error"] for r in status.collect()}
    assert errors["kinds"] is None and "more than 2" in errors["bad"]
    rows = {r["whole"]: tuple(r)[1:] for r in spark.table(f"{database}.kinds").collect()}
    assert rows["0"] == ("0.0", "False", "00") and rows["19999"] == ("1.5", "", "x") and len(rows) == 20_000
    text = read_csv_text(spark, str(tmp_path / "kinds.csv"), infer=True)
    assert text.where("num = '7.0'").count() == 1


def test_cells_at_the_bounds_of_short_ones(spark):
    """Lengths at which a cell's value is looked at, and blanks of which only some are taken off."""
    kinds = {
        "9" * 18: inference.WHOLE, "0" * 18 + "7": inference.WHOLE, "-" + "0" * 17: inference.WHOLE,
        "-" + "9" * 17: inference.NEGATIVE, "-" + "9" * 18: inference.NEGATIVE, "9" * 20: inference.HUGE,
        "9" * 200 + ".5": inference.DECIMAL, "9" * 197 + "e99": inference.DECIMAL, "1e308": inference.DECIMAL,
        "1e309": inference.TEXT, "9" * 400 + ".5": inference.TEXT, "0." + "1" * 400: inference.DECIMAL,
        " 5": inference.WHOLE, "5\x0b": inference.WHOLE, "\x015": inference.TEXT, "5\x00": inference.TEXT,
        "5\x7f": inference.TEXT, " ": inference.TEXT, "i": inference.TEXT, "iNf": inference.DECIMAL,
        " true": inference.TEXT, "tRUE": inference.BOOLEAN, "": inference.EMPTY, None: inference.EMPTY,
    }
    df = spark.createDataFrame([(cell,) for cell in kinds], "cell string")
    found = df.select("cell", inference.cell_kind(F.col("cell")).alias("kind")).collect()
    assert {row["cell"]: row["kind"] for row in found} == kinds


def test_code_is_compiled_whatever_the_columns(spark, tmp_path):
    """Java leaves methods beyond 8000 bytes uncompiled, so Spark is told to make shorter ones."""
    head = [f"c{i}" for i in range(150)]
    (tmp_path / "wide.csv").write_text(",".join(head) + "\n" + ",".join(f"{i}e-9" for i in range(150)) + "\n")
    text = read_csv_text(spark, str(tmp_path / "wide.csv"), infer=True)
    assert text.sparkSession.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert text.first()[:12] == ("0.0", *[f"{i}e-09" for i in range(1, 10)], "1e-08", "1.1e-08")


def test_names_of_texts_on_the_way_are_free(spark):
    df = spark.createDataFrame([("1e-5", "x", "2")], "a string, `java-text-0` string, `java-text--1` string")
    types = {"a": "decimal", "java-text--1": "decimal"}
    assert spell_as(df, types).first()[:] == ("1e-05", "x", "2.0")
