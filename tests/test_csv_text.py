"""Names, null tokens and quote following, against the public pandas reader."""

import csv
import io

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dustline.functions.names import column_names, first_clash, quoted, table_name, unique_header
from dustline.functions.text import NULL_TOKENS, csv_line, ends_inside, field_count, quote_scan


@pytest.mark.parametrize(
    "header",
    [
        ["a", "a", "a.1"],
        ["a", "a.1", "a"],
        ["a", "", ""],
        ["a", "a", "a", "a.2"],
        ["x", "", "Unnamed: 1"],
        ["", "", ""],
        ["True", "True", "True", "True"],
        ["NA", "NA"],
    ],
)
def test_unique_header_is_the_pandas_header(header):
    line = ",".join(header)
    values = ",".join("1" for _ in header)
    assert unique_header(header) == list(pd.read_csv(io.StringIO(f"{line}\n{values}\n")).columns)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.sampled_from(["a", "b", "a.1", "a.2", "b.1", ""]), min_size=2, max_size=6))
def test_unique_header_is_unique_and_like_pandas(header):
    names = unique_header(header)
    assert len(set(names)) == len(names)
    text = ",".join(header) + "\n" + ",".join("1" for _ in header) + "\n"
    assert names == list(pd.read_csv(io.StringIO(text)).columns)


def test_null_tokens_are_the_readers():
    assert set(NULL_TOKENS) == set(pd._libs.parsers.STR_NA_VALUES)


def test_column_names():
    assert column_names(["True", "True", "True"]) == ["True", "True_1", "True_2"]
    assert column_names(["Größe (kg)", "3-Letter Code"]) == ["Größe_kg_", "3_Letter_Code"]
    assert column_names(["Journal/Book", None]) == ["Journal_Book", "Unnamed_1"]
    with pytest.raises(ValueError, match="collide"):
        column_names(["a b", "a-b"])
    with pytest.raises(ValueError, match="collide"):
        column_names(["Ab", "aB"])


def test_table_names():
    assert table_name("2020 x.csv") == "_2020_x"
    assert table_name("/in/N. America.csv") == "N__America"
    assert table_name("Prices 2020 - Prices.csv.csv") == "Prices_2020___Prices_csv"
    assert first_clash(["a", "b", "A"]) == "A"
    assert quoted("", "s", "we`ird") == "`s`.`we``ird`"


LINES = [
    "",
    "a,b",
    '"a","b"',
    '"a,b",c',
    '"a ""q"" b",c',
    'x,"open',
    'closed",y',
    '5" pipe,x',
    '5" pipe,"open',
    '"",""',
    '""""',
    '"""',
    'x,"a""',
    'x"y"z,"a"b"c',
    'a""b,c',
    ',"',
    '"junk"after,"x',
    '"","',
]


def _follow(line, inside):
    """The rule in plain words: (ends inside, number of fields)."""
    fields, at_start, i = 1, not inside, 0
    while i < len(line):
        c = line[i]
        if inside:
            if c == '"':
                if line[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    inside = False
            at_start = False
        elif c == '"' and at_start:
            inside, at_start = True, False
        elif c == ",":
            fields, at_start = fields + 1, True
        else:
            at_start = False
        i += 1
    return inside, fields


def test_quotes_are_followed(spark):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(LINES)], "i int, line string")
    rows = df.select(
        "line",
        ends_inside(F.col("line")).alias("out0"),
        (quote_scan(F.col("line"))["from_inside"] == 1).alias("out1"),
        field_count(F.col("line")).alias("fields"),
    ).collect()
    assert len(rows) == len(LINES)
    for row in rows:
        out0, fields = _follow(row["line"], False)
        assert (row["out0"], row["fields"]) == (out0, fields), row
        assert row["out1"] == _follow(row["line"], True)[0], row


def test_csv_line_reads_back(spark):
    cells = [
        ["a", None, "b c"],
        ['say "x"', "1,2", "two\nlines"],
        [None],
        ["\r", " pad ", ""],
        [None, None],
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, cells array<string>")
    lines = [r["line"] for r in df.orderBy("i").select(csv_line(F.col("cells")).alias("line")).collect()]
    for line, expected in zip(lines, cells):
        assert next(csv.reader(io.StringIO(line, newline=""))) == [c or "" for c in expected]
