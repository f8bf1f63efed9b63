"""Column types inferred from text, and the one spelling that each type gives its cells.

A cell is of some kinds, a column of all that its cells are: a set of flags, to which a cell only adds. Sets
merge by "or" in any order and grouping, so all columns of a table take one aggregate, of one
row, over all its parts. The type of a column is read off its set:

- no cell but empty ones: ``empty``;
- truth values, whatever their case: ``boolean``, spelled ``True`` and ``False``;
- whole numbers: ``integer``, without sign ``+`` and leading zeros, if they all fit 64 bits, signed or
  unsigned, and none is missing;
- numbers otherwise: ``decimal``, as 64-bit floating point: ``1`` becomes ``1.0``, and from 16 digits
  before the point on, or four zeros behind it, it is ``1e+16`` or ``1e-05``;
- all else, mixed kinds and numbers out of range among it: ``text``, which keeps its spelling.

Missing cells, null or empty text, stay empty text. White space around a number is no part of it.
Numbers are rounded correctly; a reader that is off by a unit in the last place, as pandas is
where exponents are large, spells such a number otherwise. A whole number beyond 64 bits makes a
column text only if nothing else in it is a decimal, wherever either stands.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dustline.functions.names import quoted

# What a cell can be. Whole numbers are told apart by what holds them: 63 bits, a sign too,
# 64 bits without a sign, none of these.
EMPTY, BOOLEAN, WHOLE, NEGATIVE, LARGE, HUGE, DECIMAL, TEXT = (1 << i for i in range(8))
TYPES = ("empty", "boolean", "integer", "decimal", "text")

#: White space around numbers.
BLANKS = " \t\n\x0b\f\r"
# Patterns of a cell without the white space around it, and of one without a number.
WHOLE_NUMBER = r"\A[+-]?[0-9]+\z"
NUMBER = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
INFINITE = r"\A[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?\z"
# What holds most cells without a look at their value. What begins otherwise is no number. So many
# characters of a whole number fit 63 bits, and of another one with so short an exponent a double.
STARTS = [*"+-.0123456789iI"]
FITS_LONG = 18
FITS_DOUBLE = 200
SHORT_NUMBER = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,2})?\z"


def bare_cell(cell: Column) -> Column:
    """A cell without the white space around it."""
    # Most have none: no character before "!" in order stands at either end.
    tight = (cell >= "!") & (F.right(cell, F.lit(1)) >= "!")
    return F.when(tight, cell).otherwise(F.btrim(cell, F.lit(BLANKS)))


def cell_kind(cell: Column, bare: Column | None = None) -> Column:
    """The kind of one cell, as a flag; ``bare`` is the column of its ``bare_cell``, if there is one."""
    bare = bare_cell(cell) if bare is None else bare
    whole = bare.try_cast("decimal(38,0)")
    kind_of_whole = (
        F.when((F.length(bare) <= FITS_LONG) & ~bare.startswith("-"), WHOLE)
        .when(whole.between(Decimal(0), Decimal(2**63 - 1)), WHOLE)
        .when(whole.between(Decimal(-(2**63)), Decimal(-1)), NEGATIVE)
        .when(whole.between(Decimal(2**63), Decimal(2**64 - 1)), LARGE)
        .otherwise(HUGE)
    )
    finite = F.abs(bare.try_cast("double")) < float("inf")
    number = (
        F.when(~bare.contains(".") & bare.rlike(WHOLE_NUMBER), kind_of_whole)
        .when((F.length(bare) <= FITS_DOUBLE) & bare.rlike(SHORT_NUMBER), DECIMAL)
        .when(bare.rlike(NUMBER), F.when(finite, DECIMAL).otherwise(TEXT))
        .when(bare.rlike(INFINITE), DECIMAL)
        .otherwise(TEXT)
    )
    return (
        F.when(cell.isNull() | (cell == ""), EMPTY)
        .when(F.left(bare, F.lit(1)).isin(STARTS), number)
        .when(F.lower(cell).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def type_of(kinds: int) -> str:
    """The type of a column whose cells are of these kinds."""
    numbers = kinds & (WHOLE | NEGATIVE | LARGE | HUGE | DECIMAL)
    if kinds & TEXT or kinds & BOOLEAN and numbers:
        return "text"
    if kinds & BOOLEAN:
        return "boolean"
    if numbers & DECIMAL:
        return "decimal"
    if numbers & HUGE or numbers & LARGE and kinds & (NEGATIVE | EMPTY):
        return "text"
    if numbers:
        return "decimal" if kinds & EMPTY else "integer"
    return "empty"


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """The type of each text column, by one aggregate over ``df``.

    Cells are rows of their own with the place of their column, so one small piece of code is for all
    columns; the driver gets a row for each.
    """
    columns = df.columns if columns is None else columns
    if not columns:
        return {}
    cells = df.select(F.posexplode(F.array(*[quoted(c) for c in columns])).alias("place", "cell"))
    cells = cells.select("place", "cell", bare_cell(F.col("cell")).alias("bare"))
    kinds = F.bit_or(cell_kind(F.col("cell"), F.col("bare"))).alias("kinds")
    found = {row["place"]: row["kinds"] for row in cells.groupBy("place").agg(kinds).collect()}
    return {c: type_of(found.get(i, EMPTY)) for i, c in enumerate(columns)}


def decimal_text(java: Column) -> Column:
    """From Spark's text of a double the shortest that reads as the same one, with a point or an exponent.

    Java before 19 adds a digit to few numbers of 16 digits and more; they are left as it has them.
    """
    mantissa, exponent = F.substring_index(java, "E", 1), F.substring_index(java, "E", -1)
    mantissa = F.when(mantissa.endswith(".0"), F.left(mantissa, F.length(mantissa) - 2)).otherwise(mantissa)
    sign = F.when(java.startswith("-"), "-").otherwise("")
    digits = F.replace(F.ltrim(mantissa, F.lit("-")), F.lit("."), F.lit(""))
    power = exponent.try_cast("int")
    before = F.rpad(F.substring(digits, F.lit(1), power + 1), power + 1, F.lit("0"))
    after = F.substring(digits, power + 2, F.length(digits))
    size = F.ltrim(exponent, F.lit("-"))
    raised = F.concat(
        mantissa,
        F.when(exponent.startswith("-"), "e-").otherwise("e+"),
        F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size),
    )
    with_exponent = (
        F.when(exponent == "-4", F.concat(sign, F.lit("0.000"), digits))
        .when(exponent.startswith("-"), raised)
        .when(power <= 15, F.concat(sign, before, F.lit("."), F.when(after == "", "0").otherwise(after)))
        .otherwise(raised)
    )
    return (
        F.when(java.contains("E"), with_exponent)
        .when(java == "Infinity", "inf")
        .when(java == "-Infinity", "-inf")
        .otherwise(java)
    )


def spelled(cell: Column, kind: str, java: Column) -> Column:
    """A cell as a column of type ``kind`` spells it; missing ones as empty text.

    ``java`` is Spark's text of the number in it, if the column is decimal.
    """
    if kind == "integer":
        text = bare_cell(cell).try_cast("decimal(20,0)").cast("string")
    elif kind == "decimal":
        text = decimal_text(java)
    else:
        text = F.initcap(cell) if kind == "boolean" else cell
    return F.when(cell.isNull() | (cell == ""), "").otherwise(text)


def spell_as(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``df`` with the columns of ``types`` spelled as these have it.

    Texts of numbers are columns of their own first, so that a number is read and written once.
    """
    taken, prefix = {name.lower() for name in df.columns}, "java-text-"
    while any(name.startswith(prefix) for name in taken):
        prefix += "-"
    java = {name: f"{prefix}{i}" for i, name in enumerate(df.columns) if types.get(name) == "decimal"}
    read = df.select(
        "*",
        *[
            F.when(F.col(quoted(name)) != "", bare_cell(F.col(quoted(name))).try_cast("double").cast("string")).alias(text)
            for name, text in java.items()
        ],
    )
    return read.select(
        *[
            spelled(F.col(quoted(name)), types[name], F.col(quoted(java.get(name, name)))).alias(name)
            if name in types
            else F.col(quoted(name))
            for name in df.columns
        ]
    )
