"""Cell text: null tokens, search patterns, CSV quoting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells that a tabular reader takes for "no value".
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def null_if_token(cell: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """The cell, or null when it spells a missing value."""
    return F.when(~cell.isin(*tokens), cell) if tokens else cell


def mention_pattern(object_name: str, literal: bool = False) -> str:
    """Pattern for "the text mentions this name", for ``ilike``.

    ``_`` and ``%`` in the name are wildcards unless ``literal``. A backslash in the
    name always stands for itself.
    """
    name = object_name.replace("\\", "\\\\")
    if literal:
        name = name.replace("%", "\\%").replace("_", "\\_")
    return f"%{name}%"


def csv_line(cells: Column) -> Column:
    """One CSV line from an array of cells, quoting only where it is needed."""

    def written(cell: Column) -> Column:
        text = F.coalesce(cell, F.lit(""))
        in_quotes = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(text.rlike('[",\r\n]'), in_quotes).otherwise(text)

    line = F.array_join(F.transform(cells, written), ",")
    # A lone empty cell needs its quotes, or the line would be a blank one.
    return F.when((F.size(cells) == 1) & (line == ""), F.lit('""')).otherwise(line)


def quote_scan(text: Column) -> Column:
    """Follow the quotes of a CSV text from left to right.

    The text is cut at its quote characters and folded over once for both states it may
    be entered with. A state is 0 outside quotes, 1 inside, 2 after a quote met inside,
    which either ends the field or is the first half of a doubled quote. Outside, a quote
    opens a field only where one starts. The comma put in front makes the start of the
    text the start of a field, so counting commas outside quotes counts fields.
    """
    pieces = F.split(F.concat(F.lit(","), text), '"', -1)

    def step(seen: Column, piece: Column) -> Column:
        before = seen["piece"]

        def after_quote(state: Column) -> Column:
            opens = (state == 2) & (before == "") | (state != 1) & before.endswith(",")
            return F.when(before.isNull(), state).when(state == 1, 2).when(opens, 1).otherwise(0)

        commas = F.length(piece) - F.length(F.replace(piece, F.lit(",")))
        from_outside = after_quote(seen["from_outside"])
        return F.struct(
            from_outside.alias("from_outside"),
            after_quote(seen["from_inside"]).alias("from_inside"),
            (seen["fields"] + F.when(from_outside == 1, 0).otherwise(commas)).alias("fields"),
            piece.alias("piece"),
        )

    start = F.struct(
        F.lit(0).alias("from_outside"),
        F.lit(1).alias("from_inside"),
        F.lit(0).alias("fields"),
        F.lit(None).cast("string").alias("piece"),
    )
    return F.aggregate(pieces, start, step)


def ends_inside(line: Column) -> Column:
    """Whether a line, entered outside quotes, ends within a quoted field."""
    return line.contains('"') & (quote_scan(line)["from_outside"] == 1)


def field_count(record: Column) -> Column:
    """Number of fields of one CSV record."""
    return quote_scan(record)["fields"]
