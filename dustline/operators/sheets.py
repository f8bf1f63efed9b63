"""Clean sheets and put them under each other."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField

from dustline.functions.names import quoted


def drop_empty_rows(sheet: DataFrame) -> DataFrame:
    """Without the rows that have no value at all."""
    if not sheet.columns:
        return sheet
    return sheet.dropna(how="all", subset=[quoted(name) for name in sheet.columns])


def _has_value(field: StructField) -> Column:
    cell = F.col(quoted(field.name))
    if isinstance(field.dataType, (DoubleType, FloatType)):
        return cell.isNotNull() & ~F.isnan(cell)  # as dropna has it
    return cell.isNotNull()


def drop_empty_columns(sheet: DataFrame) -> DataFrame:
    """Without the columns that have no value at all.

    One aggregate over the sheet; the driver gets a single row of flags.
    """
    if not sheet.columns:
        return sheet
    filled = sheet.agg(
        *[
            F.coalesce(F.bool_or(_has_value(field)), F.lit(False)).alias(str(i))
            for i, field in enumerate(sheet.schema)
        ]
    ).first()
    return sheet.select(*[quoted(name) for name, keep in zip(sheet.columns, filled) if keep])


def combine_sheets(sheets: Iterable[DataFrame] | Mapping[str, DataFrame]) -> DataFrame:
    """Clean every sheet, then union them by column name.

    Columns come in order of first appearance, and a column a sheet lacks is null
    there. Where sheets disagree about the type of a column it becomes text.
    """
    frames = list(sheets.values() if isinstance(sheets, Mapping) else sheets)
    if not frames:
        raise ValueError("no sheets to combine")
    cleaned = [drop_empty_columns(drop_empty_rows(frame)) for frame in frames]
    filled = [frame for frame in cleaned if frame.columns]
    if not filled:
        return cleaned[0]

    types: dict[str, set[str]] = {}
    for frame in filled:
        for field in frame.schema:
            types.setdefault(field.name.lower(), set()).add(field.dataType.simpleString())

    def agreed(frame: DataFrame) -> DataFrame:
        return frame.select(
            *[
                F.col(quoted(name)).cast("string").alias(name)
                if len(types[name.lower()]) > 1
                else F.col(quoted(name))
                for name in frame.columns
            ]
        )

    return functools.reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [agreed(frame) for frame in filled],
    )
