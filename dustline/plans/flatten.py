"""A raw access history, one row a query with nested objects, to its flattened form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructField, StructType, VariantType

from dustline.sources.tables import ACCESS_HISTORY

# An object as a raw history nests it, and the arrays by the columns they become.
OBJECT = StructType(
    [
        StructField("objectDomain", StringType()),
        StructField("objectId", LongType()),
        StructField("objectName", StringType()),
        StructField("stageKind", StringType()),
    ]
)
NESTED = {
    "DIRECT_OBJECT": "DIRECT_OBJECTS_ACCESSED",
    "BASE_OBJECT": "BASE_OBJECTS_ACCESSED",
    "MODIFIED_OBJECT": "OBJECTS_MODIFIED",
}
PARTS = {"DOMAIN": "objectDomain", "ID": "objectId", "NAME": "objectName", "STAGE_KIND": "stageKind"}


def objects(raw: DataFrame, name: str) -> Column:
    """A nested column as an array of objects; fields that its type lacks are null.

    It may be an array of structures, with whatever fields beside, or the same as JSON text or
    as a variant. Text that is no array of objects is an error in strict mode (see ``flatten_access_history``).
    """
    column, kind = F.col(name), raw.schema[_found(raw, name)].dataType
    if isinstance(kind, VariantType):
        column, kind = F.to_json(column), StringType()
    if isinstance(kind, StringType):
        return F.from_json(column, ArrayType(OBJECT), {"mode": "PERMISSIVE"})
    if not isinstance(kind, ArrayType) or not isinstance(kind.elementType, StructType):
        raise TypeError(f"{name} is {kind.simpleString()}, not an array of objects")
    given = {field.name.lower(): field.name for field in kind.elementType}

    def one(element: Column) -> Column:
        fields = [
            (element[given[f.name.lower()]] if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in OBJECT
        ]
        return F.when(element.isNotNull(), F.struct(*fields))

    return F.transform(column, one)


def _found(raw: DataFrame, name: str) -> str:
    return next((c for c in raw.columns if c.lower() == name.lower()), name)


def _text(raw: DataFrame, name: str) -> Column:
    """A change by DDL as JSON text, whatever type it is kept in."""
    kind = raw.schema[_found(raw, name)].dataType
    if isinstance(kind, (StructType, MapType, ArrayType, VariantType)):
        return F.to_json(F.col(name))
    return F.col(name).cast("string")


def flatten_access_history(raw: DataFrame, strict: bool = True) -> DataFrame:
    """The 18 columns of an access history from one row a query.

    A query gives a row for each combination of an object it accessed directly, one it accessed as
    a base, and one it modified; an empty or missing array counts as one object without a name, so no
    query is lost. ``OBJECT_MODIFIED_BY_DDL`` becomes JSON text. Arrays are those of one query:
    nothing is shuffled. With ``strict`` nested text that cannot be read raises, else it is a
    missing array.
    """
    # One array after the other, so that only the columns of what is still to come are repeated.
    df = raw
    for prefix, name in NESTED.items():
        array = objects(raw, name)
        if strict and isinstance(raw.schema[_found(raw, name)].dataType, StringType):
            broken = F.col(name).isNotNull() & array.isNull() & (F.trim(name) != "null")
            message = F.concat(F.lit(f"{name} is not an array of objects: "), F.left(F.col(name), F.lit(100)))
            array = F.when(broken, F.raise_error(message).cast(ArrayType(OBJECT))).otherwise(array)
        df = df.withColumn(f"__{prefix}", array)
    for prefix in NESTED:
        df = df.withColumn(f"__{prefix}", F.explode_outer(f"__{prefix}"))

    def column(field: StructField) -> Column:
        for prefix in NESTED:
            if field.name.startswith(prefix + "_") and field.name != "OBJECT_MODIFIED_BY_DDL":
                return F.col(f"__{prefix}")[PARTS[field.name.removeprefix(prefix + "_")]]
        if field.name == "OBJECT_MODIFIED_BY_DDL":
            return _text(raw, field.name)
        return F.col(field.name)

    return df.select(*[column(field).cast(field.dataType).alias(field.name) for field in ACCESS_HISTORY])
