"""Mentions of many objects in one pass over a query log.

Two ways to say what a mention is:

- by text, as ``object_mentions`` does for one object: a name without regard to case, anywhere, with
  ``_`` and ``%`` as wildcards unless ``literal``;
- by identifier: a name that the query text writes outside of strings and comments, with its parts in quotes or
  not, and with the database and schema of the session where it leaves them out.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dustline.functions.text import mention_pattern

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Names of an automaton, some 100 MB at 100 characters a name; more names are more scans.
NAMES = 200_000


def fragments(pattern: str) -> tuple[str, str | None]:
    """The longest text that every match of a ``LIKE`` pattern contains, and a regular expression of
    the pattern if that text is not all of it."""
    parts, pieces, text, plain = [], [], "", True
    inner = pattern[1:-1]  # without the signs for "anywhere"
    place = 0
    while place < len(inner):
        sign = inner[place]
        if sign == "\\" and place + 1 < len(inner):
            place += 1
            text += inner[place]
        elif sign in "%_":
            plain = False
            parts.append(text)
            pieces += [re.escape(text), ".*" if sign == "%" else "."]
            text = ""
        else:
            text += sign
        place += 1
    parts.append(text)
    pieces.append(re.escape(text))
    return max(parts, key=len), None if plain else "".join(pieces)


class Automaton:
    """Finds which of many lower-case patterns a lower-case text matches, reading it once."""

    def __init__(self, patterns: Sequence[str]) -> None:
        import ahocorasick

        self.sure, self.tested, self.always = {}, {}, []
        for number, pattern in enumerate(patterns):
            text, rest = fragments(pattern)
            if not text:
                self.always.append((number, re.compile(rest or "", re.DOTALL)))
            elif rest is None:
                self.sure.setdefault(text, []).append(number)
            else:
                self.tested.setdefault(text, []).append((number, re.compile(rest, re.DOTALL)))
        self.words = ahocorasick.Automaton()
        for text in self.sure.keys() | self.tested.keys():
            self.words.add_word(text, text)
        self.words.make_automaton()

    def matches(self, text: str) -> list[int]:
        met = {word for _, word in self.words.iter(text)} if len(self.words) else set()
        found = [number for word in met for number in self.sure.get(word, ())]
        tested = [pair for word in met for pair in self.tested.get(word, ())]
        return found + [number for number, rest in [*tested, *self.always] if rest.search(text)]


def automaton_of(tables: dict) -> Automaton:
    """The automaton of patterns that were sent to a worker, which keeps it for its later tasks."""
    if "automaton" not in tables:
        tables["automaton"] = Automaton(tables["patterns"])
    return tables["automaton"]


def mention_batches(tables):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(tables.value)
        for batch in batches:
            numbers, rows = [], []
            for row, text in enumerate(batch.column(0).to_pylist()):
                found = automaton.matches(text)
                numbers += found
                rows += [row] * len(found)
            times = batch.column(1).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), times], names=["number", "end_time"])

    return run


def all_object_mentions(
    query_log: DataFrame, names: Sequence[str], literal: bool = False, most: int = NAMES
) -> DataFrame:
    """object_name, last_usage and query_count: a row for each of ``names``, mentioned or not.

    What ``object_mentions`` gives for each, in one scan for every ``most`` names. An Aho-Corasick
    automaton of all names goes to the workers once; a query text is read by it once, however many
    names there are. Mentions are counted where they are found, so a row for each name and task is
    shuffled. Names that are given twice are one.
    """
    spark = query_log.sparkSession
    names = list(dict.fromkeys(names))
    log = query_log.where(F.col("query_text").isNotNull()).select(F.lower("query_text"), "end_time")
    kind = query_log.schema["end_time"].dataType
    found = None
    for start in range(0, max(len(names), 1), most):
        some = names[start : start + most]
        rows = [(number, name, mention_pattern(name, literal)) for number, name in enumerate(some)]
        named = spark.createDataFrame(rows, "number long, object_name string, pattern string")
        # The session's own rule of what is lower case, for names as for texts.
        lowered = named.select("number", F.lower("pattern").alias("pattern")).collect()
        patterns = [row["pattern"] for row in sorted(lowered)]
        tables = spark.sparkContext.broadcast({"patterns": patterns})
        schema = StructType().add("number", "long").add("end_time", kind)
        counted = (
            log.mapInArrow(mention_batches(tables), schema)
            .groupBy("number")
            .agg(F.max("end_time").alias("last_usage"), F.count(F.lit(1)).alias("query_count"))
        )
        part = named.join(counted, "number", "left").select(
            "object_name", "last_usage", F.coalesce("query_count", F.lit(0)).alias("query_count")
        )
        found = part if found is None else found.union(part)
    return found


# Identifiers. Fixed values of SQL: strings, comments, and names of up to three parts.
STRING = r"'(?:[^'\\]|\\(?s:.)|\\\z|'')*+(?:'|\z)"
COMMENT = r"--[^\n]*+|//[^\n]*+|/\*(?s:.*?)(?:\*/|\z)"
DOLLARS = r"\$\$(?s:.*?)(?:\$\$|\z)"
PART = r'"(?:[^"]|"")++"|[\p{L}_][\p{L}\p{N}_$]*+'
CHAIN = rf"(?:{PART})(?:\s*+\.\s*+(?:{PART}))*+"
TOKEN = rf"{STRING}|{COMMENT}|{DOLLARS}|[0-9][\p{{L}}\p{{N}}_$.]*+|({CHAIN})"


def identifiers(text: Column, database: Column, schema: Column) -> Column:
    """The full names, as arrays of database, schema and object, that a query text writes.

    Each once. A name in quotes is as it is written, others are upper case, as SQL has it. One part is
    an object of the given schema, two are a schema of the given database and an object; of more
    than three the first three count, as what follows is a column. Words of the language are
    names like others, of objects that nobody has.
    """
    chains = F.array_distinct(F.filter(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1)), lambda c: c != ""))

    def part(written: Column) -> Column:
        own = F.substring(written, F.lit(2), F.length(written) - 2)
        own = F.replace(own, F.lit('""'), F.lit('"'))
        return F.when(written.startswith('"'), own).otherwise(F.upper(written))

    def resolved(chain: Column) -> Column:
        parts = F.transform(F.regexp_extract_all(chain, F.lit(f"({PART})"), F.lit(1)), part)
        n = F.size(parts)
        return (
            F.when(n == 1, F.concat(F.array(database, schema), parts))
            .when(n == 2, F.concat(F.array(database), parts))
            .otherwise(F.slice(parts, 1, 3))
        )

    return F.array_distinct(F.transform(chains, resolved))


def mention_index(query_log: DataFrame, database: str | Column = "", schema: str | Column = "") -> DataFrame:
    """object_database, object_schema, object_name, last_usage and query_count of every name that
    query texts write (see ``identifiers``).

    ``database`` and ``schema`` are those of the session that ran a query: a value for all, or
    a column of the log. Names are counted where they are found before they are shuffled.
    """
    database, schema = (x if isinstance(x, Column) else F.lit(x) for x in (database, schema))
    names = identifiers(F.col("query_text"), database, schema)
    each = query_log.select(F.explode(names).alias("name"), "end_time")
    return each.groupBy(
        F.col("name")[0].alias("object_database"),
        F.col("name")[1].alias("object_schema"),
        F.col("name")[2].alias("object_name"),
    ).agg(F.max("end_time").alias("last_usage"), F.count(F.lit(1)).alias("query_count"))


def identifier_mentions(index: DataFrame, objects: DataFrame) -> DataFrame:
    """``objects`` (object_database, object_schema, object_name, in the case they have in the catalog, and any other
    columns) with last_usage and query_count of their own name, null and 0 where it is not in the
    ``mention_index``. One join by equality, however many objects there are."""
    names = ["object_database", "object_schema", "object_name"]
    objects = objects.drop("last_usage", "query_count")
    found = objects.join(index.select(*names, "last_usage", "query_count"), names, "left")
    return found.withColumn("query_count", F.coalesce("query_count", F.lit(0))).select(
        *[F.col(f"`{c}`") for c in objects.columns], "last_usage", "query_count"
    )


def catalog_objects(spark: SparkSession, database: str) -> list[str]:
    """The full names of the tables and views of a database of the session's catalog."""
    catalog = spark.catalog.currentCatalog()
    tables = spark.catalog.listTables(database)
    return [f"{catalog}.{database}.{t.name}" for t in tables if not t.isTemporary]
