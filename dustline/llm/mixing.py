"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, repeated up to a number of
times. A document's virtual finish time is the number of its source's words up to and
including it, divided by the source's weight. All documents are sorted by that time, and the
mix is what comes before the total budget is used up. A source whose queue runs dry leaves
its share to the others in proportion to their weights, which is what the targets say.

Null and empty texts have no words; they have a place in the order and take no words. Of a long text
only its size takes part, and it is taken whole or not at all. A null
source is a source of its own, last in order. Equal rows are told apart by a row number. An
empty table gives an empty mix. All columns of the input pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dustline.llm.common import (
    ROW,
    WORD,
    in_ranges,
    packed,
    range_starts,
    row_of,
    running_total,
    staged_small,
)
from dustline.sources.shared import staged

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3


def _by_source() -> Column:
    return F.col("source").asc_nulls_last()


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffled(doc_id: Column) -> Column:
    """A place in the shuffled order that depends on the document alone."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def source_targets(
    sized: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """Columns source, source_size, source_start, weight and target: a row for each source.

    Sources in order of code points get the weights in turn. The targets share all words by
    weight, and none is above ``max_repeats`` times its source's words. With sources in
    order of (limit / weight), those that reach their limit come first, and the common level
    of the others, in words for each unit of weight, is the largest over all such cuts.
    """
    sources = sized.groupBy("source")
    sources = sources.agg(F.sum("size").alias("source_size"), F.lit(1).alias("__one"))
    sources = staged_small(sources, "mix-sources", sized.count())
    most = sources.count()
    ranked = running_total(sources, [_by_source()], "__one", "__rank", "mix-rank", most)
    ranked = running_total(ranked, [_by_source()], "source_size", "__end", "mix-start", most)
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.select(
        "source",
        "source_size",
        (F.col("__end") - F.col("source_size")).alias("source_start"),
        F.element_at(turn, ((F.col("__rank") - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * max_repeats).alias("__limit"),
    )
    by_level = [F.col("__limit") / F.col("weight"), _by_source()]
    filled = running_total(ranked, by_level, "__limit", "__limits", "mix-limits", most)
    filled = running_total(filled, by_level, "weight", "__weights", "mix-weights", most)
    filled = staged_small(filled, "mix-levels", most)
    totals = filled.agg(F.sum("source_size").alias("all"), F.sum("weight").alias("w")).first()
    left = F.lit(totals["all"]).cast("double") - (F.col("__limits") - F.col("__limit"))
    sharing = F.lit(totals["w"]).cast("double") - (F.col("__weights") - F.col("weight"))
    level = filled.agg(F.max(left / sharing).alias("level")).first()["level"]
    target = F.least(F.col("__limit").cast("double"), F.lit(level) * F.col("weight"))
    return filled.select(
        "source", "source_size", "source_start", "weight", target.alias("target")
    )


def mix_plan(
    sized: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """``sized`` with source_size, target, copies and taken.

    ``sized`` has the columns doc_id, source, size and ``__row`` and is best a written table,
    for it is read more than once. ``copies`` says how often the mix holds the document,
    ``taken`` how many words that makes.
    """
    rows = sized.count()
    sources = staged_small(source_targets(sized, weights, max_repeats), "mix-targets", rows)
    placed = sized.withColumn("__key", shuffled(F.col("doc_id")))
    order = [_by_source(), F.col("__key"), F.col(ROW)]
    placed = running_total(placed, order, "size", "__total", "mix-queues", rows).alias("d")
    queued = staged_small(
        placed.join(sources.alias("s"), F.expr("d.source <=> s.source")).select(
            "d.*",
            "s.source_size",
            "s.target",
            "s.weight",
            (F.col("__total") - F.col("source_start")).alias("__served"),
        ),
        "mix-queued",
        rows,
    )

    def place(repeat: Column) -> list[Column]:
        finish = (repeat * F.col("source_size") + F.col("__served")) / F.col("weight")
        return [finish.alias("__finish"), F.col("__key"), F.col(ROW), repeat.alias("__repeat")]

    # A document without words is taken once at most.
    repeats = F.when(F.col("size") > 0, F.lit(max_repeats - 1)).otherwise(0)
    entries = queued.select(
        "*", F.explode(F.sequence(F.lit(0), repeats)).alias("__repeat")
    ).select("size", *place(F.col("__repeat")))
    names = ["__finish", "__key", ROW, "__repeat"]
    order = [F.col(name) for name in names]
    ranged = in_ranges(entries, order, "mix-entries", rows * max_repeats)
    budget = sized.agg(F.sum("size")).first()[0] or 0
    starts = staged_small(range_starts(ranged, "size"), "mix-starts", 1)
    # The range in which the budget is used up is the only one to be looked at row by row.
    last = starts.where(F.col("__start") + F.col("__sum") > budget).agg(F.min("__range")).first()[0]
    if last is None:
        copies = repeats + 1
    else:
        start = starts.where(F.col("__range") == last).first()["__start"]
        stop = _first_beyond(ranged.where(F.col("__range") == last), names, budget - start)
        row = row_of(F.lit(stop[ROW]["file"]), F.lit(stop[ROW]["row"]))
        beyond = F.struct(
            *[row.alias(ROW) if name == ROW else F.lit(stop[name]).alias(name) for name in names]
        )
        # Spark compares structs field by field, as the sort does.
        copies = sum(
            (
                ((F.lit(i) <= repeats) & (F.struct(*place(F.lit(i))) < beyond)).cast("int")
                for i in range(max_repeats)
            ),
            F.lit(0),
        )
    return queued.withColumn("copies", copies).select(
        *sized.columns,
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def _first_beyond(entries: DataFrame, names: list[str], budget: int) -> dict:
    """The first entry of one range that the budget no longer holds."""
    window = Window.partitionBy("__range").orderBy(*names)
    window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("size").over(window)
    beyond = entries.withColumn("__total", total).where(F.col("__total") > budget)
    return beyond.agg(F.min(F.struct(*names)).alias("stop")).first()["stop"].asDict()


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    written: bool = False,
) -> DataFrame:
    """The documents of the mix with all their columns, each as often as the mix takes it. A
    ``written`` table is one as it was read from its files (see ``packed``)."""
    rows = packed(docs, "mix-documents", written)
    size = word_count(F.col("__doc.text")).alias("size")
    sized = staged(rows.select(ROW, "__doc.doc_id", "__doc.source", size), "mix-sized")
    copies = mix_plan(sized, weights, max_repeats).where(F.col("copies") > 0)
    copies = copies.select(ROW, F.sequence(F.lit(1), F.col("copies")).alias("__copies"))
    taken = rows.join(copies, ROW).select("__doc", F.explode("__copies"))
    return taken.select("__doc.*")
