"""A quality classifier: a support vector machine over naive Bayes features.

Features are indicators of a text's n-grams: its words and punctuation, and pairs of neighbours;
a word twice or thrice in a row is also an n-gram of its own, whichever word it is.
Each is scaled by the log ratio of its frequency in texts of either class, and a linear model
with hinge loss is fitted by dual coordinate descent: one example at a time, the weight
of its constraint is set to what is best with all others fixed. A sigmoid that is fitted
to the margins of examples left out of a first fit turns margins into scores.

The fit uses a bounded sample of the labelled rows, drawn evenly by hash, and keeps a bounded
number of features, those in most examples. It runs in one task, which that bound allows.
Where the texts drawn are more than its bytes, rows are left out of the fit, of long texts the
longest; a text longer than what is left for long ones is not learned from, but it is scored.
A null text counts as empty and gets the score of a text without features. Labels that are
null are not learned from; of several labels of a document the least counts. If one class is
missing from what is learned, the score is the other's share. Repeated rows are scored alike.
Other columns of the input play no part.
"""

from __future__ import annotations

import json
import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dustline.llm.language_id import fold
from dustline.sources.shared import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.3
#: The sample: labelled documents and bytes of their texts.
SAMPLE_DOCS = 8000
SAMPLE_BYTES = 40_000_000
#: Texts of more bytes are long: should the sample not fit, they share its bytes with the others.
LONG = 100_000
#: Features that a model keeps, each in so many examples at least.
FEATURES = 150_000
LEAST = 5
SMOOTHING = 1.0
#: The cost of an example within the margin, rounds of the descent, examples left out of the
#: first fit: one in so many.
COST = 0.03
ROUNDS = 12
LEFT_OUT = 4

#: Stands for a word like the one before; no token looks like it.
SAME = (" ",)
TOKEN = re.compile(r"\w+|[^\w\s]+")


def features_of(text: str | None) -> set:
    lowered = (text or "").lower()
    tokens, words = TOKEN.findall(lowered), lowered.split()
    found = set(tokens).union(zip(tokens, tokens[1:], strict=False))
    if any(map(str.__eq__, words, words[1:])):
        found.add(SAME * 2)
        if any(a == b == c for a, b, c in zip(words, words[1:], words[2:], strict=False)):
            found.add(SAME * 3)
    return found


def hashed(features: Iterable) -> np.ndarray:
    """A 64-bit number of each feature."""
    texts = (f if isinstance(f, str) else "\0".join(f) for f in features)
    return np.array([xxhash.xxh64_intdigest(text) for text in texts], np.uint64)


def common_features(texts: list[str]) -> list[list]:
    """The features of each text, but for those that fewer than LEAST texts have.

    Most pairs of words occur once. They are counted by their hashes, a few bytes each, and
    dropped before features of all texts are held at once.
    """
    values, counts = np.unique(
        np.concatenate([hashed(features_of(text)) for text in texts]), return_counts=True
    )
    common = set(values[counts >= LEAST].tolist())
    found = []
    for text in texts:
        features = list(features_of(text))
        numbers = hashed(features).tolist()
        found.append([f for f, n in zip(features, numbers, strict=True) if n in common])
    return found


def log_ratios(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """The log ratio of each feature's share of all indicators in either class."""
    sums = np.full((2, size), SMOOTHING)
    for row, label in zip(rows, labels, strict=True):
        sums[int(label), row] += 1
    shares = sums / sums.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def descend(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Weights of the scaled indicators, the last that of the constant feature.

    Examples of the rarer class cost more, so that both classes weigh alike.
    """
    weights, signs = np.zeros(len(scale) + 1), np.where(labels == 1, 1.0, -1.0)
    share = max(labels.mean(), 1 - labels.mean())
    costs = np.where((labels == 1) == (labels.mean() >= 0.5), COST, COST * share / (1 - share))
    duals = np.zeros(len(rows))
    norms = np.array([1 + (scale[row] ** 2).sum() for row in rows])
    order = np.random.default_rng(0)
    for _ in range(ROUNDS):
        for i in order.permutation(len(rows)):
            row = rows[i]
            scaled = scale[row]
            gradient = signs[i] * (weights[row] @ scaled + weights[-1]) - 1
            new = min(max(duals[i] - gradient / norms[i], 0.0), costs[i])
            if new != duals[i]:
                step = (new - duals[i]) * signs[i]
                weights[row] += step * scaled
                weights[-1] += step
                duals[i] = new
    return weights


def sigmoid(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make the labels likeliest, by Newton's method."""
    ones = labels.sum()
    # Targets that stay off 0 and 1 keep the slope finite where margins part the classes.
    targets = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    inputs = np.stack([margins, np.ones(len(margins))], axis=1)
    found = np.zeros(2)
    for _ in range(100):
        chances = 1 / (1 + np.exp(-np.clip(inputs @ found, -35, 35)))
        slope = inputs.T @ (targets - chances)
        curve = (inputs * (chances * (1 - chances))[:, None]).T @ inputs + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        found += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(found[0]), float(found[1])


def fit_model(texts: list[str], labels: list[int]) -> dict:
    """The weights of features, the constant, and the sigmoid."""
    marks = np.array(labels, np.int64)
    if not len(marks) or marks.min() == marks.max():
        # Nothing to tell apart: the share of class 1, by Laplace's rule.
        share = (marks.sum() + 1) / (len(marks) + 2)
        return {"weights": [], "constant": float(np.log(share / (1 - share))), "sigmoid": [1, 0]}
    found = common_features(texts)
    counts = Counter(feature for features in found for feature in features)
    common = [(n, f) for f, n in counts.items()]
    common.sort(key=lambda x: (-x[0], str(x[1])))
    places = {feature: place for place, (_, feature) in enumerate(common[:FEATURES])}
    rows = [np.array(sorted(places[f] for f in fs if f in places), np.int64) for fs in found]

    def fitted(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        some = [rows[i] for i in chosen]
        scale = log_ratios(some, marks[chosen], len(places))
        return scale, descend(some, marks[chosen], scale)

    every = np.arange(len(rows))
    out = every % LEFT_OUT == 0
    if len(set(marks[~out])) == 2 and len(set(marks[out])) == 2:
        scale, weights = fitted(every[~out])
        margins = [weights[rows[i]] @ scale[rows[i]] + weights[-1] for i in every[out]]
        curve = sigmoid(np.array(margins), marks[out])
    else:
        curve = (1.0, 0.0)
    scale, weights = fitted(every)
    each = scale * weights[:-1]
    kept = [(f, float(each[p])) for f, p in places.items() if abs(each[p]) > 1e-6]
    return {"weights": kept, "constant": float(weights[-1]), "sigmoid": list(curve)}


def fit_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], []
    for batch in batches:
        texts += batch.column("text").to_pylist()
        labels += batch.column("label").to_pylist()
    model = json.dumps(fit_model(texts, labels))
    yield pa.RecordBatch.from_arrays([pa.array([model])], names=["model"])


def affordable(rows: DataFrame) -> DataFrame:
    """``rows`` (size and n, how many are alike, in ``order``) with n cut to what the bytes allow.

    Texts up to LONG and longer ones may have half of the bytes each, and what the others leave:
    no long text takes the place of all others. Short ones are taken by hash, long ones by size.
    """
    all_bytes, is_long = F.sum(F.col("size") * F.col("n")), F.col("size") > LONG
    kind = Window.partitionBy("long").orderBy(F.when(is_long, F.col("size")), "order")
    before = all_bytes.over(kind.rowsBetween(Window.unboundedPreceding, -1))
    totals = rows.agg(
        *[F.coalesce(F.sum(F.when(c, F.col("size") * F.col("n"))), F.lit(0)) for c in (~is_long, is_long)]
    ).first()
    of_short, of_long = (SAMPLE_BYTES - min(SAMPLE_BYTES // 2, total) for total in totals[::-1])
    left = F.when(is_long, of_long).otherwise(of_short) - F.coalesce("before", F.lit(0))
    fits = F.when(F.col("size") == 0, F.col("n")).otherwise(F.floor(F.try_divide(left, F.col("size"))))
    known = rows.withColumn("long", is_long).withColumn("before", before)
    return known.withColumn("n", F.least("n", fits).cast("int")).where("n > 0").drop("long", "before")


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and label of a bounded number of rows of ``docs`` that ``labels`` (doc_id, label)
    marks, in one partition."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    by_hash = [F.xxhash64("doc_id", F.lit(1)), F.col("doc_id")]
    # At most SAMPLE_DOCS rows of two numbers, so a broadcast is bounded.
    marked = staged(marked.orderBy(*by_hash).limit(SAMPLE_DOCS), "classifier-labels")
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select("doc_id", text).withColumn("hash", F.xxhash64("text"))
    # doc_id may repeat in docs: the first rows by hash, as far as the bytes reach. They are
    # chosen by numbers alone, and only then are the texts of those chosen moved.
    found = rows.select("doc_id", "hash", F.octet_length("text").cast("long").alias("size"))
    found = found.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "label", "hash", "size")
    place = F.struct(*[c.alias(f"p{i}") for i, c in enumerate([*by_hash, F.col("hash")])])
    found = found.agg(F.count("*").alias("n")).withColumn("order", place)
    found = found.orderBy("order").limit(SAMPLE_DOCS)
    earlier = Window.orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    room = SAMPLE_DOCS - F.coalesce(F.sum("n").over(earlier), F.lit(0))
    found = found.withColumn("n", F.least("n", room)).where("n > 0")
    chosen = staged(affordable(staged(found, "classifier-sizes")), "classifier-sample")
    texts = rows.join(F.broadcast(chosen.select("doc_id", "hash")), ["doc_id", "hash"])
    texts = texts.groupBy("doc_id", "hash").agg(F.first("text").alias("text"))
    whole = texts.join(F.broadcast(chosen), ["doc_id", "hash"]).repartition(1)
    whole = whole.sortWithinPartitions("order").select("text", "label", "n")
    return whole.select("text", "label", F.explode(F.sequence(F.lit(1), "n"))).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """A model of the rows of ``docs`` that ``labels`` (doc_id, label) marks with 0 or 1."""
    fitted = sample(docs, labels).mapInArrow(fit_batches, "model string").first()
    model = json.loads(fitted["model"]) if fitted else fit_model([], [])
    model["weights"] = {tuple(f) if isinstance(f, list) else f: w for f, w in model["weights"]}
    return model


def score_batches(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = model.value
        weights, constant = found["weights"], found["constant"]
        slope, offset = found["sigmoid"]
        for batch in batches:
            margins = [
                constant + sum(weights[f] for f in features_of(text.as_py()) if f in weights)
                for text in batch.column("__text")
            ]
            scores = 1 / (1 + np.exp(-np.clip(slope * np.array(margins) + offset, -700, 700)))
            names = batch.schema.names[:-1]
            columns = [batch.column(name) for name in names] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "score"])

    return run


def score(docs: DataFrame, model: dict, kept: list[str]) -> DataFrame:
    """The columns ``kept`` of ``docs`` with score and predicted; only texts are looked at."""
    rows = docs.select(*kept, F.col("text").alias("__text"))
    schema = rows.drop("__text").schema.add("score", "double")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scored = rows.mapInArrow(score_batches(sent), schema)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score and predicted; ``labels`` has doc_id and label. Labels of rows
    that are held out are not learned from."""
    held = fold(F.col("doc_id"), folds) == held_out
    model = fit(docs, labels.where(~held))
    rows = docs.select("doc_id", "text", held.alias("held_out"))
    return score(rows, model, ["doc_id", "held_out"])
