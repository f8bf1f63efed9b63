"""The fitted operators held against plain versions, score by score, over whole tables."""

import collections
import itertools
import math
import pathlib
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dustline.llm import language_id, queries, quality_classifier

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="given tables are not here")


def part(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


# Languages


def letter_runs(text):
    runs = itertools.groupby(text.lower(), lambda c: unicodedata.category(c).startswith("L"))
    return ["".join(run) for is_letter, run in runs if is_letter]


def pieces(word):
    padded = f" {word} "
    return [padded[i:j] for i in range(len(padded)) for j in range(i + 1, min(i + 5, len(padded)) + 1)]


def frequent(counts, most):
    """The entries with the largest share of a language."""
    totals = {lang: sum(of.values()) for lang, of in counts.items()}
    shares = collections.defaultdict(float)
    for lang, of in counts.items():
        for entry, n in of.items():
            shares[entry] = max(shares[entry], n / totals[lang])
    return sorted(shares, key=lambda e: (-shares[e], e))[:most]


def plain_languages(rows, most_words, most_grams):
    """doc_id to language and score; rows are doc_id, text and lang."""
    words, grams = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for doc_id, text, lang in rows:
        if text is not None and lang is not None and part(doc_id, 4) != 2:
            words[lang].update(letter_runs(text))
            grams[lang].update(p for w in letter_runs(text) for p in pieces(w))
    langs = sorted(words)
    known = dict.fromkeys(frequent(words, most_words))
    parts = dict.fromkeys(frequent(grams, most_grams))
    sizes = collections.Counter(map(len, parts))
    for word in known:
        known[word] = [
            math.log((words[lang][word] + 0.5) / (sum(words[lang].values()) + 0.5 * len(known))) for lang in langs
        ]
    in_all = {
        (lang, size): sum(n for gram, n in grams[lang].items() if len(gram) == size)
        for lang in langs
        for size in sizes
    }
    for gram in parts:
        size = len(gram)
        parts[gram] = [
            math.log((grams[lang][gram] + 0.5) / (in_all[lang, size] + 0.5 * sizes[size])) for lang in langs
        ]

    def scores(word):
        if word in known:
            return known[word]
        padded, read = f" {word} ", []
        for i in range(len(padded)):
            longest = [padded[i:j] for j in range(len(padded), i, -1) if padded[i:j] in parts]
            read += longest[:1]
        return [sum(parts[g][k] for g in read) / len(read) if read else 0 for k in range(len(langs))]

    found = {}
    for doc_id, text, _ in rows:
        every = collections.Counter(letter_runs(text or ""))
        sums = [0.0] * len(langs)
        for word, n in every.items():
            sums = [a + n * b for a, b in zip(sums, scores(word), strict=True)]
        best = max(range(len(langs)), key=lambda k: (sums[k], -k))
        share = 1 / sum(math.exp(s - sums[best]) for s in sums)
        found[doc_id] = (langs[best], share) if every else ("und", 0.0)
    return found


@pytest.mark.parametrize("most", [(60_000, 60_000), (500, 3000)])
def test_languages_as_in_a_plain_version(spark, monkeypatch, most):
    monkeypatch.setattr(language_id, "WORDS", most[0])
    monkeypatch.setattr(language_id, "GRAMS", most[1])
    found = {r["doc_id"]: r for r in queries.op3_language_id(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    expected = plain_languages(rows, *most)
    assert found.keys() == expected.keys()
    for doc_id, (lang, score) in expected.items():
        assert found[doc_id]["lang_pred"] == lang and found[doc_id]["score"] == pytest.approx(score, abs=1e-4)
        assert found[doc_id]["held_out"] == (part(doc_id, 4) == 2)


def test_letters_above_and_below_the_first_plane():
    draw = random.Random(4)
    kinds = ["abcßéÀĲ", " .0²½Ⅻ_ª〇", "中ก́ퟻ", "\U00010400\U0001f600\U00020000"]
    for _ in range(2000):
        kind = "".join(draw.sample(kinds, draw.randint(1, 4)))
        text = "".join(draw.choices(kind, k=draw.randint(0, 12)))
        assert language_id.words_of(text) == language_id.LETTERS.findall(text.lower())


def test_tables_of_many_languages_are_bounded(spark, monkeypatch):
    """200 languages of a few words each: beyond the bytes tables have fewer entries, and all rows a language."""
    monkeypatch.setattr(language_id, "TABLE_BYTES", 400_000)
    draw = random.Random(9)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 800)]
    rows = [
        (10 * lang + i, " ".join("".join(draw.choices(letters[4 * lang : 4 * lang + 4], k=3)) for _ in range(20)), f"l{lang:03}")
        for lang in range(200)
        for i in range(8)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert len(model["languages"]) == 200
    assert model["word_logs"].nbytes <= 400_000 and model["gram_logs"].nbytes <= 400_000
    scorer = language_id.Scorer(model)
    assert scorer.table.nbytes <= 800_000
    # More unknown words at once than the table has room for.
    monkeypatch.setattr(language_id, "REMEMBERED_CHARS", 1000)
    texts = [text for _, text, _ in rows]
    assert scorer.predict(" ".join(texts)) == language_id.Scorer(model).predict(" ".join(texts))
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs).collect()}
    lang = {doc_id: name for doc_id, _, name in rows}
    assert sum(found[d] == lang[d] for d in lang) > 0.9 * len(lang)


# Quality


def plain_features(text):
    tokens = re.findall(r"\w+|[^\w\s]+", text.lower())
    words = text.lower().split()
    found = {(t,) for t in tokens} | {(a, b) for a, b in itertools.pairwise(tokens)}
    for n in (2, 3):
        if any(len(set(words[i : i + n])) == 1 for i in range(len(words) - n + 1)):
            found.add((" ",) * n)
    return found


def plain_descent(examples, every):
    sums = {label: collections.Counter(f for fs, y in examples if y == label for f in fs) for label in (0, 1)}
    totals = {label: sum(sums[label].values()) + len(every) for label in (0, 1)}
    ratio = {f: math.log((sums[1][f] + 1) / totals[1]) - math.log((sums[0][f] + 1) / totals[0]) for f in every}
    share = sum(y for _, y in examples) / len(examples)
    many, share = int(share >= 0.5), max(share, 1 - share)
    weights, constant, duals = dict.fromkeys(every, 0.0), 0.0, [0.0] * len(examples)
    order = np.random.default_rng(0)
    for _ in range(quality_classifier.ROUNDS):
        for i in order.permutation(len(examples)):
            features, label = examples[i]
            sign = 1 if label else -1
            cost = 0.03 if label == many else 0.03 * share / (1 - share)
            slope = sign * (sum(weights[f] * ratio[f] for f in features) + constant) - 1
            norm = 1 + sum(ratio[f] ** 2 for f in features)
            new = min(max(duals[i] - slope / norm, 0), cost)
            step, duals[i] = (new - duals[i]) * sign, new
            for f in features:
                weights[f] += step * ratio[f]
            constant += step
    return {f: weights[f] * ratio[f] for f in every}, constant


def plain_sigmoid(margins, labels):
    """Slope and offset of the greatest likelihood: Newton's steps, halved until it grows."""
    ones = sum(labels)
    targets = [(ones + 1) / (ones + 2) if y else 1 / (len(labels) - ones + 2) for y in labels]

    def loss(a, b):
        return sum(math.log1p(math.exp(-abs(z))) + max(z, 0) - t * z for m, t in zip(margins, targets, strict=True) for z in [a * m + b])

    a = b = 0.0
    for _ in range(200):
        p = [1 / (1 + math.exp(-(a * m + b))) for m in margins]
        ga = sum((q - t) * m for q, t, m in zip(p, targets, margins, strict=True))
        gb = sum(q - t for q, t in zip(p, targets, strict=True))
        haa = sum(q * (1 - q) * m * m for q, m in zip(p, margins, strict=True)) + 1e-9
        hab = sum(q * (1 - q) * m for q, m in zip(p, margins, strict=True))
        hbb = sum(q * (1 - q) for q in p) + 1e-9
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        rate = 1.0
        while rate > 1e-6 and loss(a - rate * da, b - rate * db) > loss(a, b):
            rate /= 2
        a, b = a - rate * da, b - rate * db
    return a, b


def test_quality_as_in_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    rows = docs.join(labels, "doc_id", "left").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").collect()
    fitted = [(plain_features(r["text"] or ""), r["label"]) for r in rows if r["label"] is not None and part(r["doc_id"], 5)]
    counts = collections.Counter(f for features, _ in fitted for f in features)
    common = {f for f, n in counts.items() if n >= quality_classifier.LEAST}
    assert 20 < len(common) < quality_classifier.FEATURES
    fitted = [(sorted(features & common), label) for features, label in fitted]
    inner = [e for i, e in enumerate(fitted) if i % 4]
    each, constant = plain_descent(inner, common)
    outer = [(sum(each[f] for f in features) + constant, label) for features, label in fitted[::4]]
    slope, offset = plain_sigmoid([m for m, _ in outer], [y for _, y in outer])
    each, constant = plain_descent(fitted, common)
    found = {r["doc_id"]: r for r in queries.op9_quality_classifier(spark, SF).collect()}
    assert len(found) == len(rows)
    for r in rows:
        margin = constant + sum(each.get(f, 0) for f in plain_features(r["text"] or ""))
        score = 1 / (1 + math.exp(-max(-700, min(700, slope * margin + offset))))
        got = found[r["doc_id"]]
        assert got["score"] == pytest.approx(score, abs=1e-3)
        assert got["held_out"] == (part(r["doc_id"], 5) == 0)
        assert got["predicted"] == (got["score"] >= 0.3)
        if abs(score - 0.3) > 1e-3:
            assert got["predicted"] == (score >= 0.3)
