"""Tokens against the tokenizers library, models by held-out accuracy and odd rows."""

import collections
import json
import math
import random
import zlib

import numpy as np
import pytest
from samples import odd_rows, plain, sentence
from pyspark.sql import functions as F

from dustline.llm import bpe, language_id, quality_classifier, token_lengths

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    found = tokenizers.Tokenizer.from_file(PATH)
    found.no_padding()
    found.no_truncation()
    return found


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(**bpe.read_tokenizer(PATH))


def packed_ids(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


# 7: encoding and decoding


def test_codes_like_the_library(odd, clashing, empty, library):
    found = bpe.transcode(clashing, PATH, clashing.columns)
    assert found.columns == [c for c in clashing.columns if c != "ids"] + ["n_tokens", "ids", "decoded"]
    texts = collections.Counter()
    for doc_id, text, *_ in odd_rows():
        ids = packed_ids(library, text or "")
        decoded = library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        texts[doc_id, ids, len(ids) // 4, decoded] += 1
    rows = found.select("doc_id", "ids", "n_tokens", "decoded").collect()
    assert collections.Counter((r[0], bytes(r[1]), r[2], r[3]) for r in rows) == texts
    assert bpe.transcode(empty, PATH, ["doc_id"]).count() == 0
    again = bpe.decode_ids(bpe.transcode(odd, PATH, ["doc_id"], ("ids",)), PATH)
    assert plain(again.select("doc_id", "decoded")) == plain(found.select("doc_id", "decoded"))


POOL = "aabbcceehttiinnssoorr '’.,!?0123 \n\tÀÉéßİΣσς漢字日本😀👍🏽́\x85\x1c\x1f​‍Жж�\u0000"
PARTS = ["<|startoftext|>", "<|endoftext|>", "<|", "'s", "'RE", "don't", "The", "ing"]


def test_random_texts(coder, library):
    draw = random.Random(7)
    for _ in range(4000):
        parts = [draw.choice(POOL if draw.random() < 0.93 else PARTS) for _ in range(draw.randint(0, 40))]
        text = "".join(parts)
        assert coder.encode(text) == packed_ids(library, text), text


@pytest.mark.parametrize("word", ["a" * 3000, "haha" * 500, "the" * 999 + "x", "tion" * 777])
def test_long_words(coder, library, word):
    assert coder.encode(word) == packed_ids(library, word)


def test_texts_in_stretches(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "STRETCH", 50)
    text = sentence(4, 400) + "　" + "é" * 200 + " x\u0085 y " + "b" * 120
    assert coder.encode(text) == packed_ids(library, text)


def test_full_tables_begin_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE", 3)
    small, text = bpe.Coder(**bpe.read_tokenizer(PATH)), sentence(8, 300)
    assert small.encode(text) == packed_ids(library, text)


def test_automaton_accepts_what_merging_leaves():
    """Every short word over a small alphabet, against merging pair by pair."""
    import itertools

    merges = [("a", "b"), ("a", "a"), ("ab", "b"), ("aa", "ab"), ("b", "a"), ("b", "a</w>"), ("ba", "b</w>")]
    base = [*"ab", "a</w>", "b</w>"]
    vocabulary = {t: i for i, t in enumerate([*base, *(x + y for x, y in merges)])}
    automaton = bpe.Automaton(vocabulary, merges)

    def merged(word):
        tokens = [*word[:-1], word[-1] + "</w>"]
        for one, two in merges:
            i = 0
            while i + 1 < len(tokens):
                if (tokens[i], tokens[i + 1]) == (one, two):
                    tokens[i : i + 2] = [one + two]
                i += 1
        return [vocabulary[t] for t in tokens]

    for n in range(1, 9):
        for letters in itertools.product("ab", repeat=n):
            word = "".join(letters)
            assert automaton.encode_word(word) == merged(word), word


def test_merges_out_of_order_are_refused():
    vocabulary = {t: i for i, t in enumerate(["a", "b", "ab", "abb"])}
    with pytest.raises(ValueError, match="merge 0"):
        bpe.Automaton(vocabulary, [("ab", "b"), ("a", "b")])


# 10: lengths


def test_token_lengths(odd, empty, library):
    lengths = [len(packed_ids(library, r[1] or "")) // 4 for r in odd_rows()]
    counts = collections.Counter(lengths)
    found = token_lengths.token_lengths(odd, PATH)
    expected = {
        (
            n,
            counts[n],
            sum(x >= n for x in lengths),
            sum(x for x in lengths if x >= n),
            sum(x <= n for x in lengths),
            sum(x <= n for x in lengths) / len(lengths),
            sum(lengths),
            sum(min(x, n) for x in lengths),
        )
        for n in counts
    }
    assert {tuple(r) for r in found.collect()} == expected
    limits = [0, 1, 57, 58, 10**6]
    answers = token_lengths.at_limits(found, limits).collect()
    assert {tuple(r) for r in answers} == {
        (c, sum(x > c for x in lengths), sum(min(x, c) for x in lengths)) for c in limits
    }
    shares = [0.001, 0.5, 0.9, 1.0]
    answers = {r["share"]: r["length"] for r in token_lengths.quantiles(found, shares).collect()}
    ordered = sorted(lengths)
    assert answers == {s: ordered[math.ceil(s * len(ordered) - 1e-9) - 1] for s in shares}
    assert token_lengths.token_lengths(empty, PATH).count() == 0


# 3: languages

VOICES = {"en": "th er on an re he in ed nd ha", "fr": "ée ou eau ment tion ai que le re oi"}
VOICES["de"] = "sch ung keit er ein ver ge ß zu ü"


def spoken(draw, lang, n):
    parts = VOICES[lang].split()
    return " ".join("".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def voices(spark):
    draw = random.Random(5)
    rows = [(i, spoken(draw, lang, 30), lang, "s", 1) for i in range(600) for lang in [draw.choice(list(VOICES))]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long")


def test_languages(voices):
    rows = language_id.identify(voices).collect()
    lang = {r["doc_id"]: r["lang"] for r in voices.collect()}
    assert len(rows) == 600 and all(0 <= r["score"] <= 1 for r in rows)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in rows if r["held_out"]]
    assert sum(lang[r["doc_id"]] == r["lang_pred"] for r in held) > 0.97 * len(held)


def test_unknown_words_fall_back(voices):
    model = language_id.fit(voices)
    model["words"] = {}
    scorer = language_id.Scorer(model)
    draw = random.Random(6)
    for lang in VOICES:
        assert scorer.predict(spoken(draw, lang, 40))[0] == lang


def test_held_out_rows_teach_nothing(voices):
    """Other labels and texts of held-out rows change no prediction of the rest."""
    held = language_id.fold(F.col("doc_id"), 4) == 2
    other = voices.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    columns = ["doc_id", "lang_pred", "score"]
    found = language_id.identify(other).select(columns)
    assert plain(found) == plain(language_id.identify(voices).select(columns))


def test_languages_of_odd_rows(odd, empty, clashing):
    rows = language_id.identify(odd).collect()
    assert len(rows) == len(odd_rows())
    letters = {r[0]: any(c.isalpha() for c in r[1] or "") for r in odd_rows() if r[0] is not None}
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not letters[r["doc_id"]])
        assert 0 <= r["score"] <= 1 and r["held_out"] is not None
    assert language_id.identify(empty).count() == 0
    assert language_id.identify(clashing).count() == len(odd_rows())
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_sample_is_bounded(voices, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_EACH", 50)
    assert 60 < language_id.sample(voices).count() < 240
    alike = voices.withColumn("text", F.lit("the same")).withColumn("doc_id", F.lit(1))
    monkeypatch.setattr(language_id, "SAMPLE_EACH", 10_000)
    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 100)
    assert 50 < language_id.sample(alike).count() < 160


def test_small_languages_stay_whole(voices, monkeypatch):
    """Beyond the bounds a language gets an equal part, the same on any layout of the rows."""
    rare = voices.where("lang = 'fr'").limit(7).withColumn("lang", F.lit("rare"))
    alike = voices.withColumns({"doc_id": F.lit(1), "text": F.lit("the same"), "lang": F.lit("one")})
    rows = voices.unionByName(rare).unionByName(alike).select("doc_id", "lang", "text").persist()

    def drawn(rows):
        return collections.Counter((r["lang"], r["text"]) for r in language_id.sample(rows).collect())

    def docs(found):
        return {lang: sum(n for (x, _), n in found.items() if x == lang) for lang in ["rare", "one", *VOICES]}

    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 100)
    found = drawn(rows)
    assert docs(found) == {"rare": 7, **dict.fromkeys(["one", *VOICES], 23)}
    assert found == drawn(rows.repartition(13)) == drawn(rows.repartition(2, "text"))
    monkeypatch.setattr(language_id, "SAMPLE_EACH", 200)
    assert docs(drawn(rows))["one"] == 23
    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 40_000)
    monkeypatch.setattr(language_id, "SAMPLE_BYTES", 50_000)
    long = rows.where("lang <> 'one'").withColumn(
        "text", F.when(F.crc32("text") % 20 == 0, F.rpad("text", 100_000, "long ")).otherwise(F.col("text"))
    )
    found = drawn(long)
    assert sum(len(text.encode()) * n for (_, text), n in found.items()) <= 50_000
    assert docs(found)["rare"] >= 5 and min(docs(found)[lang] for lang in VOICES) > 50


def test_equal_parts():
    assert language_id.equal_part([5, 100, 100], 105) == 50
    assert language_id.equal_part([5, 6, 7], 18) == 7
    assert language_id.equal_part([9, 9], 1) == 0 == language_id.equal_part([], 10)


# 9: quality


@pytest.fixture(scope="module")
def judged(spark):
    draw, rows = random.Random(8), []
    for i in range(700):
        bad = draw.random() < 0.2
        text = spoken(draw, "en", draw.randint(20, 60))
        if bad:
            text = draw.choice([text.replace(" ", "*** "), " ".join(w + " " + w for w in text.split())])
        rows.append((i, text, int(not bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def test_classifier(judged):
    docs, labels = judged.drop("label"), judged.drop("text")
    rows = quality_classifier.classify(docs, labels).collect()
    label = {r["doc_id"]: r["label"] for r in judged.collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(label[r["doc_id"]] == r["predicted"] for r in held) > 0.95 * len(held)
    flipped = labels.withColumn(
        "label", F.when(quality_classifier.fold(F.col("doc_id"), 5) == 0, 0).otherwise(F.col("label"))
    )
    assert plain(quality_classifier.classify(docs, flipped)) == sorted(map(tuple, rows), key=repr)


def test_descent_meets_the_optimum():
    """No step of one example's constraint betters the dual, and the margins follow."""
    draw = np.random.default_rng(2)
    rows = [np.flatnonzero(draw.random(12) < 0.4) for _ in range(60)]
    labels = (draw.random(60) < 0.5).astype(int)
    scale = draw.normal(size=12)
    quality_classifier.ROUNDS, rounds = 400, quality_classifier.ROUNDS
    weights = quality_classifier.descend(rows, labels, scale)
    quality_classifier.ROUNDS = rounds

    def loss(w):
        margins = np.array([w[r] @ scale[r] + w[-1] for r in rows])
        share = max(labels.mean(), 1 - labels.mean())
        rare = (labels == 1) != (labels.mean() >= 0.5)
        cost = quality_classifier.COST * np.where(rare, share / (1 - share), 1)
        return (w @ w) / 2 + cost @ np.maximum(0, 1 - np.where(labels == 1, 1, -1) * margins)

    best = loss(weights)
    for _ in range(300):
        assert loss(weights + draw.normal(size=13) * 0.01) >= best - 1e-6


def test_classifier_of_odd_rows(odd, empty, clashing, spark):
    labels = odd.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label"))
    rows = quality_classifier.classify(odd, labels).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_classifier.classify(empty, labels).count() == 0
    none = labels.limit(0)
    assert {r["score"] for r in quality_classifier.classify(odd, none).collect()} == {0.5}
    ones = labels.withColumn("label", F.lit(1))
    assert all(r["score"] > 0.9 for r in quality_classifier.classify(clashing, ones).collect())


def test_long_texts_take_no_place_of_others(judged, monkeypatch):
    """A labelled text beyond the bytes of the sample, first by hash, is left out alone; long ones
    that fit stay beside the short ones, however often a row repeats."""
    monkeypatch.setattr(quality_classifier, "SAMPLE_BYTES", 400_000)
    monkeypatch.setattr(quality_classifier, "LONG", 5_000, raising=False)
    docs, labels = judged.drop("label"), judged.drop("text")
    first = docs.orderBy(F.xxhash64("doc_id", F.lit(1))).first()["doc_id"]

    def drawn(changed):
        return collections.Counter(map(tuple, quality_classifier.sample(changed, labels).collect()))

    def lengthened(places, size):
        text = F.rpad("text", size, "long ")
        return docs.withColumn("text", F.when(places, text).otherwise(F.col("text")))

    whole = collections.Counter((r["text"], r["label"]) for r in judged.collect())
    assert drawn(docs) == whole
    without = whole - drawn(lengthened(F.col("doc_id") == first, 500_000))
    assert len(without) == 1 == sum(without.values())
    kinds = collections.Counter(len(text) > 5_000 for text, _ in drawn(lengthened(F.col("doc_id") < 50, 20_000)).elements())
    assert kinds[False] == 650 and 5 <= kinds[True] < 20
    copies = docs.where(F.col("doc_id") == first).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(10_000))))
    found = drawn(copies.drop("i").union(docs.where(F.col("doc_id") != first)))
    # Repeats count, as rows do; a bound of rows or bytes ends within them.
    assert len(found) == 1 and sum(len(t) * n for (t, _), n in found.items()) <= 400_000


@pytest.mark.parametrize(
    "change",
    [
        lambda t: t.update(normalizer=None),
        lambda t: t["normalizer"]["normalizers"].pop(),
        lambda t: t["pre_tokenizer"]["pretokenizers"][0].update(behavior="Isolated"),
        lambda t: t.update(decoder={"type": "BPEDecoder", "suffix": "</w>"}),
        lambda t: t["model"].update(ignore_merges=True),
        lambda t: t["model"].update(byte_fallback=True),
        lambda t: t["model"].update(unk_token="<|endoftext|>"),
        lambda t: t["model"].update(end_of_word_suffix="@"),
        lambda t: t["added_tokens"][0].update(lstrip=True),
        lambda t: t["added_tokens"][0].update(special=False),
    ],
)
def test_tokenizers_of_another_kind_are_refused(tmp_path, change):
    with open(PATH, encoding="utf-8") as file:
        parsed = json.load(file)
    assert bpe.differences(parsed) == []
    change(parsed)
    (tmp_path / "other.json").write_text(json.dumps(parsed))
    with pytest.raises(ValueError, match="has another"):
        bpe.read_tokenizer(str(tmp_path / "other.json"))
