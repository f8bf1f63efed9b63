"""Periodic runs, packing and spelling variants against plain versions in Python."""

import collections
import hashlib
import pathlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import CLASHING, odd_rows, plain

from dustline.llm import packing, periodic_runs, queries, spelling
from dustline.llm.periodic_runs import Grammar, runs_of_texts

DATA = pathlib.Path("/root/testdata")
given = pytest.mark.skipif(not DATA.exists(), reason="given tables are not here")


# 11: periodic runs


def plain_runs(words, least_length=6, least_repeats=4):
    """Every stretch of every period, as it is defined."""
    found = {}
    ids = np.unique(np.array([b"", *words], dtype=object), return_inverse=True)[1][1:]
    for q in range(1, len(words) // least_repeats + 1):
        same = np.r_[False, ids[q:] == ids[:-q], False].astype(int)
        starts, ends = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for start, length in zip(starts.tolist(), (ends - starts + q).tolist(), strict=True):
            if length >= max(least_length, least_repeats * q):
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def text_with_runs(draw):
    alphabet = draw.choice([1, 2, 2, 3, 5])
    words = [b"%d" % draw.randrange(alphabet) for _ in range(draw.choice([0, 1, 5, 6, 7, 20, 60, 150]))]
    if draw.random() < 0.5 and len(words) > 3:
        unit = words[: draw.randint(1, max(1, len(words) // 5))]
        words = words[:3] + unit * draw.randint(2, 30) + words
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_texts(seed):
    draw = random.Random(seed)
    for _ in range(60):
        texts = [text_with_runs(draw) for _ in range(draw.randint(0, 12))]
        least = draw.choice([(6, 4), (2, 2), (6, 3), (10, 4)])
        runs, left = runs_of_texts(texts, *least)
        for words, found, rest in zip(texts, runs.to_pylist(), left.to_pylist(), strict=True):
            expected = plain_runs(words, *least)
            assert [(r["start"], r["length"], r["period"]) for r in found] == expected
            assert rest == collapsed(words, expected)


def test_grammar_agrees_with_plain_comparison():
    draw = random.Random(3)
    for kinds, size in [(1, 50), (2, 300), (4, 300), (40, 300)]:
        words = [draw.randrange(kinds) for _ in range(size)]
        symbols = np.array([kinds, *words, kinds + 1])
        symbols = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
        pairs = [sorted(draw.sample(range(1, size + 1), 2)) for _ in range(400)]
        x, y = (np.array(side, np.int32) for side in zip(*pairs, strict=True))
        right, left = Grammar(symbols).agree(x, y, 1), Grammar(symbols).agree(x, y, -1)
        for (a, b), to_right, to_left in zip(pairs, right, left, strict=True):
            far = next(k for k in range(size + 2) if symbols[a + k] != symbols[b + k])
            near = next(k for k in range(size + 2) if symbols[a - k] != symbols[b - k])
            assert (to_right, to_left) == (far, near)


def test_grammar_is_small():
    """Levels shrink by a share each, whatever the words are."""
    draw = random.Random(4)
    for words in ([7] * 50_000, [0, 1] * 25_000, [draw.randrange(50) for _ in range(50_000)]):
        symbols = np.unique(np.array([-1, *words, 99]), return_inverse=True)[1].astype(np.int64)
        assert len(Grammar(symbols).symbol) < 8 * len(symbols)


def test_runs_of_odd_rows(spark, odd, empty, clashing):
    found = periodic_runs.periodic_runs(odd, ["doc_id", "text"]).collect()
    assert len(found) == odd.count()
    for row in found:
        words = (row["text"] or "").encode().split()
        runs = [tuple(r) for r in row["runs"]]
        assert runs == plain_runs(words) and row["collapsed"] == collapsed(words, runs)
    assert any(row["runs"] for row in found)
    assert periodic_runs.periodic_runs(empty, ["doc_id"]).count() == 0
    wide = periodic_runs.periodic_runs(clashing, ["doc_id", "text", *CLASHING])
    assert plain(wide.select("doc_id", "text", "runs", "collapsed")) == sorted(map(tuple, found), key=repr)
    assert wide.first()["size"] == "own size"
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(odd, [], least_repeats=1)


def test_runs_do_not_depend_on_groups(spark, odd, monkeypatch):
    texts = [(r[1] or "").encode().split() for r in odd_rows()] + [b"a b c".split() * 5000]
    whole = runs_of_texts(texts, 6, 4)
    monkeypatch.setattr(periodic_runs, "CANDIDATES", 50)
    assert runs_of_texts(texts, 6, 4) == whole
    for text, runs, rest in zip(texts, *whole, strict=True):
        alone = runs_of_texts([text], 6, 4)
        assert (alone[0][0], alone[1][0]) == (runs, rest)


def repeated(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


@given
def test_op11_by_brute_force(spark):
    folder = str(DATA / "sf0.001")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op11_periodic_runs(spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for row in rows:
        words = repeated(row["doc_id"], (texts[row["doc_id"]] or "").encode().split())
        runs = plain_runs(words)
        listed = "".join("%d,%d,%d\n" % run for run in runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        exponent = 1000 * best[1] // best[2] if runs else None
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == exponent
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


# 12: packing


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer(queries.PACKED_TOKENIZER))


def ids_of(library, text, end=0):
    return [*library.encode(text or "", add_special_tokens=False).ids, end]


def check_packed(pieces, documents, capacity):
    """Pieces cover each document once and each sequence without a gap; returns costs."""
    by_document, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        assert 0 < p["length"] == len(p["ids"]) // 4
        by_document[p["doc"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert by_document.keys() == documents.keys()
    for name, ids in documents.items():
        parts = sorted(by_document[name], key=lambda p: p["start"])
        assert [i for p in parts for i in np.frombuffer(p["ids"], "<u4")] == ids
        assert [p["start"] for p in parts] == [0, *np.cumsum([p["length"] for p in parts])[:-1]]
        assert {p["doc_tokens"] for p in parts} == {len(ids)}
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p["offset"])
        size = sum(p["length"] for p in parts)
        assert [p["offset"] for p in parts] == [0, *np.cumsum([p["length"] for p in parts])[:-1]]
        assert size == capacity or size < capacity and size & (size - 1) == 0
    return by_sequence


@pytest.mark.parametrize("capacity, group", [(1024, 1 << 21), (64, 5000), (1, 100)])
def test_pieces_cover_odd_rows(spark, odd, library, capacity, group, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", group)
    some = odd if capacity > 1 else odd.where(F.length("text") < 500)
    named = some.withColumn("doc", F.monotonically_increasing_id()).persist()
    documents = {r["doc"]: ids_of(library, r["text"]) for r in named.collect()}
    pieces = packing.pack(named, library_path(), ["doc", "lang"], capacity).collect()
    check_packed(pieces, documents, capacity)
    again = packing.pack(named, library_path(), ["doc", "lang"], capacity)
    assert plain(again) == sorted(map(tuple, pieces), key=repr)


def library_path():
    return queries.tokenizer(queries.PACKED_TOKENIZER)


def test_packing_of_empty_and_wide_tables(spark, empty, clashing):
    assert packing.pack(empty, library_path(), ["doc_id"]).count() == 0
    wide = packing.pack(clashing, library_path(), ["doc_id", "ids", "size", "__row"])
    assert wide.columns[:3] == ["doc_id", "size", "__row"] and wide.first()["size"] == "own size"
    assert dict(wide.dtypes)["ids"] == "binary"


def test_costs_are_balanced():
    """Full sequences cost about the same; filled one after the other they do not."""
    draw = random.Random(5)
    lengths = [min(400, 1 + int(draw.paretovariate(0.8) * 20)) for _ in range(5000)]
    costs = collections.Counter()
    for document, start, length, sequence, offset in packing.balanced(lengths, 1024, packing.COST):
        costs[sequence] += packing.cost_of(length, packing.COST)
    full = [costs[s] for s in range(sum(lengths) // 1024)]
    plain_costs, room, cost = [], 1024, 0
    for length in lengths:
        while length:
            part = min(length, room)
            cost, room, length = cost + packing.cost_of(part, packing.COST), room - part, length - part
            if not room:
                plain_costs.append(cost)
                room, cost = 1024, 0
    assert np.std(full) < 0.6 * np.std(plain_costs)


def test_longest_first_to_lowest_cost():
    """Without cuts, what the rule says step by step."""
    lengths = [5, 3, 9, 1, 4, 7, 3]
    pieces = list(packing.balanced(lengths, 16, 10))
    cost, room = [0, 0], [16, 16]
    for document in sorted(range(len(lengths)), key=lambda d: -lengths[d]):
        fits = [s for s in range(2) if room[s] >= lengths[document]]
        lowest = min(fits, key=lambda s: (cost[s], s))
        assert pieces.pop(0) == (document, 0, lengths[document], lowest, 16 - room[lowest])
        cost[lowest] += packing.cost_of(lengths[document], 10)
        room[lowest] -= lengths[document]
    assert room == [0, 0] and not pieces


def test_both_libraries_agree(library):
    """On every character between others, on long words and on long white space."""
    with open(library_path(), encoding="utf-8") as file:
        encoder = packing.Encoder(file.read())
    assert encoder.fast
    for code in [*range(0xD800), *range(0xE000, 0x20000)]:
        c = chr(code)
        text = f"a{c}b {c} 1{c}2 {c}{c}x  {c}\n{c}!{c}' {c}'s"
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, hex(code)
    for text in ("x" * 50_000, " " * 200_000 + "a", "<|endoftext|> <|endoftext |>", "?!" * 9000, "a\n\n\n b" * 900):
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_left_to_their_library():
    from tokenizers import Tokenizer

    with open(queries.tokenizer("word_bpe_49k.json"), encoding="utf-8") as file:
        content = file.read()
    encoder = packing.Encoder(content)
    assert encoder.fast is None
    text = "Hello World, it's  1 <|endoftext|>"
    expected = Tokenizer.from_str(content).encode(text, add_special_tokens=False).ids
    assert encoder.encode(text).tolist() == expected


@given
def test_op12_by_the_library(spark, library):
    folder = str(DATA / "sf0.001")
    rows = queries.op12_packing(spark, folder).collect()
    found = collections.defaultdict(list)
    for row in sorted(rows, key=lambda r: r["start"]):
        found[row["doc_id"]].append(row)
    sequences = collections.defaultdict(list)
    for doc in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids, at = np.array(ids_of(library, doc["text"]), "<u4"), 0
        for row in found.pop(doc["doc_id"]):
            part = ids[at : at + row["length"]]
            assert (row["start"], row["doc_tokens"]) == (at, len(ids))
            assert row["ids_crc32"] == zlib.crc32(part.tobytes())
            at += row["length"]
            sequences[row["sequence_id"]].append((row["offset"], row["length"]))
        assert at == len(ids)
    assert not found
    for parts in sequences.values():
        size = sum(length for _, length in parts)
        assert size == 1024 or size & (size - 1) == 0
        assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]]


# 13: spelling variants


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts, times=2):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v.encode()), default=None)
        form[word] = best if best is not None and counts[best] >= times * counts[word] else None

    def root(word):
        while form[word] is not None:
            word = form[word]
        return word

    return {
        (w, n, len(near[w]), form[w], counts[form[w]] if form[w] else None, root(w))
        for w, n in counts.items()
    }


def grouped(spark, rows):
    words = spark.createDataFrame(rows, "word string, n long")
    return {tuple(r) for r in spelling.group_variants(words).collect()}


def test_random_words(spark):
    draw = random.Random(6)
    counts = {}
    for letters, lengths in [("ab", (1, 9)), ("abcdefghij", (3, 7)), ("éß漢😀ax", (1, 6))]:
        for _ in range(250):
            word = "".join(draw.choice(letters) for _ in range(draw.randint(*lengths)))
            counts[word] = draw.choice([1, 2, 3, 5, 8, 20, 90])
    assert grouped(spark, list(counts.items())) == plain_groups(counts)


def test_chains_ties_and_odd_words(spark):
    chain = {"a" * (60 - i): 2**i for i in range(40)}
    found = grouped(spark, list(chain.items()))
    assert found == plain_groups(chain)
    assert {r[-1] for r in found} == {"a" * 21}
    ties = {"xbcde": 9, "abcdx": 9, "abcde": 3, "bcde": 9, "abcd": 2}
    assert grouped(spark, list(ties.items())) == plain_groups(ties)
    odd = [(None, 5), ("", 5), ("word", 1), ("word", 1), ("words", 4), ("w" * 5000, 3), ("w" * 4999, 1)]
    assert grouped(spark, odd) == plain_groups({"word": 2, "words": 4, "w" * 5000: 3, "w" * 4999: 1})
    assert grouped(spark, []) == set()


def test_swapped_letters_are_not_near(spark):
    assert all(r[2] == 0 for r in grouped(spark, [("abcdef", 1), ("abdcef", 9), ("fabcde", 9)]))


def test_words_of_odd_rows(spark, odd, empty, clashing):
    expected = collections.Counter()
    for row in odd_rows():
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1] or "")
        expected.update(w for w in re.findall("[A-Za-zÀ-ÿ]+", lower) if len(w) >= 5)
    expected = {w: n for w, n in expected.items() if n >= 3}
    for docs in (odd, clashing):
        words = spelling.count_words(spelling.letter_runs(docs))
        assert {tuple(r) for r in words.collect()} == set(expected.items())
    assert spelling.count_words(spelling.letter_runs(empty)).count() == 0


@given
def test_op13_by_brute_force(spark):
    folder = str(DATA / "sf0.001")
    counts = collections.Counter()
    for doc in spark.read.parquet(f"{folder}/documents.parquet").collect():
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), doc["text"] or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{doc['doc_id']}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    rows = queries.op13_spelling_variants(spark, folder)
    found = {tuple(r) for r in rows.select("word", "n", "n_near", "form", "form_n", "root").collect()}
    assert found == plain_groups(counts)
