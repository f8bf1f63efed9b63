"""Operators against plain versions in Python, on odd rows."""

import collections
import hashlib
import itertools
import re
import zlib

import pytest
import xxhash
from samples import CLASHING, odd_rows, plain
from pyspark.sql import functions as F

from dustline.llm import (
    exact_dedup,
    mixing,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
)
from dustline.llm.common import ROW, numbered, running_total

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def wide(found, docs):
    """The rows that an operator hands on are rows of the input with all their columns."""
    given = collections.Counter(plain(docs))
    return found.columns == docs.columns and all(row in given for row in plain(found))


# Running totals


def test_running_total_spans_all_ranges(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("v")).repartition(5)
    found = running_total(df, [F.col("id").desc()], "v", "total", "t", 1000).orderBy(F.desc("id"))
    totals = list(itertools.accumulate(i % 7 for i in range(999, -1, -1)))
    assert [r["total"] for r in found.collect()] == totals
    assert running_total(df.limit(0), [F.col("id")], "v", "total", "t", 1000).count() == 0


# 1: mixing


def mixed(df):
    size = mixing.word_count(F.col("text")).alias("size")
    return mixing.mix_plan(numbered(df.select("doc_id", "source", size), "t"))


def water_filled(sizes):
    """Targets by raising one level step by step."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * sizes[s] <= level * weight[s]}
        for s in full or open_:
            target[s] = 3 * sizes[s] if full else level * weight[s]
        left -= sum(3 * sizes[s] for s in full)
        open_ = open_ - full if full else set()
    return target


def test_mix_meets_targets(odd):
    rows = mixed(odd).collect()
    sizes = collections.Counter()
    for _, text, _, source, _ in odd_rows():
        sizes[source] += len(words(text))
    target, taken = water_filled(sizes), collections.Counter()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = max(r["size"] for r in rows)
    assert sum(sizes.values()) - largest < sum(taken.values()) <= sum(sizes.values())
    for source, n in target.items():
        own = max(r["size"] for r in rows if r["source"] == source)
        assert abs(taken[source] - n) <= max(own, largest), source
    columns = ["doc_id", "source", "size", "target", "taken"]
    again = mixed(odd.repartition(7)).select(columns)
    assert plain(again) == plain(mixed(odd).select(columns))


def test_mix_documents(odd, clashing, empty):
    found = mixing.mix(clashing)
    assert wide(found, clashing)
    copies = collections.Counter((r["doc_id"], r["source"]) for r in mixed(odd).collect() for _ in range(r["copies"]))
    assert collections.Counter((r["doc_id"], r["source"]) for r in found.collect()) == copies
    assert mixed(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mix_of_texts_without_words(odd):
    bare = odd.where("text is null or text = ''")
    assert {(r["size"], r["taken"]) for r in mixed(bare).collect()} == {(0, 0)}


# 2: exact copies


def test_exact_copies(odd):
    groups = collections.defaultdict(list)
    for row in odd_rows():
        groups[SPACE.sub("", row[1] or "")].append(row)
    expected = []
    for text, rows in groups.items():
        best = max(len(r[1] or "") for r in rows)
        ids = [r[0] for r in rows if len(r[1] or "") == best]
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected += [(r[0], keep, len(rows), digest) for r in rows]
    found = exact_dedup.find_copies(odd)
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    assert plain(found.select(columns)) == sorted(expected, key=repr)
    kept = found.where("kept")
    assert kept.count() == len(groups) == kept.select("text_sha256").distinct().count()
    assert kept.where("not doc_id <=> keep_id").count() == 0


def test_exact_deduplicate(clashing, empty, odd):
    found = exact_dedup.deduplicate(clashing)
    assert wide(found, clashing)
    assert found.count() == exact_dedup.find_copies(odd).where("kept").count()
    assert plain(exact_dedup.find_copies(clashing)) and exact_dedup.deduplicate(empty).count() == 0
    assert exact_dedup.find_copies(empty).count() == 0


def test_shared_fingerprints_part_by_bytes(odd, monkeypatch):
    """With all fingerprints alike the comparison of bytes gives the same groups."""
    expected = plain(exact_dedup.find_copies(odd))
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    assert plain(exact_dedup.find_copies(odd)) == expected


@pytest.mark.parametrize("bits", [0, 1, 5, 12])
def test_filters_merge_without_loss(bits):
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    draws = np.random.default_rng(3)
    values = draws.integers(-(2**63), 2**63 - 1, 300, dtype=np.int64)
    values = draws.choice(values, 2000)
    parts = [pa.RecordBatch.from_arrays([pa.array(x)], ["f"]) for x in np.array_split(values, 7)]
    runs = [
        dict(zip(["quotient", "remainders", "counts"], run, strict=True))
        for part in parts
        for batch in exact_dedup.build_filters(bits)([part])
        for run in zip(*(c.to_pylist() for c in batch.columns), strict=True)
    ]
    merged = pd.concat(
        exact_dedup.merge_runs(bits)(g) for _, g in pd.DataFrame(runs).groupby("quotient")
    )
    counts = {v: n for v, n in collections.Counter(values.tolist()).items() if n > 1}
    assert dict(zip(merged["fingerprint"], merged["rows"], strict=True)) == counts


# 5: near copies


def simhash_of(text):
    tokens = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode()) if w]
    tokens = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), t) for t in tokens]
    if not tokens:
        return 0
    shingles = [b" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, radius):
    """The class of each value by comparing all pairs."""
    group = list(range(len(values)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in itertools.combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= radius:
            one, two = sorted((top(i), top(j)))
            group[two] = one
    return [top(i) for i in range(len(values))]


def test_near_copies(odd):
    rows = odd_rows()
    values = [simhash_of(r[1]) for r in rows]
    top = classes(values, 2)
    members = collections.defaultdict(list)
    for i, t in enumerate(top):
        members[t] += [rows[i][0]] if rows[i][0] is not None else []
    expected = [
        (r[0], f"{values[i]:016x}", min(members[top[i]], default=None)) for i, r in enumerate(rows)
    ]
    assert plain(simhash.find_near_copies(odd)) == sorted(expected, key=repr)


def test_near_deduplicate(clashing, odd, empty):
    found = simhash.deduplicate(clashing)
    assert wide(found, clashing)
    top = classes([simhash_of(r[1]) for r in odd_rows()], 2)
    assert found.count() == len(set(top))
    assert simhash.find_near_copies(empty).count() == 0 == simhash.deduplicate(empty).count()


def test_links_of_dense_shards(spark):
    """Fingerprints that share most bits go through all finer shards and lose no link."""
    import random

    draw = random.Random(4)
    base = [draw.getrandbits(64) for _ in range(3)]
    values = {0, 1 << 63, (1 << 64) - 1, *base}
    while len(values) < 1500:
        flips = draw.sample(range(64) if len(values) % 3 else range(12), draw.randint(1, 6))
        values.add(draw.choice(base) ^ sum(1 << b for b in flips))
    values = sorted(values)
    signed = [(simhash._signed(v),) for v in values]
    distinct = spark.createDataFrame(signed, "fingerprint long")
    joined = simhash.stars(simhash.links(distinct, shard=256)).collect()
    least = {r["b"]: r["a"] for r in joined}
    groups = collections.defaultdict(set)
    for (v,) in signed:
        groups[least.get(v, v)].add(v)
    expected = collections.defaultdict(set)
    for i, t in enumerate(classes(values, 2)):
        expected[t].add(signed[i][0])
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))
    assert len(groups) < 1400


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_tree_finds_all_near(radius):
    import random

    draw = random.Random(radius)
    values = list({draw.getrandbits(64) & 0xFFF0F for _ in range(400)})
    tree = simhash.BKTree()
    for value in values:
        tree.add(value)
    for value in [*values[:50], 0, 5]:
        near = sorted(v for v in values if (v ^ value).bit_count() <= radius)
        assert sorted(tree.values[i] for i in tree.near(value, radius)) == near


def test_stars_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = simhash.stars(edges)
    assert sorted(tuple(r) for r in found.collect()) == [(0, i) for i in range(1, 301)]


# 4: quality rules


def counted(text):
    text = text or ""
    tokens = words(text)
    triples = collections.Counter(zip(tokens, tokens[1:], tokens[2:], strict=False))
    covered = {
        i + k
        for i in range(len(tokens) - 2)
        if triples[tuple(tokens[i : i + 3])] > 1
        for k in range(3)
    }
    lines = [line for line in text.split("\n") if words(line)]
    return (
        len(tokens),
        sum(map(len, tokens)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
    )


def limits(rows, by):
    """Fences from exact quartiles of the bins, by a key."""
    groups = collections.defaultdict(lambda: collections.defaultdict(list))
    for key, bins in rows:
        for name, value in bins.items():
            groups[by(key)][name].append(value)
    found = {}
    for key, measures in groups.items():
        for name, values in measures.items():
            values.sort()
            n = len(values)
            q1, q3 = values[-(-n // 4) - 1], values[-(-3 * n // 4) - 1]
            fence = max(quality_rules.FENCE * (q3 - q1), quality_rules.TOLERANCE[name])
            found[key, name] = (n, q1 - fence, q3 + fence)
    return found


@pytest.mark.parametrize("min_docs", [1, 10, 100])
def test_quality_rules(odd, min_docs):
    rows, measures = odd_rows(), []
    for r in rows:
        n, chars, symbols, lines, dup, repeated = counted(r[1])
        failed = n < 50 or 100 * repeated > 50 * n
        bins = failed or {
            "symbols": 1000 * symbols // chars,
            "lines": 1000 * dup // lines,
            "repeats": 1000 * repeated // n,
            "length": min(6400, 100 * chars // n),
        }
        measures.append((r, counted(r[1]), failed, bins))
    good = [((r[2], r[3]), bins) for r, _, failed, bins in measures if not failed]
    fine = limits(good, lambda k: k)
    coarse = limits(good, lambda k: k[0])
    every = limits(good, lambda k: None)
    expected = []
    for r, counts, failed, bins in measures:
        beyond = []
        for name, value in () if failed else bins.items():
            options = [fine[(r[2], r[3]), name], coarse[r[2], name], every[None, name]]
            options[:2] = [x for x in options[:2] if x[0] >= min_docs]
            _, low, high = options[0]
            if value > high or name == "length" and value < low:
                beyond.append(name)
        expected.append((r[0], *counts, failed, beyond, not failed and not beyond))
    assert plain(quality_rules.judge(odd, min_docs)) == sorted(expected, key=repr)


def test_long_words_have_fences_too(spark):
    """Means from 64 code points on are told apart, in sketches and against the fences."""
    means = {"dense": [2000 + i % 40 for i in range(120)], "short": [5 + i % 2 * 15 for i in range(120)]}
    means["alike"] = [10_001] * 120
    odd_ones = {"dense": [3000, 5000, 300], "short": [64, 66, 5000], "alike": [10_002, 10_010, 9_990]}
    rows = [
        (1000 * g + i, "".join(chr(0x4E00 + (17 * i + 7 * k) % 19000) * mean + " " for k in range(50)), "zh", source)
        for g, source in enumerate(means)
        for i, mean in enumerate(means[source] + odd_ones[source])
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    failed = {r["doc_id"]: r["failed"] for r in quality_rules.judge(docs.repartition(8)).collect()}
    # Fences by hand: dense about 2010 - 60 and 2029 + 60, short 20 + 45, alike its bin from
    # 10,000.64 to 10,001.91 and three times that width on either side.
    beyond = {120, 121, 122, 1121, 1122, 2121, 2122}
    assert {i for i, f in failed.items() if f == ["length"]} == beyond
    assert all(f == [] for i, f in failed.items() if i not in beyond)


def test_bins_of_large_values(spark):
    values = [0, 1, 6399, 6400, 8191, 8192, 8193, 16_383, 16_384, 16_387, 10**9, 2**40 + 5]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    for r in rows.select("v", quality_rules.width(F.col("v")).alias("w")).collect():
        v, w = r
        assert w == max(1, 2 ** (v.bit_length() - quality_rules.DIGITS)) and w <= max(1, v / 4096)


def test_quality_keep(clashing, odd, empty):
    found = quality_rules.keep(clashing)
    assert wide(found, clashing)
    assert found.count() == quality_rules.judge(odd).where("kept").count() > 100
    assert quality_rules.judge(empty).count() == 0 == quality_rules.keep(empty).count()
    none = odd.where("text is null")
    assert {r["kept"] for r in quality_rules.judge(none).collect()} == {False}


def test_sketches_merge_in_any_order(odd):
    rows = quality_rules.measured(odd, ["lang", "source"]).persist()
    halves = [quality_rules.sketches(rows.where(f"hash(source, lang) % 2 {op} 0")) for op in ("=", "<>")]
    whole = quality_rules.merged(quality_rules.sketches(rows), ["lang"])
    assert plain(quality_rules.merged(halves[1].union(halves[0]), ["lang"])) == plain(whole)


# 6: secrets


#: As they are asked for, apart from the operator's own.
KINDS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 0),
]


def secrets_in(text):
    found = []
    for place, (kind, pattern, tested, least) in enumerate(KINDS):
        for m in re.finditer(pattern, text or ""):
            if len(m[tested]) >= least:
                found.append((m.start(), place, kind, m.end()))
    return sorted(found)


SAMPLES = [
    "secret:token:abcdefg",
    "token=tok secret = 'abc123' ApI_KeY:\"zzzzzz\" apikey=12345",
    "AKIA" + "B" * 15 + " AKIAAKIA" + "C" * 12 + " xAKIA" + "9" * 16 + "z",
    "0" * 23 + " " + "a" * 24 + "g" + "F" * 30 + "f" * 24,
    "😀é token: " + "0123456789abcdef" * 3 + "😀 password=é password = abcdef",
    "-----BEGIN RSA PRIVATE KEY-----\n eyJhbGci.eyJzdWI.sig_-x eyJ.eyJ.x",
]


def test_secrets(odd, empty, clashing, spark):
    more = spark.createDataFrame(list(enumerate(SAMPLES, 1000)), "doc_id long, text string")
    docs = odd.unionByName(more, allowMissingColumns=True)
    rows = [(r[0], r[1]) for r in odd_rows()] + list(enumerate(SAMPLES, 1000))
    expected = [(i, [tuple(f) for f in secrets_in(text)]) for i, text in rows]
    found = secret_scan.find_secrets(docs).collect()
    got = [(r["doc_id"], [tuple(f) for f in r["findings"]]) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert secret_scan.find_secrets(empty).count() == 0
    assert secret_scan.find_secrets(clashing).count() == len(odd_rows())


def test_ledger_scans_only_what_it_has_not_seen(odd, spark):
    ledger = secret_scan.Ledger(spark)
    old = [secret_scan.RULES[0], secret_scan.RULES[2]]
    secret_scan.find_secrets(odd.where("doc_id < 100"), ledger, old)
    blobs = len({r[1] or "" for r in odd_rows() if r[0] is not None and r[0] < 100})
    assert ledger.pairs().count() == 2 * blobs
    before = set(map(tuple, ledger.pairs().collect()))
    # One rule has a new version, one stays, one is new; rows of old and of new blobs.
    new = secret_scan.Rule("hex", 2, r"[0-9a-f]{32,}")
    rules = [secret_scan.RULES[0], new, secret_scan.RULES[1]]
    found = secret_scan.find_secrets(odd, ledger, rules).collect()
    pairs = list(map(tuple, ledger.pairs().collect()))
    assert len(pairs) == len(set(pairs)) and before < set(pairs)
    due = {(hashlib.sha256((r[1] or "").encode()).hexdigest(), rule.name) for r in odd_rows() for rule in rules}
    assert set(pairs) == before | due
    kinds = {f["kind"] for r in found for f in r["findings"]}
    assert kinds == {"assign", "access", "hex"}
    count = ledger.findings().count()
    secret_scan.find_secrets(odd, ledger, rules)
    assert ledger.findings().count() == count and ledger.pairs().count() == len(pairs)


# 8: shards


def test_shards(odd, clashing, empty):
    weights = [1.0] * 16
    rows = sharding.assign(odd, weights).collect()
    texts = collections.Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_rows()
    )
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == texts
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16) and r["law"] == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_key = {}
    for r in rows:
        assert by_key.setdefault(r["doc_id"], r["shard"]) == r["shard"]
    assert sharding.assign(empty, weights).count() == 0
    replaced = sharding.with_shards(clashing, weights)
    assert replaced.columns.count("shard") == 1 and dict(replaced.dtypes)["shard"] == "int"
    assert set(CLASHING) <= set(replaced.columns)


def test_weights_and_growth_move_few(spark):
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"))
    shard = sharding.shard_of(F.col("doc_id"), [1.0, 2.0, 1.0]).alias("s")
    grown = sharding.shard_of(F.col("doc_id"), [1.0, 2.0, 1.0, 1.0]).alias("g")
    rows = keys.select(shard, grown).collect()
    counts = collections.Counter(r["s"] for r in rows)
    assert counts[1] == pytest.approx(10_000, rel=0.05)
    moved = [r for r in rows if r["s"] != r["g"]]
    assert {r["g"] for r in moved} == {3} and len(moved) == pytest.approx(4000, rel=0.1)


def test_written_shards(odd, spark, tmp_path):
    path = f"file://{tmp_path}/shards"
    sharding.write_shards(odd, [1.0, 1.0], path)
    assert spark.read.parquet(path).count() == len(odd_rows())
    assert ROW not in spark.read.parquet(path).columns


# Ids of any type, and what a second run need not do


def test_ids_may_be_text(spark, odd):
    """Each operator gives the rows of numeric ids under their text, as far as order agrees."""
    named = odd.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 5, "0")))
    name = lambda i: None if i is None else f"d{i:05d}"
    near = simhash.find_near_copies(named.where("doc_id is not null")).collect()
    numeric = simhash.find_near_copies(odd.where("doc_id is not null")).collect()
    expected = collections.Counter((name(r["doc_id"]), name(r["component_id"])) for r in numeric)
    assert collections.Counter((r["doc_id"], r["component_id"]) for r in near) == expected
    copies = exact_dedup.find_copies(named).where("doc_id is not null")
    other = exact_dedup.find_copies(odd).where("doc_id is not null").collect()
    expected = collections.Counter((name(r["doc_id"]), name(r["keep_id"])) for r in other)
    assert collections.Counter((r["doc_id"], r["keep_id"]) for r in copies.collect()) == expected
    n = odd.count()
    assert mixed(named).count() == n
    assert quality_rules.judge(named).count() == n
    assert secret_scan.find_secrets(named).count() == n
    assert sharding.assign(named, [1.0] * 4).count() == n
    assert simhash.deduplicate(named).schema["doc_id"].dataType.simpleString() == "string"


def test_known_blobs_are_not_read_again(spark, odd, monkeypatch):
    ledger = secret_scan.Ledger(spark)
    blobs = odd.select(secret_scan.blob_of(F.col("text"))).distinct().count()
    assert secret_scan.scan(odd, ledger) == blobs
    before = plain(ledger.findings())
    assert secret_scan.scan(odd, ledger) == 0
    labels = []
    usual = secret_scan.staged
    monkeypatch.setattr(secret_scan, "staged", lambda df, label: labels.append(label) or usual(df, label))
    found = plain(secret_scan.find_secrets(odd, ledger))
    assert "secret-scans" not in labels
    assert found == plain(secret_scan.find_secrets(odd)) and plain(ledger.findings()) == before
    more = odd.union(odd.limit(1).withColumn("text", F.lit("token = abcdefgh")))
    assert secret_scan.scan(more, ledger) == 1
    changed = [secret_scan.Rule("hex", 2, r"[0-9a-f]{30,}")]
    assert secret_scan.scan(odd.where("text is not null"), ledger, changed) > 1


def test_few_due_blobs_meet_texts_where_they_are_read(spark, odd, monkeypatch):
    """Sent or not, the ledger and the findings are the same."""
    half = odd.where("doc_id > 210")
    results = []
    for sent in (0, secret_scan.SENT):
        monkeypatch.setattr(secret_scan, "SENT", sent)
        ledger = secret_scan.Ledger(spark)
        secret_scan.scan(odd.where("doc_id <= 210"), ledger)
        results.append((plain(secret_scan.find_secrets(half, ledger)), plain(ledger.pairs())))
    assert results[0] == results[1]
