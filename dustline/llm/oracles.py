"""SQL for DuckDB that gives the same rows as the query of the same name."""

from __future__ import annotations

from dustline.llm import quality_rules as rules
from dustline.llm.mixing import MAX_REPEATS, WEIGHTS
from dustline.llm.sharding import DIGITS, SHARDS

#: As a regular expression of DuckDB; white space that parts words, and a word.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

RUNNING = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

MIX = f"""
WITH sized AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
           CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sized GROUP BY source),
weighed AS (
    SELECT *, {MAX_REPEATS} * source_size AS lim,
           CAST([{", ".join(map(str, WEIGHTS))}][1 + (place - 1) % {len(WEIGHTS)}]
                AS DOUBLE) AS weight
    FROM sources),
cuts AS (
    SELECT *, CAST(sum(lim) OVER w - lim AS DOUBLE) AS lims, sum(weight) OVER w - weight AS weights
    FROM weighed WINDOW w AS (ORDER BY lim / weight, source NULLS LAST {RUNNING})),
level AS (
    SELECT max((CAST((SELECT sum(source_size) FROM sources) AS DOUBLE) - lims)
               / ((SELECT sum(weight) FROM weighed) - weights)) AS lev FROM cuts),
targets AS (
    SELECT source, source_size, weight, least(CAST(lim AS DOUBLE), lev * weight) AS target
    FROM weighed, level),
queued AS (
    SELECT s.*, t.source_size, t.weight, t.target,
           sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id {RUNNING}) AS served
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
entries AS (
    SELECT *, CAST(r * source_size + served AS DOUBLE) / weight AS finish
    FROM queued, range({MAX_REPEATS}) AS repeats(r)),
taken AS (
    SELECT *, sum(size) OVER (ORDER BY finish, k, doc_id, r {RUNNING})
              <= (SELECT sum(size) FROM sized) AS fits
    FROM entries WHERE size > 0 OR r = 0)
SELECT doc_id, source, size, source_size, target,
       CAST(sum(CAST(fits AS INT)) AS INT) AS copies,
       CAST(sum(CASE WHEN fits THEN size ELSE 0 END) AS BIGINT) AS taken
FROM taken GROUP BY doc_id, source, size, source_size, target
"""


EXACT_DEDUP = f"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_points,
           sha256(regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, text_sha256,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id)
"""


#: The measures as whole numbers.
VALUES = {
    "symbols": "1000 * n_symbols // word_chars",
    "lines": "1000 * n_dup_lines // n_lines",
    "repeats": "1000 * n_repeat_words // n_words",
    "length": "100 * word_chars // n_words",
}


def _bin(value: str) -> str:
    """The least value of a bin: of large values 2 ** 12 up to 2 ** 13 share a power of two of them."""
    return f"({value}) - ({value}) % (CAST(1 AS BIGINT) << greatest(0, length(ltrim(bin({value}), '0')) - {rules.DIGITS}))"


LEVELS = {"f": ["lang", "source"], "l": ["lang"], "a": []}


def _limits(level: str, measure: str) -> str:
    """Fences of one measure: by what LEVELS names, from exact quantiles of the bins."""
    by = "".join(f"{name}, " for name in LEVELS[level])
    part = f"PARTITION BY {by.rstrip(', ')}" if by else ""
    tolerance = rules.TOLERANCE[measure]
    return f"""{level}_{measure} AS (
        SELECT {by} count(*) AS n,
            min(CASE WHEN 4 * place >= n THEN bin END) AS q1,
            min(CASE WHEN 4 * place >= 3 * n THEN bin END) AS q3,
            greatest({rules.FENCE} * (q3 - q1), {tolerance}) AS fence
        FROM (SELECT {by} {_bin(VALUES[measure])} AS bin, count(*) OVER ({part}) AS n,
                  row_number() OVER ({part} ORDER BY {VALUES[measure]}) AS place
              FROM m WHERE NOT base_failed)
        {"GROUP BY ALL" if by else ""})"""


def _beyond(measure: str) -> str:
    def limit(sign: str, quartile: str) -> str:
        return f"""CASE WHEN f_{measure}.n >= {rules.MIN_DOCS}
                THEN f_{measure}.{quartile} {sign} f_{measure}.fence
            WHEN l_{measure}.n >= {rules.MIN_DOCS}
                THEN l_{measure}.{quartile} {sign} l_{measure}.fence
            ELSE (SELECT {quartile} {sign} fence FROM a_{measure}) END"""

    beyond = f"{VALUES[measure]} > {limit('+', 'q3')}"
    if measure == "length":
        beyond += f" OR {VALUES[measure]} < {limit('-', 'q1')}"
    return f"CASE WHEN {beyond} THEN '{measure}' END"


QUALITY_RULES = f"""
WITH d AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS t,
           regexp_extract_all(t, '{WORD}') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
    FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
triples AS (
    SELECT doc_id, i, word, lead(word) OVER o AS b, lead(word, 2) OVER o AS c
    FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
repeated AS (
    SELECT * FROM triples WHERE c IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY doc_id, word, b, c) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range({rules.WINDOW}) AS r(k)
    GROUP BY doc_id),
c AS (
    SELECT doc_id, lang, source, len(w) AS n_words,
           length(regexp_replace(t, '{SPACE}', '', 'g')) AS word_chars,
           length(t) - length(regexp_replace(t, '{rules.SYMBOLS}', '', 'g')) AS n_symbols,
           len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words
    FROM d LEFT JOIN covered USING (doc_id)),
m AS (
    SELECT *, n_words < {rules.MIN_WORDS}
              OR 100 * n_repeat_words > {rules.MAX_REPEATED} * n_words AS base_failed
    FROM c),
{", ".join(_limits(level, measure) for level in LEVELS for measure in VALUES)},
j AS (
    SELECT m.*, CASE WHEN base_failed THEN '' ELSE concat_ws(',',
        {", ".join(map(_beyond, VALUES))}) END AS failed
    FROM m
    {" ".join(f"LEFT JOIN f_{x} ON m.lang IS NOT DISTINCT FROM f_{x}.lang AND m.source IS NOT DISTINCT FROM f_{x}.source LEFT JOIN l_{x} ON m.lang IS NOT DISTINCT FROM l_{x}.lang" for x in VALUES)})
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
       base_failed, failed, NOT base_failed AND failed = '' AS kept
FROM j
"""


#: Kind, pattern, the group that is measured and its least length, as the base kinds are asked for.
SECRET_KINDS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 0),
]
BASE = ("assign", "access", "hex")


def _spans(place: int) -> str:
    kind, pattern, tested, least = SECRET_KINDS[place]
    pattern = pattern.replace("'", "''")
    return f"""SELECT doc_id, {place} AS place, '{kind}' AS kind, s AS e, s - length(own) AS b
        FROM (
            SELECT doc_id, own, tested, sum(length(gap) + length(own)) OVER (
                       PARTITION BY doc_id ORDER BY i {RUNNING}) AS s
            FROM (
                SELECT doc_id, unnest(owns) AS own, generate_subscripts(owns, 1) AS i,
                       unnest(regexp_extract_all(t, '{pattern}', {tested})) AS tested,
                       unnest(string_split_regex(t, '{pattern}')[:len(owns)]) AS gap
                FROM (SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS owns FROM d)))
        WHERE length(tested) >= {least}"""


BASE_KINDS = ", ".join(f"'{kind}'" for kind in BASE)
SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_spans(place) for place in range(len(SECRET_KINDS)))}),
listed AS (
    SELECT doc_id, string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, place) AS spans,
        string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, place)
            FILTER (WHERE kind IN ({BASE_KINDS})) AS base,
        {", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind in BASE)}
    FROM found GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN listed USING (doc_id)
"""


def _shard(shards: int) -> str:
    """The place of the least draw among so many shards of weight 1."""
    digits = f"substr(md5(k || ':' || s), 1, {DIGITS})"
    draw = f"-ln((CAST('0x' || {digits} AS BIGINT) + 0.5) / {16**DIGITS})"
    draws = f"list_transform(range({shards}), lambda s: {draw})"
    return f"CAST(list_position({draws}, list_min({draws})) - 1 AS INT)"


#: CRC-32 by its polynomial: a table of bytes by eight shifts each, then byte by byte.
SHARDED = f"""
WITH crc AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
               THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT)) ORDER BY i) AS t
    FROM range(256) AS r(i)),
d AS (
    SELECT doc_id, coalesce(text, '') AS x, coalesce(CAST(doc_id AS VARCHAR), '') AS k
    FROM documents),
bytes AS (
    SELECT doc_id, k, octet_length(encode(x)) AS n, list_transform(
               regexp_extract_all(hex(encode(x)), '..'), lambda b: CAST('0x' || b AS BIGINT)) AS b
    FROM d),
placed AS (
    SELECT doc_id, CAST(n + 1 AS BIGINT) AS size,
           xor(list_reduce(b, lambda c, v: xor(c >> 8, t[1 + (xor(c, v) & 255)]), 4294967295),
               4294967295) AS text_crc32,
           'key' AS law, {_shard(SHARDS)} AS shard, {_shard(SHARDS + 1)} AS grown_shard
    FROM bytes, crc)
SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot FROM placed
"""

#: Near words are left the same without the code point at one place, or one is what is left of
#: the other.
SPELLING = """
WITH RECURSIVE crc AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
               THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT)) ORDER BY i) AS t
    FROM range(256) AS r(i)),
runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents)
    GROUP BY doc_id, run),
hashed AS (
    SELECT run, n, length(run) AS len, xor(list_reduce(list_transform(
               regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)), '..'),
               lambda b: CAST('0x' || b AS BIGINT)),
               lambda c, v: xor(c >> 8, t[1 + (xor(c, v) & 255)]), 4294967295), 4294967295) AS h
    FROM runs, crc),
slipped AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % len) || substr(run, h % len + 2) ELSE run END
               AS word, n
    FROM hashed),
words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
left_over AS (
    SELECT word, n, 0 AS i, word AS part FROM words
    UNION ALL SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1)
    FROM words, range(1, length(word) + 1) AS r(i)),
near AS (
    SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m
    FROM left_over a JOIN left_over b USING (part)
    WHERE a.word <> b.word AND (a.i = b.i OR a.i = 0 OR b.i = 0)),
formed AS (
    SELECT word, n, count(other) AS n_near,
           first(other ORDER BY m DESC, encode(other)) AS best, max(m) AS most
    FROM words LEFT JOIN near USING (word, n) GROUP BY word, n),
forms AS (
    SELECT word, n, n_near, CASE WHEN most >= 2 * n THEN best END AS form,
           CASE WHEN most >= 2 * n THEN most END AS form_n
    FROM formed),
chains AS (
    SELECT word, word AS root FROM forms
    UNION ALL SELECT c.word, f.form FROM chains c JOIN forms f ON c.root = f.word
    WHERE f.form IS NOT NULL),
ends AS (
    SELECT c.word, c.root FROM chains c JOIN forms f ON c.root = f.word WHERE f.form IS NULL)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN ends USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": MIX,
        "op2_exact_dedup": EXACT_DEDUP,
        "op4_quality_rules": QUALITY_RULES,
        "op6_secret_scan": SECRETS,
        "op8_rendezvous_shards": SHARDED,
        "op13_spelling_variants": SPELLING,
    }
