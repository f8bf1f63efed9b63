"""Odd documents, and helpers of the tests."""

import random

#: Names that operators use for columns of their own.
CLASHING = ["size", "__row", "__doc", "shard", "kept", "ids", "fingerprint", "a", "b", "target"]

WORDS = "the of and tion ing her that with from ent was are this by for".split()


def sentence(seed, n):
    """Words that differ enough for a text to pass the quality rules."""
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(WORDS) * draw.randint(0, 1) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, white space, Unicode."""
    long = sentence(5, 30_000)
    rows = [
        (1, sentence(1, 60), "en", "s0", 1),
        (2, sentence(1, 60).replace(" ", "\n"), "en", "s0", 2),
        (3, sentence(1, 60) + " ", "en", "s1", 3),
        (4, "", "en", "s0", 0),
        (5, None, "en", None, None),
        (None, sentence(2, 80), "de", "s0", 4),
        (None, sentence(2, 80), "de", "s0", 4),
        (None, None, None, None, None),
        (6, long, "fr", "s2", 9),
        (7, long[:-1] + "9", "fr", "s2", 9),
        (8, "one two", None, "s3", 7),
        (8, "one two", None, "s3", 7),
        (9, " \t\n\x0b\x0c\r ", "es", "s4", 7),
        (10, "Ünï 漢字 😀 \x85 \xa0   é 'tis don't <|endoftext|> İΣ", "fr", "é", 7),
        (11, "x" * 100_000, "en", "s5", 7),
        (12, 'password = "hunter22"  api-key token: abcdef AKIA' + "A1" * 10 + " " + "0f" * 20, "en", "s0", 1),
        (13, "a a a a\na a a a\n\n#*$%&|<> a", "en", "s0", 1),
        (14, "SPAM! " * 200, "en", "s0", 1),
        (15, sentence(3, 70) + "\n" + sentence(4, 70), "en", "s0", 1),
    ]
    rows += [(100 + i, sentence(9, 55), "en", "s0", 1) for i in range(40)]
    rows += [(200 + i, sentence(i + 11, 50 + i % 7), ["en", "de"][i % 2], f"s{i % 4}", i) for i in range(80)]
    return rows


def plain(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
