"""BPE encoding and decoding by a deterministic automaton over tokens.

The automaton reads tokens and accepts exactly the sequences that the merges leave of some
word. It is built merge by merge. At first a state follows every token, and every token may
come next. The gadget of merge number k, u and v to w, changes the state that follows u into a
version without the arc v, as u before v is merged from now on; it gives an arc w to
every state that has an arc u at that time, leading to the state that then follows v. States
are kept as the versions they are made of: a token's own, and that of its last part as it was
at the token's merge. An arc is there if no version had lost it, or the first part it
came from, by then. Answers fill a table of transitions.

A word has one path through the automaton, and so has each beginning of it. Encoding walks
the word once: the tokens that start at a place are followed in a trie, and an arc that the
table allows settles the token that ends at its end. Decoding emits the labels of the arcs.

Texts are split into words before. A null text is empty and has no tokens. Special tokens
in a text become their ids. A text is worked on in stretches that end at white space, so that
long ones are not held as lists of words. Equal rows are encoded alike, an empty table
gives an empty result. Columns of the input with the operator's names are replaced.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEVER = 1 << 62
END = "</w>"
#: Entries of a table of words or transitions before it is begun anew, code points of a text
#: worked on at once, and rows handed on at once.
TABLE = 400_000
STRETCH = 1 << 20
ROWS = 256

#: White space and words of the tokenizer, for texts in lower case.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PARTS = "'s|'t|'re|'ve|'m|'ll|'d"
ANY_WORD = rf"{PARTS}|\p{{L}}+|\p{{N}}|[^{BLANK}\p{{L}}\p{{N}}]+"
ASCII_WORD = rf"{PARTS}|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it can be printed, else the next
    free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {byte: chr(byte) for byte in shown}
    hidden = [byte for byte in range(256) if byte not in symbols]
    symbols |= {byte: chr(256 + place) for place, byte in enumerate(hidden)}
    return [symbols[byte] for byte in range(256)]


class Automaton:
    """The automaton of a vocabulary and its merges, and the table of its transitions."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]) -> None:
        self.symbols = byte_symbols()
        self.lost: dict[int, int] = {}
        made = {one + two for one, two in merges}
        ids = {id_ for token, id_ in vocabulary.items() if token not in made}
        # For the state after a token: the versions it is made of, with the time of each; for
        # the arc of a token: the tokens whose arcs it came from, with the time of each.
        self.versions = {id_: [(id_, NEVER)] for id_ in ids}
        self.origins = {id_: [(id_, NEVER)] for id_ in ids}
        for time, (one, two) in enumerate(merges):
            self._add_gadget(vocabulary[one], vocabulary[two], vocabulary[one + two], time)
        self.trie: dict[str, Any] = {}
        for token, id_ in vocabulary.items():
            node = self.trie
            for symbol in self._split(token):
                node = node.setdefault(symbol, {})
            node[""] = id_
        self.table: dict[int, bool] = {}

    @staticmethod
    def _split(token: str) -> list[str]:
        if token.endswith(END) and len(token) > len(END):
            token = token[: -len(END)]
            return [*token[:-1], token[-1] + END]
        return list(token)

    def _add_gadget(self, one: int, two: int, both: int, time: int) -> None:
        if one not in self.versions or two not in self.versions or both in self.versions:
            raise ValueError(f"merge {time} uses a token that is not made before, or makes one twice")
        self.lost[one << 20 | two] = time
        (_, _), *rest = self.versions[two]
        self.versions[both] = [(both, NEVER), (two, time), *rest]
        (_, _), *rest = self.origins[one]
        self.origins[both] = [(both, NEVER), (one, time), *rest]

    def follows(self, one: int, two: int) -> bool:
        """Whether the state after token ``one`` has an arc ``two``."""
        for version, until in self.versions[one]:
            for origin, at in self.origins[two]:
                time = self.lost.get(version << 20 | origin)
                if time is not None and time < until and time <= at:
                    return False
        return True

    def encode_word(self, word: str) -> list[int]:
        symbols = [self.symbols[byte] for byte in word.encode()]
        symbols[-1] += END
        size, table = len(symbols), self.table
        if len(table) > TABLE:
            table.clear()
        token, start = [-1] * (size + 1), [0] * (size + 1)
        for place in range(size):
            before = token[place]
            if place and before < 0:
                continue
            node, end = self.trie, place
            while end < size:
                node = node.get(symbols[end])
                if node is None:
                    break
                end += 1
                found = node.get("")
                if found is None or token[end] >= 0:
                    continue
                if place:
                    key = before << 20 | found
                    if (allowed := table.get(key)) is None:
                        allowed = table[key] = self.follows(before, found)
                    if not allowed:
                        continue
                token[end], start[end] = found, place
        ids, end = [], size
        while end:
            ids.append(token[end])
            end = start[end]
        return ids[::-1]


class Words(dict):
    """Words and their ids as bytes; filled as words are met."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, word: str) -> bytes:
        if len(self) > TABLE:
            self.clear()
        ids = np.array(self.automaton.encode_word(word), "<u4").tobytes()
        if len(word) < 64:
            self[word] = ids
        return ids


class Coder:
    """Encodes and decodes texts; ids are 32-bit little-endian numbers, one after the other."""

    def __init__(self, vocabulary: dict, merges: list, special: dict[str, int]) -> None:
        self.words = Words(Automaton(vocabulary, merges))
        self.special = {token: np.array([i], "<u4").tobytes() for token, i in special.items()}
        self.specials = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.any_word = regex.compile(ANY_WORD)
        self.ascii_word = re.compile(ASCII_WORD)
        self.blank = regex.compile(f"[{BLANK}]")
        self.labels = {i: t.encode() for t, i in (vocabulary | special).items()}

    def _stretches(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > STRETCH:
            cut = self.blank.search(text, start + STRETCH)
            if not cut:
                break
            yield text[start : cut.start()]
            start = cut.end()
        yield text[start:] if start else text

    def _encode(self, text: str) -> Iterator[bytes]:
        for part in self._stretches(text):
            if part.isascii():
                words = self.ascii_word.findall(part.lower())
            else:
                # Each character on its own: a sigma at the end of a word is like any other.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                words = self.any_word.findall(part)
            yield b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str) -> bytes:
        parts = self.specials.split(text) if any(t in text for t in self.special) else [text]
        found = []
        for place, part in enumerate(parts):
            if place % 2:
                found.append(self.special[part])
            else:
                found += self._encode(part)
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        labels = map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist())
        return b" ".join(labels).decode()


# How the tokenizers that are built in here change and part a text, in their file.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def differences(parsed: dict) -> list[str]:
    """What a tokenizer file asks for that is not built in here; nothing of it would be heard."""
    model = parsed["model"]
    found = [
        name
        for name, built_in in (("normalizer", NORMALIZER), ("pre_tokenizer", PRE_TOKENIZER), ("decoder", None))
        if parsed.get(name) != built_in
    ]
    if model.get("type") != "BPE" or model.get("end_of_word_suffix") != END:
        found.append("model")
    for name in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"):
        if model.get(name):
            found.append(name)
    for token in parsed["added_tokens"]:
        if not token["special"] or any(token[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            found.append(f"added token {token['content']}")
    return found


def read_tokenizer(path: str) -> dict:
    """What a tokenizer file says of a BPE with word ends, of the kind that is built in here; any
    other is an error."""
    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    if found := differences(parsed):
        raise ValueError(f"{path} has another {', '.join(found)}")
    model = parsed["model"]
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
    return {"vocabulary": model["vocab"], "merges": merges, "special": special}


def coder_of(tables: dict) -> Coder:
    """The coder of tables that were sent to a worker, which keeps it for its later tasks."""
    if "coder" not in tables:
        tables["coder"] = Coder(tables["vocabulary"], tables["merges"], tables["special"])
    return tables["coder"]


def coding_batches(tables, kept: list[str], outputs: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(tables.value)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                ids = [coder.encode(t.as_py() or "") for t in batch.column(len(kept))]
                made = {"n_tokens": lambda: pa.array([len(i) // 4 for i in ids], pa.int64())}
                made["ids"] = lambda: pa.array(ids, pa.binary())
                made["decoded"] = lambda: pa.array([coder.decode(i) for i in ids], pa.string())
                columns = [*batch.columns[:-1], *(made[name]() for name in outputs)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *outputs])

    return run


OUTPUTS = {"n_tokens": "long", "ids": "binary", "decoded": "string"}


def transcode(
    docs: DataFrame, tokenizer: str, kept: list[str], outputs: tuple[str, ...] = tuple(OUTPUTS)
) -> DataFrame:
    """The columns ``kept`` of ``docs``, and of each text: ``n_tokens``, ``ids`` (32-bit
    little-endian numbers) and ``decoded``, the text that decoding these ids gives.

    The tokenizer's file is read by the driver; its tables, a few MB, go to the workers once.
    """
    spark = docs.sparkSession
    tables = spark.sparkContext.broadcast(read_tokenizer(tokenizer))
    kept = [name for name in kept if name not in outputs]
    rows = docs.select(*[F.col(f"`{name}`") for name in kept], F.col("text").alias("__text"))
    schema = StructType(rows.schema.fields[:-1])
    for name in outputs:
        schema = schema.add(name, OUTPUTS[name])
    return rows.mapInArrow(coding_batches(tables, kept, list(outputs)), schema)


def decode_ids(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` with ``decoded``: the text of its column ``ids``."""
    tables = encoded.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(tables.value)
        for batch in batches:
            texts = [coder.decode(i.as_py() or b"") for i in batch.column("ids")]
            names = [name for name in batch.schema.names if name != "decoded"]
            columns = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string())], names=[*names, "decoded"]
            )

    rows = encoded.drop("decoded")
    return rows.mapInArrow(run, StructType([*rows.schema.fields]).add("decoded", "string"))
