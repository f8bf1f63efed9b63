"""Names of tables, columns and files. Works on schemas and paths, never on data."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Sequence

# What counts as a word in column and in table names, and how a
# column without a header cell is called.
COLUMN_JUNK = re.compile(r"\W+")
TABLE_JUNK = re.compile(r"[^a-zA-Z0-9_]")
NAMELESS = "Unnamed: {}"


def unique_header(cells: Sequence[str | None]) -> list[str]:
    """Header names of a sheet: nameless cells are numbered, repeats get ``.1``, ``.2``.

    A name that is spelled out in the header keeps its spelling; suffixes skip names
    that are already taken.
    """
    wanted = [cell or NAMELESS.format(i) for i, cell in enumerate(cells)]
    taken = set(wanted)
    used: set[str] = set()
    result = list(wanted)
    spelled_first = sorted(range(len(cells)), key=lambda i: not cells[i])
    for i in spelled_first:
        name, repeat = wanted[i], 0
        while name in used or (repeat and name in taken):
            repeat += 1
            name = f"{wanted[i]}.{repeat}"
        taken.add(name)
        used.add(name)
        result[i] = name
    return result


def column_names(header: Sequence[str | None]) -> list[str]:
    """Clean column names; raises when two of them would be one column to Spark."""
    names = [COLUMN_JUNK.sub("_", name) for name in unique_header(header)]
    clash = first_clash(names)
    if clash is not None:
        raise ValueError(f"columns collide after cleaning: {clash}")
    return names


def table_name(file_name: str) -> str:
    """Table name for a file: last extension dropped, odd characters replaced."""
    stem = os.path.splitext(os.path.basename(file_name))[0]
    name = TABLE_JUNK.sub("_", stem)
    return "_" + name if name[:1].isdigit() else name


def first_clash(names: Iterable[str]) -> str | None:
    """A name that occurs twice when case is ignored, as Spark's catalog does."""
    seen: set[str] = set()
    for name in names:
        if name.lower() in seen:
            return name
        seen.add(name.lower())
    return None


def quoted(*parts: str) -> str:
    """``a.b.c`` with every part in backticks."""
    return ".".join("`{}`".format(part.replace("`", "``")) for part in parts if part)
