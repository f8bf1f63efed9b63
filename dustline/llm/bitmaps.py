"""A set of 64-bit hashes as a bitmap of bounded size, for leaving out most of what is not in it."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bits for each hash, up to 64 MB in all. Beyond some 8 million hashes more of what is not in the
#: set passes, a half at 500 million, and all of it in the end; what is in the set always does.
BITS_EACH = 64
MOST_BITS = 29
#: Bits of a block, the part of the bitmap that one task makes: 64 kB.
BLOCK_BITS = 19


def may_contain(hashes: DataFrame, rows: int) -> Callable[[Column], Column]:
    """A test of hashes for the only column of ``hashes``, which has ``rows`` rows at most.

    It is true for all that are there, and for few others. The bitmap is made in blocks by tasks;
    its bytes, 64 MB at most, go through the driver to the workers.
    """
    bits = min(MOST_BITS, max(BLOCK_BITS, (BITS_EACH * rows).bit_length()))
    shift = 64 - bits

    def block(some: pd.DataFrame) -> pd.DataFrame:
        place = some["hash"].to_numpy().view(np.uint64) >> np.uint64(shift)
        inside = (place & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
        flags = np.zeros(1 << BLOCK_BITS, bool)
        flags[inside] = True
        packed = np.packbits(flags, bitorder="little").tobytes()
        return pd.DataFrame({"block": some["block"].iloc[:1], "bits": [packed]})

    value = F.col(hashes.columns[0])
    blocks = F.shiftrightunsigned(value, shift + BLOCK_BITS) if shift + BLOCK_BITS < 64 else F.lit(0).cast("long")
    each = hashes.select(value.alias("hash"), blocks.alias("block"))
    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    size = (1 << BLOCK_BITS) // 8
    # As many rows as blocks, 1,024 at most.
    for row in each.groupBy("block").applyInPandas(block, "block long, bits binary").toLocalIterator():
        start = row["block"] * size
        bitmap[start : start + size] = np.frombuffer(row["bits"], np.uint8)
    sent = hashes.sparkSession.sparkContext.broadcast(bitmap.tobytes())

    @F.pandas_udf("boolean")
    def found(values: pd.Series) -> pd.Series:
        place = values.to_numpy().astype(np.int64).view(np.uint64) >> np.uint64(shift)
        held = np.frombuffer(sent.value, np.uint8)[(place >> np.uint64(3)).astype(np.int64)]
        return pd.Series((held >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool))

    return found
