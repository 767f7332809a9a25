"""A filter of fixed size over 64-bit keys, gathered by tasks and sent to all of them.

It lets rows through that cannot matter and stops none that can, so results never depend on it; with more keys than bits
it stops less.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23


def gather(keys: DataFrame) -> np.ndarray:
    """The bits of the keys in the only column, put together by all tasks: at most BITS / 64 words come to the driver."""
    at = keys.select(F.col(keys.columns[0]).bitwiseAND(F.lit(BITS - 1)).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(at & 63 AS INT)))").alias("bits")).toArrow()
    met = np.zeros(BITS // 64, np.int64)
    met[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return np.packbits(np.unpackbits(met.astype("<i8").view(np.uint8), bitorder="little"))


def may_hold(met: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys may have been gathered."""
    at = (keys.astype(np.uint64, copy=False) % np.uint64(BITS)).astype(np.int64)
    return (met[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
