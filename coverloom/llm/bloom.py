"""Bloom filters of bounded size that Spark builds and Python workers probe. False hits cost work and never change a result."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 64-bit words of a filter: 32 MB at most, whatever the input.
MAX_WORDS = 1 << 22


def build(keys: DataFrame, key: str, n: int, max_words: int = MAX_WORDS) -> np.ndarray:
    """Bits of the long column `key`; n: about how many keys. The driver gets one row for each word, max_words at most."""
    words = max(64, min(max_words, n // 5))
    k = F.col(key)
    shift = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.cast("int"))
    low = k.bitwiseAND(F.lit(63).cast("long"))
    high = F.shiftrightunsigned(k, 6).bitwiseAND(F.lit(63).cast("long"))
    # the top 52 bits are not negative as a long, so % agrees with the unsigned one of the probe
    at = F.shiftrightunsigned(k, 12) % F.lit(words)
    rows = keys.groupBy(at.cast("int").alias("w")).agg(F.bit_or(shift(low).bitwiseOR(shift(high))).alias("b")).toArrow()
    bits = np.zeros(words, np.uint64)
    bits[rows.column("w").to_numpy()] = rows.column("b").to_numpy().view(np.uint64)
    return bits
