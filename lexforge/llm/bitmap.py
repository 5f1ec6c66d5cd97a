"""A bitmap of 64-bit hashes with a bound on its size, built by a distributed aggregation and told to Python workers.

It has 64 x `blocks` bits and takes at most 12 bytes x `blocks`; a hash that is in it is always found, others seldom are.
Whoever uses it checks what it lets pass exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

U64 = np.uint64


def of_keys(keys: DataFrame, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits of the keys (k) as sorted block numbers and their words, at most `blocks` of them (a power of two)."""
    at = F.shiftright("k", 6).bitwiseAND(F.lit(blocks - 1)).alias("at")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("k").bitwiseAND(F.lit(63)).cast("int"))
    pdf = keys.groupBy(at).agg(F.bit_or(bit).alias("bits")).toArrow().to_pandas()
    at, bits = pdf["at"].to_numpy(np.int64), pdf["bits"].to_numpy(np.int64)
    o = np.argsort(at)
    return at[o].astype(np.int32), bits[o].view(U64)


def has(bits_of: tuple[np.ndarray, np.ndarray], k: np.ndarray, blocks: int) -> np.ndarray:
    at, bits = bits_of
    if not len(at):
        return np.zeros(len(k), bool)
    want = ((k >> 6) & (blocks - 1)).astype(np.int32)
    i = np.minimum(np.searchsorted(at, want), len(at) - 1)
    return (at[i] == want) & ((bits[i] >> (k & 63).astype(U64)) & U64(1)).astype(bool)
