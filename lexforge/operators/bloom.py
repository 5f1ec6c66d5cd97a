"""A blocked Bloom filter as a table: one 64-bit word a block, BITS bits a key, built by a distributed aggregation.

The table has as many rows as there are blocks, whatever the number of keys, so its size has a bound of
16 bytes x MAX_BLOCKS and it may be broadcast. Beyond MAX_BLOCKS x 64 / `bits_per_key` keys the filter only lets more rows
pass; whoever uses it checks those that pass exactly.

Defined cases: null keys are not in the filter and never pass; no keys let nothing pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 6
MAX_BLOCKS = 1 << 20


def mask(key: Column) -> Column:
    h = F.xxhash64(key, F.lit(1))
    m = F.lit(0).cast("long")
    for i in range(BITS):
        # 1 << n, n taken from six bits of the second hash
        m = m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, i * 6).bitwiseAND(F.lit(63)).cast("int")))
    return m


def block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def blocks_for(n: int, bits_per_key: int = 16, max_blocks: int = MAX_BLOCKS) -> int:
    return max(64, min(max_blocks, n * bits_per_key // 64))


def words(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter as rows (block, word); at most `blocks` rows."""
    k = keys.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    return k.groupBy(block(F.col("k"), blocks).alias("block")).agg(F.bit_or(mask(F.col("k"))).alias("word"))


def may_contain(df: DataFrame, column: str, keys: DataFrame, key: str, **size: int) -> DataFrame:
    """The rows of df whose column may be among the keys; a key's own rows always are. Both columns of one type."""
    n = blocks_for(keys.count(), **size)
    w = words(keys, key, n)
    c = F.col(column)
    got = df.join(F.broadcast(w), block(c, n) == F.col("block"))
    return got.where(F.col("word").bitwiseAND(mask(c)) == mask(c)).select(*df.columns)
