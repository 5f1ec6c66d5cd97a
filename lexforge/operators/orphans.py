"""References to records that do not exist.

A blocked Bloom filter of the parent keys is built by a distributed aggregation (one 64-bit word per
block, BITS bits set per key) and broadcast as a table of words, whose number of rows is fixed by
`max_blocks` whatever the number of parents: at most 16 bytes x max_blocks. A reference whose bits are
not all set is an orphan for certain. Only the references that pass the filter are verified by an exact
join, on their distinct keys, so that a key cited by a third of all rows is one row there.

Defined cases: null, empty and blank references are no references; an empty parent table makes every
reference an orphan; null parent keys match nothing; repeated rows give one result each distinct
(id, side); other columns are ignored, whatever their names. Rows whose id is null are reported with a
null id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ids import is_valid_id
from ..session import blank_trim, salted_join
from . import bloom

def normal_id(c: Column) -> Column:
    """Upper case, without surrounding blanks; null where nothing is left."""
    t = F.upper(blank_trim(c))
    return F.when(F.length(t) > 0, t)


def orphan_references(
    children: DataFrame,
    child_id: str,
    sides: dict[str, str],
    parents: DataFrame,
    parent_key: str,
    period: Column | None = None,
    max_blocks: int = bloom.MAX_BLOCKS,
    bits_per_key: int = 16,
) -> DataFrame:
    """(id, side, ref[, period]) of each distinct reference without a parent.

    sides: name of the side -> column with the reference. period: an expression over the children.
    """
    keyed = parents.select(F.col(parent_key).cast("string").alias("ref"))
    blocks = bloom.blocks_for(keyed.count(), bits_per_key, max_blocks)
    words = bloom.words(keyed, "ref", blocks)
    stack = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), normal_id(F.col(c)).alias("ref")) for s, c in sides.items()]))
    refs = children.select(F.col(child_id).alias("id"), (period if period is not None else F.lit(None).cast("int")).alias("period"), stack.alias("s"))
    refs = refs.select("id", "period", "s.side", "s.ref").where(F.col("ref").isNotNull())
    tested = refs.join(F.broadcast(words), bloom.block(F.col("ref"), blocks) == F.col("block"), "left")
    passes = F.coalesce(F.col("word").bitwiseAND(bloom.mask(F.col("ref"))) == bloom.mask(F.col("ref")), F.lit(False))
    tested = tested.select("id", "period", "side", "ref", passes.alias("maybe"))
    definite = tested.where(~F.col("maybe")).drop("maybe")
    maybe = tested.where("maybe").drop("maybe")
    keys = keyed.where(F.col("ref").isNotNull()).distinct()
    missing = maybe.select("ref").distinct().join(keys, "ref", "left_anti")
    verified = salted_join(maybe, missing, "ref", "left_semi").select("id", "period", "side", "ref")
    out = definite.unionByName(verified).distinct()
    return out if period is not None else out.drop("period")


def orphans_by_period(orphans: DataFrame) -> DataFrame:
    """Number of orphan references and of distinct missing keys per side and period."""
    return orphans.groupBy("side", "period").agg(
        F.count(F.lit(1)).alias("orphan_refs"), F.countDistinct("ref").alias("missing_keys")
    )


def orphan_reasons(orphans: DataFrame, checkpoint: DataFrame, key: str = "celex_id", status: str = "status") -> DataFrame:
    """orphans with `reason`, as far as the run's checkpoint tells: 'malformed' (no such id can exist), 'dropped' (it was
    processed and is gone), 'failed' (it was asked for and may still come), 'unknown' (nobody asked for it)."""
    seen = checkpoint.select(normal_id(F.col(key)).alias("ref"), F.col(status).alias("_s")).where("ref is not null")
    seen = seen.groupBy("ref").agg(F.bool_or(F.col("_s") == "processed").alias("_done"), F.bool_or(F.col("_s") == "failed").alias("_failed"))
    known = orphans.select("ref").distinct().join(seen, "ref")
    reason = F.when(~is_valid_id(F.col("ref")), "malformed").when(F.col("_done"), "dropped").when(F.col("_failed"), "failed").otherwise("unknown")
    return salted_join(orphans, known, "ref", "left").withColumn("reason", reason).drop("_done", "_failed")
