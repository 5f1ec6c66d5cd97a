"""Items that appear together: pair counts by an external sort of packed 64-bit pair codes.

Items get dense codes; each record's distinct items are paired in blocks, two codes are packed into one
long, and the shuffle sorts the longs: Spark's sort spills sorted runs and merges them. A streaming pass
over each sorted partition counts run lengths without holding more than one Arrow batch; each map batch
has counted its own runs before, so a pair that a third of all records bear is sent a few times, not once a
record. Odds ratios get a continuity correction of one half.

A pair can have min_count records only if both items have, and an observed/expected ratio of min_lift only if
neither item is on more than records / min_lift records; items beyond are left out before pairing. Both
follow from the definitions, so no asked-for pair is lost.

Defined cases: null and blank records or items do not count; repeated (record, item) rows count once; a
record with one item gives no pair; whatever its size a record is never held whole, as its blocks of about
BLOCK items meet two by two; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import blank_trim, durable, salted_join
from .near_duplicates import _first_of_runs

BLOCK = 256


def normal_label(c: Column) -> Column:
    """Lower case, no surrounding blanks, inner blanks and tabs as one space; null where nothing is left."""
    t = F.regexp_replace(F.lower(c), "[ \\t\\u00a0]+", " ")
    t = F.trim(t)
    return F.when(F.length(t) > 0, t)


def _pair_blocks(frames):
    """Packed codes of all pairs of two blocks of items, with their run lengths in the batch."""
    for f in frames:
        codes = []
        for x, y, same in zip(f["xs"], f["ys"], f["same"]):
            x, y = np.asarray(x, np.int64), np.asarray(y, np.int64)
            if same:
                i, j = np.triu_indices(len(x), 1)
                p, q = x[i], x[j]
            else:
                p, q = np.repeat(x, len(y)), np.tile(y, len(x))
            codes.append((np.minimum(p, q) << 32) | np.maximum(p, q))
        if codes:
            c, n = np.unique(np.concatenate(codes), return_counts=True)
            yield pd.DataFrame({"code": c, "n": n})


def _run_lengths(batches):
    key, total = None, 0
    for b in batches:
        k, n = b.column(0).to_numpy(), b.column(1).to_numpy()
        if not len(k):
            continue
        at = np.flatnonzero(_first_of_runs(k) == np.arange(len(k)))
        ks, ns = k[at], np.add.reduceat(n, at)
        if key is not None:
            if ks[0] == key:
                ns[0] += total
            else:
                ks, ns = np.concatenate([[key], ks]), np.concatenate([[total], ns])
        key, total = ks[-1], ns[-1]
        if len(ks) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(ks[:-1]), pa.array(ns[:-1])], names=["code", "n"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([total], pa.int64())], names=["code", "n"])


def together(df: DataFrame, record: Column, item: Column, min_count: int = 1, min_lift: float = 0.0) -> DataFrame:
    """(label_a, label_b, n_both, n_a, n_b, n_records, lift, odds_ratio), label_a < label_b."""
    rows = df.select(record.alias("r"), item.alias("x")).where("r is not null and x is not null").distinct()
    rows = durable(rows)
    records = rows.select("r").distinct().count()
    most = records if min_lift <= 0 else records / min_lift
    items = rows.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    # dense codes without a global window: partition number and place in it, by a hash of the item
    items = durable(items.where((F.col("n") >= min_count) & (F.col("n") <= most + 1e-9)))
    part = items.withColumn("p", F.pmod(F.xxhash64("x"), F.lit(4096)).cast("int"))
    rank = F.row_number().over(Window.partitionBy("p").orderBy("x")) - 1
    coded = durable(part.select("x", "n", (F.shiftleft(rank, 12).bitwiseOR(F.col("p"))).cast("long").alias("code")))
    k = durable(salted_join(rows, coded.select("x", "code"), "x").select("r", "code"))
    # a record of more than BLOCK items is dealt into blocks by a hash, and each two of its blocks meet in a task of their own
    many = k.groupBy("r").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    k = salted_join(k, many, "r", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    k = k.select("r", "code", F.pmod(F.xxhash64("code"), F.col("blocks")).cast("int").alias("b"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    p, q = F.least("b", "j"), F.greatest("b", "j")
    own, other = (F.collect_list(F.when(c, F.col("code"))) for c in (F.col("b") == F.col("p"), F.col("b") != F.col("p")))
    met = k.select("r", "code", "b", p.alias("p"), q.alias("q")).groupBy("r", "p", "q").agg(own.alias("xs"), other.alias("ys"))
    pairs = met.select("xs", "ys", (F.col("p") == F.col("q")).alias("same"))
    codes = pairs.mapInPandas(_pair_blocks, "code long, n long")
    counted = codes.repartition("code").sortWithinPartitions("code").mapInArrow(_run_lengths, "code long, n long")
    counted = counted.where(F.col("n") >= min_count).select(F.shiftrightunsigned("code", 32).alias("ca"), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).alias("cb"), "n")
    a = coded.select(F.col("code").alias("ca"), F.col("x").alias("xa"), F.col("n").alias("na"))
    b = coded.select(F.col("code").alias("cb"), F.col("x").alias("xb"), F.col("n").alias("nb"))
    j = counted.join(a, "ca").join(b, "cb")
    swap = F.col("xa") > F.col("xb")
    pick = lambda p, q: F.when(swap, F.col(q)).otherwise(F.col(p))
    out = j.select(
        pick("xa", "xb").alias("label_a"), pick("xb", "xa").alias("label_b"), F.col("n").alias("n_both"),
        pick("na", "nb").alias("n_a"), pick("nb", "na").alias("n_b"), F.lit(records).cast("long").alias("n_records"),
    )
    d = lambda c: F.col(c).cast("double")
    both, only_a, only_b = d("n_both"), d("n_a") - d("n_both"), d("n_b") - d("n_both")
    none = d("n_records") - d("n_a") - d("n_b") + d("n_both")
    out = out.where(F.col("n_both") * F.col("n_records") >= min_lift * F.col("n_a") * F.col("n_b"))
    return out.select(
        "*",
        F.round(both * d("n_records") / (d("n_a") * d("n_b")), 6).alias("lift"),
        F.round((both + 0.5) * (none + 0.5) / ((only_a + 0.5) * (only_b + 0.5)), 6).alias("odds_ratio"),
    )


def labels_together(df: DataFrame, record: str, label: str, min_count: int = 5, min_lift: float = 3.0) -> DataFrame:
    """together() for columns of ids and labels as they are spelled."""
    rid = F.upper(blank_trim(F.col(record)))
    return together(df, F.when(F.length(rid) > 0, rid), normal_label(F.col(label)), min_count, min_lift)
