"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Tokens of every document are counted with a public byte-level BPE vocabulary (its path is a parameter). The
total of the mix is the token count of all documents of listed sources unless one is given. Blocks of `block`
tokens go one by one to the source with the highest quotient share / (2 seats + 1); a source stops when its
documents, each used max_repeats times, hold no further block, and the rest goes to the others, so the shares
reached are reported beside the targets. Each source's quota is apportioned in the same way to its shards
(hash of the record id, a number of shards that grows with the source), and inside a shard whole passes are
taken first, then the documents in seeded order until the quota is reached. A block is thus a unit of account: what is
selected is whole documents, as many as fill the shard's blocks, and no document is cut.

Defined cases: source names are compared trimmed and in small letters; documents of unlisted, null or blank
sources and those with null or empty text take no part; null max_repeats counts as 1, null or negative shares
as 0; a listed source without documents reaches 0; rows repeated under one id are one document; empty tables
give no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import json
import os

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import durable

#: Splits text into pre-tokens (fixed value of the public vocabulary).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
_encoders: dict[str, object] = {}


def encoder(path: str):
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _encoders[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def _count(path: str):
    def run(frames):
        enc = encoder(path)
        for f in frames:
            if not len(f):
                continue
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in f["text"]]
            yield pd.DataFrame({"id": f["id"].to_numpy(), "source": f["source"].to_numpy(), "tokens": n})

    return run


def token_counts(docs: DataFrame, doc_id: str, text: str, source: Column, path: str) -> DataFrame:
    """(id, source, tokens) of each row with a source and a text."""
    d = docs.select(F.col(doc_id).cast("string").alias("id"), source.alias("source"), F.col(text).cast("string").alias("text"))
    d = d.where("id is not null and source is not null and length(text) > 0")
    return d.mapInPandas(_count(path), "id string, source string, tokens long")


def sainte_lague(weights: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """Seats by highest quotients w / (2s + 1), none beyond `most`; ties go to the earlier one.

    The quotient of the last seat is found by bisection, so the work does not grow with the number of seats, whether or
    not some are capped; what rounding and ties leave over is given one by one.
    """
    most = most if most is not None else [seats] * len(weights)
    open_ = [i for i, w in enumerate(weights) if w > 0 and most[i] > 0]
    if sum(most[i] for i in open_) <= seats:
        return [most[i] if i in set(open_) else 0 for i in range(len(weights))]

    def at(q: float) -> list[int]:
        return [min(most[i], int((weights[i] / q + 1) / 2)) if w > 0 and most[i] > 0 else 0 for i, w in enumerate(weights)]

    low, high = 0.0, 2 * max(weights[i] for i in open_)  # at(high) gives none, at(low) too many
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (low, mid) if sum(at(mid)) <= seats else (mid, high)
    got = at(high)
    left = seats - sum(got)
    heap = [(-weights[i] / (2 * got[i] + 1), i) for i in open_ if got[i] < most[i]]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        left -= 1
        if got[i] < most[i]:
            heapq.heappush(heap, (-weights[i] / (2 * got[i] + 1), i))
    return got


def mix_sources(
    docs: DataFrame, doc_id: str, text: str, source: str, targets: DataFrame, path: str, block: int = 1024, total_tokens: int | None = None,
    shard_tokens: int = 20_000_000, max_shards: int = 4096, seed: int = 17,
) -> tuple[DataFrame, DataFrame]:
    """Selection (id, source, tokens, uses) and report (source, target_share, available_tokens, blocks,
    selected_tokens, actual_share).

    path: the vocabulary file, where every worker can read it. A source has at most max_shards shards, which are larger
    where it would need more, so the plan of quotas that goes to all tasks has at most sources x max_shards rows."""
    spark = docs.sparkSession
    name = lambda c: F.lower(F.trim(F.regexp_replace(c, "[\\t\\u00a0]", " ")))
    goal = targets.select(name(F.col("source")).alias("source"), F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)).alias("share"), F.coalesce("max_repeats", F.lit(1)).alias("most"))
    goal = goal.where("source is not null").groupBy("source").agg(F.max("share").alias("share"), F.max("most").alias("most"))
    goals = {r["source"]: (r["share"], r["most"]) for r in goal.collect()}  # one row a listed source
    d = docs.join(F.broadcast(goal.select(F.col("source").alias("_s"))), name(F.col(source)) == F.col("_s"))
    counted = token_counts(d, doc_id, text, F.col("_s"), path)
    counted = durable(counted.groupBy("id").agg(F.min_by("source", "source").alias("source"), F.max("tokens").alias("tokens")))
    size = {r["source"]: r["t"] for r in counted.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    names = sorted(goals)
    total = total_tokens if total_tokens is not None else sum(size.values())
    quota = sainte_lague([goals[s][0] for s in names], total // block, [goals[s][1] * size.get(s, 0) // block for s in names])
    shards = {s: min(max_shards, max(1, -(-size.get(s, 0) // shard_tokens))) for s in names}
    n_shards = F.element_at(F.from_json(F.lit(json.dumps(shards)), "map<string,long>"), F.col("source"))
    placed = counted.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(seed)), n_shards))
    sizes: dict[str, list[tuple[int, int]]] = {}
    for r in placed.groupBy("source", "shard").agg(F.sum("tokens").alias("t")).collect():  # at most sources x max_shards rows
        sizes.setdefault(r["source"], []).append((r["shard"], r["t"]))
    plan = []
    for s, q in zip(names, quota):
        own = sorted(sizes.get(s, []))
        got = sainte_lague([float(t) for _, t in own], q, [goals[s][1] * t // block + 1 for _, t in own])
        plan += [(s, int(k), int(g * block), int(t)) for (k, t), g in zip(own, got)]
    plan_df = spark.createDataFrame(plan, "source string, shard long, quota long, size long") if plan else spark.createDataFrame([], "source string, shard long, quota long, size long")
    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64("id", F.lit(seed + 1)), "id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("tokens").over(order), F.lit(0))
    passes = F.floor(F.col("quota") / F.greatest("size", F.lit(1)))
    rest = F.col("quota") - passes * F.col("size")
    # a document is taken once more if the point halfway through it lies within the rest: the error is at most half a document
    uses = (passes + F.when(before + F.col("tokens") / 2 <= rest, 1).otherwise(0)).cast("int")
    most = F.element_at(F.from_json(F.lit(json.dumps({s: v[1] for s, v in goals.items()})), "map<string,int>"), F.col("source"))
    chosen = placed.join(F.broadcast(plan_df), ["source", "shard"]).select("id", "source", "tokens", F.least(uses, most).alias("uses")).where("uses > 0")
    taken = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("selected_tokens"))
    base = spark.createDataFrame([(s, float(goals[s][0]), int(size.get(s, 0)), int(q)) for s, q in zip(names, quota)], "source string, target_share double, available_tokens long, blocks long")
    rep = base.join(taken, "source", "left").withColumn("selected_tokens", F.coalesce("selected_tokens", F.lit(0)))
    whole = rep.agg(F.sum("selected_tokens").alias("all"))
    report = rep.crossJoin(F.broadcast(whole)).select(*rep.columns, F.round(F.col("selected_tokens") / F.greatest("all", F.lit(1)), 6).alias("actual_share"))
    return chosen, report
