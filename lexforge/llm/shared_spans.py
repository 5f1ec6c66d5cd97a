"""Long exact spans shared between records, by level-wise doubling.

Level 1 (half the given length): of each record's windows of `min_tokens`/2 tokens only the anchors are
kept, the least hash of every stretch of min_tokens/2 + 1 consecutive windows. A span of min_tokens tokens
holds such a stretch whole, and its anchor depends on nothing outside it, so two records that share the
span share the anchor: no span is lost. Anchors that one record alone has are dropped.
Level 2 (the given length): only windows of min_tokens tokens around a repeated anchor are hashed, and
those that are in another record too are the shared windows. Which anchors are repeated is told to the second pass
over the texts by a bitmap of 64 x `blocks` bits, so that what is broadcast has a bound (12 bytes x blocks) and no text
is shuffled; a bit that two anchors share only adds windows, which are then counted exactly like all others.
Each further level pairs shared windows of one length that follow on each other into windows of twice the
length and keeps the repeated ones, until no candidates survive.

Windows are counted by a streaming pass over sorted hashes after each Arrow batch has been reduced to one
row a hash whose other rows are known to be repeated; a passage that a third of all records hold is thus
settled mostly before the shuffle, and nothing is collected.

Defined cases: null keys are no records; null, empty, short texts share nothing; rows repeated under one
key are one record, and a span repeated only inside one record is not shared; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import durable
from . import bitmap, hashing as H
from .near_duplicates import _first_of_runs

U64 = np.uint64
#: route is the hash, or the record for rows that are known to be shared and need no company.
_ROWS = "route long, rid long, pos int, sure boolean, k long"


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors(h: np.ndarray, off: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window hashes, text and place of the anchors: the least of each w consecutive k-windows of a text."""
    g = H.windows(h, k)
    if len(g) < w:
        return g[:0], np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = off[1:] - off[:-1]
    doc = np.repeat(np.arange(len(n)), n)
    ok = doc[: len(g)] == doc[k - 1 : k - 1 + len(g)]  # the window lies in one text
    least = sliding_min(g, w)
    whole = doc[: len(least)] == doc[k + w - 2 : k + w - 2 + len(least)]
    least = np.where(whole, least, U64(0))
    pad = np.concatenate([np.zeros(w - 1, U64), least, np.zeros(w - 1, U64)])
    most = np.iinfo(U64).max - sliding_min(np.iinfo(U64).max - pad, w)  # the greatest minimum over a place
    at = np.flatnonzero(ok & (g == most[: len(g)]))
    return g[at], doc[at], at - off[doc[at]]


def _combine(k: np.ndarray, rid: np.ndarray, pos: np.ndarray) -> pd.DataFrame:
    """One row a hash goes on under it; the others of a hash that two records have are sure already."""
    order = np.lexsort((rid, k))
    k, rid, pos = k[order], rid[order], pos[order]
    first = _first_of_runs(k)
    new = first == np.arange(len(k))
    shared_at = np.zeros(len(k), bool)
    shared_at[first[rid != rid[first]]] = True
    sure = shared_at[first]
    route = np.where(sure & ~new, rid, k)  # sure rows need no company and are spread by record
    return pd.DataFrame({"route": route, "rid": rid, "pos": pos.astype(np.int32), "sure": sure, "k": k})


def _repeated(batches):
    """Rows in order of their route go by; those whose route two records have, or that are sure, are kept."""
    held: list[pa.RecordBatch] = []  # rows of the hash at hand while only one record has it
    held_key = held_rid = None
    settled = False

    def out(b, mask):
        return b.filter(pa.array(mask))

    for b in batches:
        k, rid, sure = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
        if not len(k):
            continue
        first = _first_of_runs(k)
        differs = (rid != rid[first]) | sure
        goes_on = held_key is not None and k[0] == held_key
        if goes_on:
            run = k == k[0]
            differs = differs | (run & (rid != held_rid))
        keep_at = np.zeros(len(k), bool)
        keep_at[first[differs]] = True
        if goes_on and settled:
            keep_at[0] = True
        keep = keep_at[first]
        if held and goes_on and keep[0]:
            yield from held
        if held and (not goes_on or keep[0]):
            held = []
        tail = first[-1]  # the last run may go on in the next batch
        same = goes_on and tail == 0
        settled = bool(keep[-1])
        if not same:
            held, held_key, held_rid = [], k[-1], rid[tail]
        if not settled:
            # one record's rows under one hash; repeated places of one record only, so few
            last = np.arange(len(k)) >= tail
            held.append(out(b, last))
            keep = keep & ~last
        if keep.any():
            yield out(b, keep)


def _settle(rows: DataFrame) -> DataFrame:
    return rows.repartition("route").sortWithinPartitions("route", "rid").mapInArrow(_repeated, _ROWS)


def _apart(f: pd.DataFrame) -> np.ndarray:
    """What keeps the windows of different scopes apart."""
    return f["apart"].to_numpy(np.int64).view(U64)


def _anchor_rows(k: int, w: int):
    def run(frames):
        for f in H.batches(frames, "text"):
            h, off = H.hash_words(f["text"].tolist(), "token")
            g, doc, pos = anchors(h, off, k, w)
            if len(g):
                yield _combine((g ^ _apart(f)[doc]).view(np.int64), f["rid"].to_numpy(np.int64)[doc], pos)

    return run


def _window_rows(k: int, w: int, length: int, repeated, blocks: int):
    """Windows of `length` tokens that hold a repeated anchor."""

    def run(frames):
        bits = repeated.value
        for f in H.batches(frames, "text"):
            h, off = H.hash_words(f["text"].tolist(), "token")
            g = H.windows(h, length)
            if not len(g):
                continue
            a, doc, pos = anchors(h, off, k, w)
            hit = bitmap.has(bits, (a ^ _apart(f)[doc]).view(np.int64), blocks)
            doc, p = doc[hit], pos[hit] + off[doc[hit]]
            lo, hi = np.maximum(p - (length - k), off[doc]), np.minimum(p, off[doc + 1] - length)
            ok = lo <= hi
            near = np.bincount(lo[ok], minlength=len(h) + 1) - np.bincount(hi[ok] + 1, minlength=len(h) + 1)
            at = np.flatnonzero(np.cumsum(near)[: len(g)] > 0)
            if len(at):
                doc = np.searchsorted(off, at, "right") - 1
                yield _combine((g[at] ^ _apart(f)[doc]).view(np.int64), f["rid"].to_numpy(np.int64)[doc], at - off[doc])

    return run


def shared_windows(src: DataFrame, min_tokens: int, blocks: int = 1 << 23) -> DataFrame:
    """(k, rid, pos): the windows of min_tokens tokens of each record that another record holds too.

    src: (rid, apart, text). blocks: a power of two, of the bitmap.
    """
    half = min_tokens // 2
    w = min_tokens - half + 1
    texts = src.where("text is not null")
    level1 = _settle(texts.mapInPandas(_anchor_rows(half, w), _ROWS))
    repeated = src.sparkSession.sparkContext.broadcast(bitmap.of_keys(level1.select("k"), blocks))
    return _settle(texts.mapInPandas(_window_rows(half, w, min_tokens, repeated, blocks), _ROWS)).select("k", "rid", "pos").distinct()


def double(level: DataFrame, length: int) -> DataFrame:
    """From the shared windows of one length those of twice the length."""
    nxt = level.select(F.col("k").alias("k2"), "rid", (F.col("pos") - length).alias("pos"))
    h = F.xxhash64("k", "k2")
    rows = level.join(nxt, ["rid", "pos"]).select(h.alias("route"), "rid", "pos", F.lit(False).alias("sure"), h.alias("k"))
    return _settle(rows).select("k", "rid", "pos").distinct()


def _source(df: DataFrame, key: str, text: str, scope: str | None) -> DataFrame:
    zone = F.coalesce(F.col(scope).cast("string"), F.lit("")) if scope else F.lit("")
    s = df.select(zone.alias("scope"), F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text")).where("key is not null")
    return s.withColumns({"rid": F.xxhash64("key", "scope"), "apart": F.xxhash64("scope")})


def records_with_shared_span(df: DataFrame, key: str, text: str, min_tokens: int = 30, scope: str | None = None) -> DataFrame:
    """(key) of the records that share a run of at least min_tokens tokens with another record. With a scope column the
    result begins with it, and records of different scopes are not compared."""
    src = _source(df, key, text, scope)
    hit = shared_windows(src.select("rid", "apart", "text"), min_tokens).select("rid").distinct()
    return src.select("scope", "key", "rid").distinct().join(hit, "rid").select(*["scope"] * bool(scope), "key")


def shared_spans(df: DataFrame, key: str, text: str, min_tokens: int = 30, scope: str | None = None) -> DataFrame:
    """([scope,] key, tokens, shared_tokens, shared_share, level) of every record that shares a span.

    shared_tokens: tokens inside a window of min_tokens tokens that another record holds; level: the
    greatest min_tokens * 2^i at which the record still shares a window.
    """
    src = _source(df, key, text, scope)
    level = base = durable(shared_windows(src.select("rid", "apart", "text"), min_tokens))
    size, tops = min_tokens, []
    while True:
        tops.append(level.groupBy("rid").agg(F.lit(size).alias("level")))
        nxt = durable(double(level, size))
        if nxt.isEmpty():
            break
        level, size = nxt, size * 2
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    top = top.groupBy("rid").agg(F.max("level").alias("level"))
    order = Window.partitionBy("rid").orderBy("pos")
    gap = F.col("pos") - F.lag("pos").over(order)
    covered = base.select("rid", "pos").distinct().withColumn("c", F.least(F.coalesce(gap, F.lit(min_tokens)), F.lit(min_tokens)))
    covered = covered.groupBy("rid").agg(F.sum("c").alias("shared_tokens"))
    n = F.size(F.split(F.trim(F.regexp_replace("text", "[ \\t\\n\\r\\f\\u000b\\u0085\\u2028\\u2029]+", " ")), " "))
    names = src.join(covered.select("rid"), "rid", "left_semi").groupBy("rid").agg(F.first("scope").alias("scope"), F.first("key").alias("key"), F.max(n).cast("long").alias("tokens"))
    out = names.join(covered, "rid").join(top, "rid")
    return out.select(*["scope"] * bool(scope), "key", "tokens", "shared_tokens", F.round(F.col("shared_tokens") / F.col("tokens"), 6).alias("shared_share"), "level")
