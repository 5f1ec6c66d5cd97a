"""Near-duplicate records: one-permutation hashing, banded buckets, star-shaped candidate edges.

1. Each record's distinct word shingles fall into `bins` bins by the top bits of one hash; a bin keeps its
   least value, and an empty bin takes that of a full one picked by a seeded sequence of probes (optimal
   densification). `rows` bins, picked by a seeded draw, make the key of one of `bands` buckets.
2. Records with equal shingle sets are one class from the start, and a class stands in a bucket once, under the
   hash of its set, however many records it has: a group of copies that holds a third of all rows makes no pairs.
   The buckets stream by in sorted order, and each gives a star: edges from its first class, the hub, to every
   other class. So a class has at most one edge a bucket, and the candidates grow in proportion to the records.
3. The text of each class goes once to each of its hubs. Around a hub all classes are compared exactly (Jaccard of
   the distinct shingles of whole texts), at once and in memory, so two classes that are alike but both unlike the hub
   are found too: every pair that shares a bucket is tried. A hub with more than `block` classes is worked in blocks.
4. `links` asks for every link, so a hub's blocks meet pairwise. `groups` asks only who belongs together: a block
   meets the hub first, and only classes that this leaves apart from the hub meet the other blocks, so a group of
   any size whose members are like their hub costs one pass.

Only links between classes come out. The blocks of a hub that hold more than one text are the sole place where work is
quadratic, and only in classes that share a bucket without being alike (or whose links are all asked for).

Defined cases: null keys are no records; null, empty and short texts (fewer than `min_words` words) are
like no other; rows repeated under one key are one record, taken by one of their texts if they differ; an empty
table gives no rows; extra columns are ignored. Keys are carried as xxhash64 until the end.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.bloom import may_contain
from ..operators.components import connected_components
from ..session import durable, salted_join
from . import hashing as H

U64 = np.uint64
_NONE = np.iinfo(np.uint64).max


@lru_cache(4)
def _plan(bins: int, rows: int, bands: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240607)
    probes = np.stack([r.permutation(bins) for _ in range(64)])
    return probes, np.stack([r.permutation(bins)[:rows] for _ in range(bands)])


def _shingle_sets(texts, k: int, min_words: int):
    """Per text that has enough words: its index, and its sorted distinct shingles end to end with offsets."""
    h, off = H.hash_words(texts)
    g = H.windows(h, k)
    first, last = H.window_limits(off, k)
    ok = np.flatnonzero((off[1:] - off[:-1] >= min_words) & (last > first))
    n = (last - first)[ok]
    if not len(ok):
        return ok, np.zeros(0, U64), np.zeros(1, np.int64)
    doc = np.repeat(np.arange(len(ok)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[ok], n)
    v = g[at]
    order = np.lexsort((v, doc))
    doc, v = doc[order], v[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (v[1:] != v[:-1])
    doc, v = doc[keep], v[keep]
    return ok, v, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(ok)))])


def one_permutation(v: np.ndarray, off: np.ndarray, bins: int, probes: np.ndarray) -> np.ndarray:
    """The densified signatures, one line of `bins` values a set. bins: a power of two."""
    nd, shift = len(off) - 1, U64(64 - bins.bit_length() + 1)
    cell = np.repeat(np.arange(nd), np.diff(off)) * bins + (v >> shift).astype(np.int64)
    sig = np.full(nd * bins, _NONE, U64)
    lead = np.ones(len(v), bool)  # v is sorted in each set, so a cell's first value is its least
    lead[1:] = cell[1:] != cell[:-1]
    sig[cell[lead]] = v[lead]
    sig = sig.reshape(nd, bins)
    out, (i, j) = sig.copy(), np.nonzero(sig == _NONE)
    for t in range(1 << 30):
        if not len(i):
            break
        donor = probes[t % len(probes)][(j + t // len(probes)) % bins]
        got = sig[i, donor]
        ok = got != _NONE
        out[i[ok], j[ok]] = H.mix(got[ok])
        i, j = i[~ok], j[~ok]
    return out


def _first_of_runs(x: np.ndarray) -> np.ndarray:
    """For sorted x: for each place the place where its run begins."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))


def _sign(k: int, min_words: int, bins: int, rows: int, bands: int):
    def run(frames):
        probes, cols = _plan(bins, rows, bands)
        for f in H.batches(frames, "text"):
            ok, v, off = _shingle_sets(f["text"].tolist(), k, min_words)
            if not len(ok):
                continue
            rid = f["rid"].to_numpy(np.int64)[ok]
            apart = f["apart"].to_numpy(np.int64).view(U64)[ok]
            n = np.diff(off)
            total = np.concatenate([[U64(0)], np.cumsum(H.mix(v ^ U64(0x51ED270B)), dtype=U64)])
            whole = H.mix((total[off[1:]] - total[off[:-1]]) ^ n.astype(U64) ^ apart).view(np.int64)
            yield pd.DataFrame({"a": rid, "b": whole, "s": 1})
            order = np.lexsort((rid, whole))
            hub = order[_first_of_runs(whole[order]) == np.arange(len(order))]  # one record a class
            sig = one_permutation(v, off, bins, probes)[hub]
            own = whole[hub]
            keys = []
            for band in range(bands):
                h = apart[hub] + U64(band + 1)
                for c in cols[band]:
                    h = H.mix(h * U64(0x9E3779B97F4A7C15) + sig[:, c])
                keys.append(h.view(np.int64))
            yield pd.DataFrame({"a": np.concatenate(keys), "b": np.tile(own, bands), "s": 0})

    return run


def _triples(a: np.ndarray, b: np.ndarray, s: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), s, np.int32))], names=["a", "b", "s"])


def _stars(batches):
    """Buckets (a: key, b: class, s = 0) in sorted order go by: an edge (a: hub, b: class, s = 2) from the first class of
    each to each other one. Class rows (s = 1) pass."""
    key = hub = last = None
    for batch in batches:
        a, b, s = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if (s != 0).any():
            yield _triples(a[s != 0], b[s != 0], 1)
            a, b = a[s == 0], b[s == 0]
        if not len(a):
            continue
        first = b[_first_of_runs(a)]
        fresh = np.ones(len(a), bool)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        if key == a[0]:  # the bucket goes on
            run = a == key
            first = np.where(run, hub, first)
            fresh[0] = b[0] != last
        key, hub, last = a[-1], first[-1], b[-1]
        edge = fresh & (b != first)
        if edge.any():
            e = np.unique(np.stack([first[edge], b[edge]]), axis=1)
            yield _triples(e[0], e[1], 2)


def _met(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of signed rows: the class of each record (rid, whole), and the star edges (hub, whole) of the buckets."""
    met = durable(signed.repartition("a").sortWithinPartitions("a", "b").mapInArrow(_stars, "a long, b long, s int"))
    whole = met.where("s = 1").groupBy(F.col("a").alias("rid")).agg(F.min("b").alias("whole"))
    return whole, met.where("s = 2").select(F.col("a").alias("hub"), F.col("b").alias("whole")).distinct()


def _alike(v: np.ndarray, off: np.ndarray, group: np.ndarray, side: np.ndarray, threshold: float):
    """Pairs (i, j, similarity) of sets of one group that are alike enough; v: sorted distinct shingles of each set.
    group: the number of each set's group, rising. Sets of side 1 are not paired among each other, nor are those of side
    2; side 0 are paired with all."""
    n = np.diff(off)
    sizes = np.bincount(group)
    begin = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(n)), n)
    small = sizes[group] <= 12
    parts = []
    pick = small[doc]
    if pick.any():  # runs of equal shingles in equal groups, all pairs of each short run
        d, x = doc[pick], v[pick]
        o = np.lexsort((d, x, group[d]))
        d, x = d[o], x[o]
        g = group[d]
        new = np.ones(len(d), bool)
        new[1:] = (x[1:] != x[:-1]) | (g[1:] != g[:-1])
        at = np.flatnonzero(new)
        length = np.diff(np.append(at, len(d)))
        for m in np.unique(length):
            if m > 1:
                rows = d[at[length == m][:, None] + np.arange(m)]
                i, j = np.triu_indices(m, 1)
                parts.append(np.stack([rows[:, i].ravel(), rows[:, j].ravel()]))
        if parts:
            ij, both = np.unique(np.concatenate(parts, axis=1), axis=1, return_counts=True)
            parts = [(ij[0], ij[1], both)]
    for g in np.flatnonzero(sizes > 12):  # intersections of all sets of the group as a matrix product
        lo, hi = begin[g], begin[g] + sizes[g]
        vals, col = np.unique(v[off[lo] : off[hi]], return_inverse=True)
        seen = np.bincount(col)
        col = np.where(seen > 1, np.cumsum(seen > 1)[np.arange(len(seen))] - 1, -1)[np.arange(len(seen))][col]
        row = doc[off[lo] : off[hi]] - lo
        wide = int((seen > 1).sum())
        total = np.zeros((sizes[g], sizes[g]), np.float32)
        order = np.argsort(col, kind="stable")
        order = order[np.searchsorted(col[order], 0) :]
        for at in range(0, wide, 16384):  # in strips, so that memory is bounded whatever the texts
            p, q = np.searchsorted(col[order], [at, at + 16384])
            m = np.zeros((sizes[g], min(16384, wide - at)), np.float32)
            m[row[order[p:q]], col[order[p:q]] - at] = 1
            total += m @ m.T
        i, j = np.triu_indices(sizes[g], 1)
        both = np.rint(total[i, j]).astype(np.int64)
        parts.append((i[both > 0] + lo, j[both > 0] + lo, both[both > 0]))
    if not parts:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0)
    i, j, both = (np.concatenate(x) for x in zip(*parts))
    sim = both / (n[i] + n[j] - both)
    ok = (sim >= threshold - 1e-12) & ((side[i] != side[j]) | (side[i] == 0))
    return i[ok], j[ok], sim[ok]


def _around(k: int, threshold: float, joined: bool, hold: int = 2048):
    """Rows (hub, p, q, side, whole, text) in order of (hub, p, q) go by, group by group. Links (a, b, similarity), or if
    joined (a, b, hub, apart): each class with the first one that it hangs together with in the group, and whether the
    hub is not among these."""

    def work(f: pd.DataFrame):
        f = f.reset_index(drop=True)
        cut = np.ones(len(f), bool)
        for c in ("hub", "p", "q"):
            x = f[c].to_numpy()
            cut[1:] &= x[1:] == x[:-1]
        cut[1:] = ~cut[1:]
        group = np.cumsum(cut) - 1
        ok, v, off = _shingle_sets(f["text"].tolist(), k, 0)
        whole, side = f["whole"].to_numpy(np.int64), f["side"].to_numpy()
        _, gr = np.unique(group[ok], return_inverse=True)
        i, j, sim = _alike(v, off, gr, side[ok], threshold) if len(ok) else (np.zeros(0, np.int64),) * 3
        i, j = ok[i], ok[j]
        if not joined:
            return pd.DataFrame({"a": np.minimum(whole[i], whole[j]), "b": np.maximum(whole[i], whole[j]), "similarity": sim}).drop_duplicates(["a", "b"])
        low = np.arange(len(f))
        while True:  # least place of each component
            old = low.copy()
            np.minimum.at(low, i, old[j])
            np.minimum.at(low, j, old[i])
            low = low[low]
            if (low == old).all():
                break
        hubs, hub = f["hub"].to_numpy(np.int64), np.full(group[-1] + 1, -1)
        at = whole == hubs
        hub[group[at]] = low[at]
        apart = low != hub[group]
        tell = apart | (whole != whole[low])
        return pd.DataFrame({"a": whole[tell], "b": whole[low[tell]], "hub": hubs[tell], "apart": apart[tell]})

    def run(frames):
        held: list[pd.DataFrame] = []
        key, rows, chars = None, 0, 0
        for frame in frames:
            for f in H.batches([frame], "text", H.CHUNK):
                last = f[["hub", "p", "q"]].iloc[-1].tolist()
                same = (f["hub"].to_numpy() == last[0]) & (f["p"].to_numpy() == last[1]) & (f["q"].to_numpy() == last[2])
                tail = len(f) if same.all() else len(f) - np.argmin(same[::-1])
                if not same.all() or (key is not None and last != key):
                    done = f.iloc[:tail] if not same.all() else f.iloc[:0]
                    whole = pd.concat([*held, done]) if held else done
                    if len(whole):
                        yield work(whole)
                    held, f = [], (f.iloc[tail:] if not same.all() else f)
                held.append(f)
                key = last
        if held:
            yield work(pd.concat(held))

    return run


def _spread(edges: DataFrame, block: int) -> DataFrame:
    """(hub, whole, b, blocks): the classes around each hub, itself with them, dealt into blocks of about `block`."""
    size = edges.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    many = size.where("blocks > 1")
    e = salted_join(edges, many, "hub", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    e = e.withColumn("b", F.pmod(F.xxhash64("whole"), F.col("blocks")).cast("int")).select("hub", "whole", "b", "blocks")
    return e.unionByName(size.select("hub", F.col("hub").alias("whole"), F.lit(-1).alias("b"), "blocks"))


def _compare(rows: DataFrame, texts: tuple[DataFrame, DataFrame], k: int, threshold: float, joined: bool) -> DataFrame:
    """rows (hub, p, q, side, whole) with the texts of their classes, compared around each (hub, p, q). texts: the record that
    speaks for a class (whole, rid), and texts (rid, text); a text is sent by its record, where repeats fall out, and from
    there to its hubs."""
    speaks, text = texts
    r = rows.join(speaks, "whole").join(text, "rid").select("hub", "p", "q", "side", "whole", "text").repartition("hub", "p", "q").sortWithinPartitions("hub", "p", "q")
    return r.mapInPandas(_around(k, threshold, joined), "a long, b long, hub long, apart boolean" if joined else "a long, b long, similarity double")


def _every_block(e: DataFrame, here: str = "b") -> tuple:
    """Where a class of block b meets the other blocks: with the lower number first, and on the side it comes from."""
    j = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j")
    d = e.select("hub", "whole", "b", j)
    side = F.when(F.col("b") == F.col("j"), 0).when(F.col("b") < F.col("j"), 1).otherwise(2)
    return d.select("hub", F.least("b", "j").alias("p"), F.greatest("b", "j").alias("q"), side.alias("side"), "whole")


def _links(edges: DataFrame, texts: tuple[DataFrame, DataFrame], k: int, threshold: float, block: int) -> DataFrame:
    """All links (a, b, similarity) of classes that share a bucket."""
    e = _spread(edges, block)
    # the hub is dealt into a block like any other class
    e = e.withColumn("b", F.when(F.col("b") < 0, F.pmod(F.xxhash64("whole"), F.col("blocks")).cast("int")).otherwise(F.col("b")))
    return _compare(_every_block(e), texts, k, threshold, False).groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


def _joined(edges: DataFrame, texts: tuple[DataFrame, DataFrame], k: int, threshold: float, block: int) -> DataFrame:
    """Edges (a, b) that hang together exactly the classes that links would."""
    e = durable(_spread(edges, block))
    with_hub = F.when(F.col("b") < 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("b"))
    first = e.select("hub", F.explode(with_hub).alias("p"), "whole").select("hub", "p", F.lit(0).alias("q"), F.lit(0).alias("side"), "whole")
    met = durable(_compare(first, texts, k, threshold, True))
    out = met.select("a", "b")
    # classes of hubs with several blocks that are apart from their hub meet all its other blocks
    many = e.where("blocks > 1 and b >= 0")
    apart = many.join(met.where("apart").select("hub", F.col("a").alias("whole")).distinct(), ["hub", "whole"], "left_semi")
    if not apart.isEmpty():
        left = apart.select("hub", "whole", F.col("b").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
        there = apart.select("hub", F.col("b").alias("i")).distinct()
        right = many.select("hub", "whole", F.col("b").alias("j")).join(there, "hub").select("hub", "whole", "i", "j")
        rows = left.where("i <> j").select("hub", F.col("i").alias("p"), F.col("j").alias("q"), F.lit(1).alias("side"), "whole")
        rows = rows.unionByName(right.where("i <> j").select("hub", F.col("i").alias("p"), F.col("j").alias("q"), F.lit(2).alias("side"), "whole"))
        out = out.unionByName(_compare(rows, texts, k, threshold, True).select("a", "b"))
    return out.where("a <> b").distinct()


def _prepare(df: DataFrame, key: str, text: str, shingle: int, min_words: int, bins: int, rows: int, bands: int, scope: str | None):
    """Records (rid, scope, key, text), their classes (rid, whole), star edges, and the texts of the classes that have an
    edge, as _compare takes them."""
    zone = F.coalesce(F.col(scope).cast("string"), F.lit("")) if scope else F.lit("")
    src = df.select(zone.alias("scope"), F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text")).where("key is not null and text is not null")
    src = src.withColumn("rid", F.xxhash64("key", "scope") if scope else F.xxhash64("key"))
    signed = src.select("rid", F.xxhash64("scope").alias("apart"), "text").mapInPandas(_sign(shingle, min_words, bins, rows, bands), "a long, b long, s int")
    whole, edges = _met(signed)
    edges = durable(edges)
    ends = edges.select("whole").unionByName(edges.select(F.col("hub").alias("whole"))).distinct()
    whole = durable(whole)
    speaks = durable(whole.groupBy("whole").agg(F.min("rid").alias("rid")).join(ends, "whole", "left_semi"))
    near = may_contain(src.select("rid", "text"), "rid", speaks, "rid")
    return src, whole, edges, (speaks, near.groupBy("rid").agg(F.first("text").alias("text")))


def near_duplicates(
    df: DataFrame,
    key: str,
    text: str,
    threshold: float = 0.8,
    shingle: int = 5,
    min_words: int = 1,
    bins: int = 128,
    rows: int = 5,
    bands: int = 44,
    scope: str | None = None,
    block: int = 256,
) -> tuple[DataFrame, DataFrame]:
    """Links (key_a, key_b, similarity) between classes, and members (key, class_key). With a scope column both
    begin with it: keys are told apart by it, and records of different scopes are not compared.

    A class is the set of records with equal distinct shingles, named by one of its records; its members
    are alike with similarity 1 and are not paired with each other. Every other link has key_a < key_b.
    """
    src, whole, edges, texts = _prepare(df, key, text, shingle, min_words, bins, rows, bands, scope)
    links = durable(_links(edges, texts, shingle, threshold, block))
    records = durable(whole.join(src.select("rid", "scope", "key").distinct(), "rid"))
    named = durable(records.groupBy("whole").agg(F.min("key").alias("class_key")))
    members = salted_join(records, named, "whole")
    linked = links.join(named.withColumnsRenamed({"whole": "a", "class_key": "ka"}), "a").join(named.withColumnsRenamed({"whole": "b", "class_key": "kb"}), "b")
    lead = ["scope"] if scope else []
    if scope:
        linked = linked.join(records.groupBy(F.col("whole").alias("a")).agg(F.first("scope").alias("scope")), "a")
    return (
        linked.select(*lead, F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b"), "similarity"),
        members.select(*lead, "key", "class_key"),
    )


def groups(
    df: DataFrame,
    key: str,
    text: str,
    threshold: float = 0.8,
    shingle: int = 5,
    min_words: int = 1,
    bins: int = 128,
    rows: int = 5,
    bands: int = 44,
    scope: str | None = None,
    block: int = 256,
) -> DataFrame:
    """([scope,] key, group_key, group_size) of each record that hangs together with another one by links, or is its copy.
    group_key is the least key of the group."""
    src, whole, edges, texts = _prepare(df, key, text, shingle, min_words, bins, rows, bands, scope)
    comp = connected_components(_joined(edges, texts, shingle, threshold, block))
    records = durable(whole.join(src.select("rid", "scope", "key").distinct(), "rid"))
    at = salted_join(records, comp.select(F.col("node").alias("whole"), "component"), "whole", "left")
    at = durable(at.select("scope", "key", F.coalesce("component", "whole").alias("g")))
    size = at.groupBy("g").agg(F.min("key").alias("group_key"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    return salted_join(at, size, "g").select(*["scope"] * bool(scope), "key", "group_key", "group_size")


def expand_pairs(links: DataFrame, members: DataFrame, salts: int = 64) -> DataFrame:
    """All alike pairs of records (key_a < key_b): links between classes times their members, and the
    pairs within a class. Its size is that of the result asked for; the members of a class are dealt over `salts`."""
    lead = ["scope"] if "scope" in members.columns else []
    m = members.select(*lead, F.col("class_key").alias("ca"), F.col("key").alias("x"))
    n = members.select(*lead, F.col("class_key").alias("cb"), F.col("key").alias("y"))
    between = links.select(*lead, F.col("key_a").alias("ca"), F.col("key_b").alias("cb")).join(m, [*lead, "ca"]).join(n, [*lead, "cb"]).select(*lead, "x", "y")
    many = members.groupBy(*lead, F.col("class_key").alias("ca")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.when(F.col("n") > 1000, salts).otherwise(1)
    within = m.join(many, [*lead, "ca"]).withColumn("parts", parts)
    left = within.select(*lead, "ca", "x", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int").alias("salt"))
    right = within.select(*lead, "ca", F.col("x").alias("y"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    within = left.join(right, [*lead, "ca", "salt"]).where("x < y").select(*lead, "x", "y")
    return between.unionByName(within).select(*lead, F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).where("key_a < key_b").distinct()
