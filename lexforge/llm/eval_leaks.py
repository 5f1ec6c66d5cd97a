"""Evaluation texts leaking into training text: template canonicalisation and slot consistency.

Words are the maximal runs of letters or digits of the lower-cased text, so signs, blanks, line breaks and
letter case between them play no part. Each word that is a number, a name or a unit is replaced by a typed
placeholder; the hash of `window` canonical words is a template window. Names are the words that the items
themselves write with a capital inside a sentence and never in small letters; as the list is applied to
lower-cased words on both sides, equal words always give equal templates.

The documents' windows are tested against a bitmap of the items' templates (its size has a bound, see bitmap.py)
where they are made, and the few that pass are hash-joined with the items. Where a window and an item's window have
equal words in all slots the item has leaked verbatim. Otherwise all windows of a document that lie at the same distance
from the item's own form one copy, and the item is re-parameterised there if over the whole copy each item word in a
slot stands for one word of the document and the other way round; anything else is no leak.

Defined cases: null and empty texts hold nothing, null ids are no records; items shorter than the window have no
window and so no leak by definition; repeated rows give one result; an empty table on either side gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import bounded_broadcast, durable
from . import bitmap, hashing as H

U64 = np.uint64
#: Units of measure, time and money (fixed values, in small letters).
UNITS = "mg g kg t tonne tonnes ml l litre litres mm cm m km ha hectare hectares kw kwh mw mwh percent eur euro euros usd gbp day days week weeks month months year years hour hours minute minutes second seconds".split()
_NUMBER, _NAME, _UNIT = (U64(x) for x in (0xA11CE5ED00000001, 0xA11CE5ED00000002, 0xA11CE5ED00000003))


def item_names(items: DataFrame, text: str) -> list[str]:
    """Words written with a capital inside a sentence and never in small letters; at most one a word of the items."""
    words = F.regexp_extract_all(F.col(text), F.lit("(?U)(?:[.?!:] *)?[^\\W_]+"), 0)
    w = items.select(F.explode(F.slice(words, 2, 1 << 30)).alias("w"))  # the first word begins a sentence
    inner = w.where(F.col("w").rlike("^[^.?!:]")).select(F.regexp_replace("w", "[^\\p{L}\\p{N}]", "").alias("w"))
    small = inner.where(F.lower("w") == F.col("w")).select(F.lower("w").alias("l")).distinct()
    caps = inner.where(F.col("w").rlike("^\\p{Lu}\\p{Ll}+$")).select(F.lower("w").alias("l")).distinct()
    return sorted(r[0] for r in caps.join(small, "l", "left_anti").collect())


def _word_hashes(words: list[str]) -> np.ndarray:
    return np.sort(H.hash_words(words)[0]) if words else np.zeros(0, U64)


def _isin(x: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(x), bool)
    i = np.searchsorted(among, x)
    return among[np.minimum(i, len(among) - 1)] == x


def canonical(texts, names: np.ndarray, units: np.ndarray):
    """Word hashes, canonical hashes, slot flags and offsets of the texts."""
    h, off, st, en, joined = H.hash_words(texts, spans=True)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    digit = np.concatenate([[0], np.cumsum((codes >= 48) & (codes <= 57))])
    number = (digit[en] - digit[st]) == (en - st)
    name, unit = _isin(h, names), _isin(h, units)
    c = np.where(number, _NUMBER, np.where(name, _NAME, np.where(unit, _UNIT, h)))
    return h, c, number | name | unit, off


def _windows(column: str, window: int, names: list[str], wanted, blocks: int):
    """Rows (id, at, tmpl, slots) of the windows whose template is wanted; all of them if wanted is None."""

    def run(frames):
        nm, un = _word_hashes(names), _word_hashes(UNITS)
        for f in H.batches(frames, column):
            h, c, slot, off = canonical(f[column].tolist(), nm, un)
            g = H.windows(c, window)
            if not len(g):
                continue
            doc = np.repeat(np.arange(len(f)), np.diff(off))
            ok = doc[: len(g)] == doc[window - 1 :]
            if wanted is not None:
                ok &= bitmap.has(wanted.value, g.view(np.int64), blocks)
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            grid = at[:, None] + np.arange(window)
            slots = np.where(slot[grid], h[grid], U64(0)).view(np.int64)
            yield pd.DataFrame({"id": f["id"].to_numpy()[doc[at]], "at": at - off[doc[at]], "tmpl": g[at].view(np.int64), "slots": list(slots)})

    return run


def slot_kinds(hits: DataFrame) -> DataFrame:
    """hits (id, item_id, copy, slots, item_slots): (id, item_id, kind) of the pairs with a verbatim window or a copy
    whose slots are consistent."""
    verbatim = hits.where("slots = item_slots").select("id", "item_id").distinct()
    pairs = hits.select("id", "item_id", "copy", F.explode(F.arrays_zip("slots", "item_slots")).alias("x")).where("x.slots <> 0")
    pairs = pairs.select("id", "item_id", "copy", F.col("x.slots").alias("x"), F.col("x.item_slots").alias("y")).distinct()
    one = pairs.groupBy("id", "item_id", "copy").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("x").alias("nx"), F.countDistinct("y").alias("ny"), F.max(F.col("x") != F.col("y")).alias("other"))
    copies = one.where("other and n = nx and n = ny").select("id", "item_id").distinct()
    return verbatim.withColumn("kind", F.lit("verbatim")).unionByName(copies.join(verbatim, ["id", "item_id"], "left_anti").withColumn("kind", F.lit("reparameterised")))


def leaked_items(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, window: int = 15, blocks: int = 1 << 23, max_broadcast: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id, kind) with kind 'verbatim' or 'reparameterised'; a pair that is both is verbatim.

    blocks: of the bitmap, a power of two. Up to max_broadcast item windows are broadcast, more are joined by a shuffle.
    """
    spark = docs.sparkSession
    it = items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).cast("string").alias("text")).where("text is not null and id is not null")
    d = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where("text is not null and id is not null")
    names = item_names(it, "text")
    schema = "id long, at int, tmpl long, slots array<long>"
    of_items = durable(it.mapInPandas(_windows("text", window, names, None, blocks), schema).distinct())
    wanted = spark.sparkContext.broadcast(bitmap.of_keys(of_items.select(F.col("tmpl").alias("k")), blocks))
    of_docs = d.mapInPandas(_windows("text", window, names, wanted, blocks), schema)
    right = of_items.withColumnsRenamed({"id": "item_id", "slots": "item_slots", "at": "item_at"})
    hits = of_docs.join(bounded_broadcast(right, right.count(), max_broadcast), "tmpl").select("id", "item_id", (F.col("at") - F.col("item_at")).alias("copy"), "slots", "item_slots")
    return slot_kinds(durable(hits)).select(F.col("id").alias("doc_id"), "item_id", "kind")
