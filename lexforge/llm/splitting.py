"""Splitting oversized items at natural boundaries, by dynamic programming over boundary positions.

A text longer than `limit` is cut at positions c1 < c2 < ...; piece i is text[c(i-1) - overlap : c(i)], so
consecutive pieces share exactly `overlap` characters and no piece is longer than the limit. Among all ways to
cut, the one with the least sum of cut penalties (paragraph, list item, sentence, word, none) and of squared
differences from the even size is taken. Word ends are candidates only where natural boundaries lie further
apart than a quarter of a piece, and plain character positions only where no word ends either; both rules
keep the program linear in the text and always leave a way. All texts are cut whole.

Defined cases: null, empty and short texts are not cut and give no pieces; a text of exactly the limit is
short; a text without any blank is cut at characters; rows repeated under one key are cut once if asked so;
an empty table gives no rows; extra columns are ignored. Lengths are code points.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Cut penalties (fixed values).
PARAGRAPH, ITEM, SENTENCE, WORD, NONE = 0.0, 0.1, 0.25, 1.5, 4.0
_KINDS = [
    (re.compile(r"\n[ \t]*\n+\s*"), PARAGRAPH),
    (re.compile(r"\n(?=\s*(?:\(?[0-9a-z]{1,4}[.)]|[-•–—])\s)|\r?\n(?=Article|ANNEX)"), ITEM),
    (re.compile(r"[;:]\s+(?=\(?[0-9a-z]{1,4}[.)]\s)"), ITEM),
    (re.compile(r"[.!?][\"'”’)\]]*\s+(?=[^\sa-zà-ÿ])"), SENTENCE),
]
_WORD_END = re.compile(r"\s+")


def boundaries(text: str, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a piece may end, in order, with their penalties; the end of the text is the last."""
    n, cost = len(text), {}
    for pattern, c in _KINDS:
        for m in pattern.finditer(text):
            if 0 < m.end() < n:
                cost[m.end()] = min(c, cost.get(m.end(), NONE))
    natural = sorted(cost) + [n]
    at = 0
    for nxt in natural:
        if nxt - at > gap:
            prev = at
            for m in _WORD_END.finditer(text, at, nxt):
                e = m.end()
                if at < e < nxt:
                    while e - prev > gap:  # no blank for long: plain characters
                        prev += gap
                        cost.setdefault(prev, NONE)
                    cost.setdefault(e, WORD)
                    prev = e
            while nxt - prev > gap:
                prev += gap
                cost.setdefault(prev, NONE)
        at = nxt
    places = np.array(sorted(cost) + [n], np.int64)
    return places, np.array([cost[p] for p in places[:-1].tolist()] + [0.0])


def cut(text: str, limit: int, overlap: int) -> list[int]:
    """The ends of the pieces of text, the last being its length."""
    n, step = len(text), limit - overlap
    if n <= limit:
        return [n]
    places, penalty = boundaries(text, max(1, step // 4))
    even = n / -(-(n - overlap) // step)
    m = len(places)
    best, back = np.full(m, np.inf), np.full(m, -1, np.int64)
    lo = np.searchsorted(places, places - step, "left")
    for j in range(m):
        e = int(places[j])
        if e <= limit:
            best[j] = penalty[j] + 1 + ((e - even) / step) ** 2
        i = int(lo[j])
        if i < j:
            c = best[i:j] + ((e - places[i:j] - even) / step) ** 2
            k = int(np.argmin(c))
            if c[k] + 1 + penalty[j] < best[j]:
                best[j], back[j] = c[k] + 1 + penalty[j], i + k
    ends, j = [], m - 1
    while j >= 0:
        ends.append(int(places[j]))
        j = int(back[j])
    return ends[::-1]


def _pieces(limit: int, overlap: int):
    def run(frames):
        for f in frames:
            out: dict[str, list] = {c: [] for c in ("key", "piece", "pieces", "start", "text")}
            for key, text in zip(f["key"], f["text"]):
                ends = cut(text, limit, overlap)
                starts = [0] + [e - overlap for e in ends[:-1]]
                out["key"] += [key] * len(ends)
                out["piece"] += range(1, len(ends) + 1)
                out["pieces"] += [len(ends)] * len(ends)
                out["start"] += starts
                out["text"] += [text[s:e] for s, e in zip(starts, ends)]
            if out["key"]:
                yield pd.DataFrame(out)

    return run


def split_oversized(df: DataFrame, key: str, text: str, limit: int, overlap: int = 100, once: bool = True) -> DataFrame:
    """(key, piece, pieces, start, text) of every text longer than the limit; piece counts from 1."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be less than limit")
    src = df.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    src = src.where((F.length("text") > limit) & F.col("key").isNotNull())
    if once:
        src = src.groupBy("key").agg(F.min("text").alias("text"))
    return src.mapInPandas(_pieces(limit, overlap), "key string, piece int, pieces int, start int, text string")
