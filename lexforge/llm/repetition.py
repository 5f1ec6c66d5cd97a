"""Repetition inside a single document, by n-gram perplexity.

A modified Kneser-Ney model gives each word a probability in its context. Its lower orders (bigram and
continuation unigram) are counted by Spark over all documents and held as sorted hash arrays; its top order,
`order`-grams, is the document's own text, with discounts from counts of counts that Spark takes over all
documents, and with the usual cut-off of n-grams seen once, so that nothing foresees itself. Where a document says again what it said before, the top order foresees it, and the perplexity
falls below that of the lower orders alone, whatever the language. Each language has a lower band of the
ratio (of the log-perplexity with the top order to that without, both over the continuation unigram, which
counts different neighbours and so does not learn a phrase that many documents repeat) and one of the
log-perplexity itself (too predictable), and an upper band (too unlikely: broken text). Documents under a lower band are rejected as repetitive;
what share of their n-grams is repeated follows from the top order's types and tokens and is checked exactly.

Where there are at most `max_words` words and `max_bigrams` bigrams, the model goes to the workers as arrays; where
there are more, the same probabilities are worked out by Spark and joined to blocks of documents by the bigrams that
each block has. The scores are the same both ways, and no word or bigram is left out.

Defined cases: null and empty texts and those of fewer than `order` words have no windows, ratio 1 and
share 0, and are never rejected; null or unknown languages form the band 'und'; a language with fewer than
`min_docs` documents takes the band of all; rows repeated under one id are scored each and give one result;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import durable, salted_join
from . import hashing as H

U64 = np.uint64
#: Two-letter codes and their three-letter form (fixed values).
CODES = {"en": "eng", "fr": "fra", "de": "deu", "it": "ita", "nl": "nld", "es": "spa"}


def language(c: Column) -> Column:
    low = F.lower(F.trim(c))
    two = F.element_at(F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv]), low)
    return F.coalesce(two, F.when(F.length(low) == 3, low), F.lit("und"))


def discounts(n1: float, n2: float, n3: float, n4: float) -> np.ndarray:
    """D1, D2, D3+ of modified Kneser-Ney; kept within (0, count) where a count of counts is nought."""
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    d = [i - (i + 1) * y * b / a if a else 0.5 * i for i, (a, b) in enumerate([(n1, n2), (n2, n3), (n3, n4)], 1)]
    return np.array([min(max(x, 0.05 * i), i - 0.05) for i, x in enumerate(d, 1)])


def _document_grams(h: np.ndarray, off: np.ndarray, k: int):
    """Of each place with a k-gram: its document, the number of its k-gram and of its context."""
    g, ctx = H.windows(h, k), H.windows(h, k - 1)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    at = np.flatnonzero(doc[: len(g)] == doc[k - 1 :]) if len(g) else np.zeros(0, np.int64)
    d = doc[at]
    salt = H.mix(d.astype(U64) + U64(1))
    _, first, gi, gn = np.unique(g[at] ^ salt, return_index=True, return_inverse=True, return_counts=True)
    _, ci, cn = np.unique(ctx[at] ^ salt, return_inverse=True, return_counts=True)
    return at, d, first, gi, gn, ci, cn


def _count(order: int):
    """Pre-aggregated bigram counts (kind 2: a, b, n) and counts of counts of the top order (kind 0: a, n)."""

    def merge(parts):
        a, b, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
        o = np.lexsort((b, a))
        a, b, n = a[o], b[o], n[o]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        at = np.flatnonzero(new)
        return a[at], b[at], np.add.reduceat(n, at) if len(at) else n

    def run(frames):
        parts, held, classes = [], 0, np.zeros(5, np.int64)
        for f in H.batches(frames, "text"):
            h, off = H.hash_words(f["text"].tolist())
            if len(h) < 2:
                continue
            doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
            ok = doc[1:] == doc[:-1]
            part = merge([(h[:-1][ok], h[1:][ok], np.ones(ok.sum(), np.int64))])
            parts.append(part)
            held += len(part[0])
            *_, gn, _, _ = _document_grams(h, off, order)
            classes += np.bincount(np.minimum(gn, 5), minlength=6)[1:]
            if held > 1_500_000:
                parts = [merge(parts)]
                held = len(parts[0][0])
                if held > 1_000_000:
                    yield pd.DataFrame({"kind": 2, "a": parts[0][0].view(np.int64), "b": parts[0][1].view(np.int64), "n": parts[0][2]})
                    parts, held = [], 0
        if parts:
            a, b, n = merge(parts)
            yield pd.DataFrame({"kind": 2, "a": a.view(np.int64), "b": b.view(np.int64), "n": n})
        yield pd.DataFrame({"kind": 0, "a": np.arange(1, 6), "b": 0, "n": classes})

    return run


class Model:
    """Sorted hash arrays of a modified Kneser-Ney bigram model, and the discounts of the top order."""

    def __init__(self, top: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray, low: np.ndarray):
        self.top = np.array([1.0, top[1], top[2]])  # seen once: all of it goes to the lower order
        words = np.unique(b)
        self.words = words if len(words) else np.zeros(1, U64)
        v = self.size = len(self.words) + 1  # the last stands for all other words
        ia, ib = self.ids(a), self.ids(b)
        cont = np.bincount(ib, minlength=v).astype(float)  # number of different words before
        self.unigram = (cont + 0.5) / (cont.sum() + 0.5 * v)
        d = low[np.minimum(n, 3) - 1] if len(n) else np.zeros(0)
        total = np.bincount(ia, weights=n, minlength=v)
        self.gamma = np.where(total > 0, np.bincount(ia, weights=d, minlength=v) / np.maximum(total, 1), 1.0)
        code = ia * v + ib
        known, at = np.unique(code, return_inverse=True)
        self.codes = known if len(known) else np.zeros(1, np.int64)
        self.mass = np.bincount(at, weights=(n - d) / total[ia]) if len(known) else np.zeros(1)

    def ids(self, h: np.ndarray) -> np.ndarray:
        i = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[i] == h, i, len(self.words))

    def lower(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        code = before * self.size + word
        i = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[i] == code, self.mass[i], 0) + self.gamma[before] * self.unigram[word]


def _counts(docs: DataFrame, order: int) -> tuple[DataFrame, np.ndarray, np.ndarray, int]:
    """(a, b, n) of all bigrams of docs (text), the discounts of the top order and of the bigrams, and the number of bigrams."""
    counted = docs.mapInPandas(_count(order), "kind int, a long, b long, n long")
    counted = durable(counted.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")))
    top = {r["a"]: r["n"] for r in counted.where("kind = 0").collect()}
    grams = counted.where("kind = 2")
    sizes = grams.agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in range(1, 5)], F.count(F.lit(1)).alias("all")).first()
    low = discounts(*[sizes[f"n{i}"] for i in range(1, 5)])
    return grams.select("a", "b", "n"), discounts(*[top.get(i, 0) for i in range(1, 5)]), low, sizes["all"]


def _fit(grams: DataFrame, top: np.ndarray, low: np.ndarray) -> Model:
    pdf = grams.toArrow().to_pandas()
    u = lambda c: pdf[c].to_numpy(np.int64).view(U64)
    return Model(top, u("a"), u("b"), pdf["n"].to_numpy(np.int64), low)


def _scored(f: pd.DataFrame, order: int, top: np.ndarray, look) -> pd.DataFrame:
    """The scores of a batch. look(before, word): of hashes of neighbours, the lower orders' probability and the unigram's."""
    h, off = H.hash_words(f["text"].tolist())
    at, d, first, gi, gn, ci, cn = _document_grams(h, off, order)
    nd = len(f)
    tokens = np.bincount(d, minlength=nd)
    types = np.bincount(d[first], minlength=nd)
    low, one = look(h[at + order - 2], h[at + order - 1])
    dg = top[np.minimum(gn, 3) - 1]
    spare = np.bincount(ci[first], weights=dg, minlength=len(cn))  # the discounts taken in each context
    seen, rest = (gn - dg)[gi] / cn[ci], spare[ci] / cn[ci]
    p = seen + rest * low
    over = lambda x: np.bincount(d, weights=-np.log(x), minlength=nd)
    ratio = over(seen + rest * one) / np.maximum(over(one), 1e-9)
    lp = over(p) / np.maximum(tokens, 1)
    lq = over(low) / np.maximum(tokens, 1)
    return pd.DataFrame(
        {"doc_id": f["doc_id"].to_numpy(), "lang": f["lang"].to_numpy(), "words": np.diff(off), "windows": tokens,
         "log_ppl": lp, "log_ppl_corpus": lq, "ratio": np.where(tokens > 0, ratio, 1.0),
         "share": np.where(tokens > 0, 1 - types / np.maximum(tokens, 1), 0.0)}
    )


def _score(model, order: int):
    def run(frames):
        m: Model = model.value

        def look(before, word):
            ids = m.ids(word)
            return m.lower(m.ids(before), ids), m.unigram[ids]

        for f in H.batches(frames, "text"):
            yield _scored(f, order, m.top, look)

    return run


def _code(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return H.mix(a * U64(0x9E3779B97F4A7C15) + H.mix(b))


def _probabilities(grams: DataFrame, low: np.ndarray, n_grams: int, n_words: int) -> DataFrame:
    """(a, b, low, one) of every bigram, as Model has them: contexts that never follow a word are one context."""
    words = durable(grams.groupBy("b").agg(F.count(F.lit(1)).alias("cont")))
    d = F.when(F.col("n") == 1, float(low[0])).when(F.col("n") == 2, float(low[1])).otherwise(float(low[2]))
    g = salted_join(grams, words.select(F.col("b").alias("a"), F.lit(True).alias("known")), "a", "left")
    g = durable(g.select("a", "b", F.when(F.col("known"), F.col("a")).otherwise(F.lit(0)).alias("ctx"), "n", d.alias("d")))
    total = g.groupBy("ctx").agg(F.sum("n").alias("total"), F.sum("d").alias("spare"))
    kept = g.groupBy("ctx", "b").agg(F.sum(F.col("n") - F.col("d")).alias("kept"))
    g = salted_join(g.select("ctx", "a", "b").join(kept, ["ctx", "b"]), total, "ctx")
    g = salted_join(g, words, "b")
    one = (F.col("cont") + 0.5) / (n_grams + 0.5 * (n_words + 1))
    return g.select("a", "b", (F.col("kept") / F.col("total") + F.col("spare") / F.col("total") * one).alias("low"), one.alias("one"))


def _block_bigrams(frames):
    for f in H.batches(frames, "text"):
        h, off = H.hash_words(f["text"].tolist())
        doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
        ok = doc[1:] == doc[:-1]
        d = pd.DataFrame({"block": f["block"].to_numpy()[doc[:-1][ok]], "a": h[:-1][ok].view(np.int64), "b": h[1:][ok].view(np.int64)}) if len(h) > 1 else None
        if d is not None and len(d):
            yield d.drop_duplicates()


def _score_blocks(docs: DataFrame, probabilities: DataFrame, top: np.ndarray, order: int, schema: str, chars: int = 2_000_000) -> DataFrame:
    """Scores with the bigrams of each block of documents (about `chars` characters) joined to it."""
    n = int((docs.agg(F.sum(F.length("text"))).first()[0] or 0) // chars) + 1
    d = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)))
    has = d.mapInPandas(_block_bigrams, "block long, a long, b long").distinct()
    has = has.join(probabilities, ["a", "b"]).select("block", "a", "b", "low", "one")

    def score(f, m):
        if not len(f):
            return _scored(f, order, top, lambda x, y: (np.zeros(0), np.zeros(0)))
        u = lambda c: m[c].to_numpy(np.int64).view(U64)
        code = _code(u("a"), u("b"))
        o = np.argsort(code)
        code, low, one = code[o], m["low"].to_numpy(float)[o], m["one"].to_numpy(float)[o]

        def look(before, word):
            i = np.searchsorted(code, _code(before, word))
            return low[i], one[i]

        return pd.concat([_scored(x, order, top, look) for x in H.batches(iter([f]), "text")])

    return d.groupBy("block").cogroup(has.groupBy("block")).applyInPandas(score, schema)


def scores(df: DataFrame, doc_id: str, text: str, lang: str | None = None, order: int = 5, max_words: int = 1 << 20, max_bigrams: int = 4_000_000) -> DataFrame:
    """(doc_id, lang, words, windows, log_ppl, log_ppl_corpus, ratio, share) of each row."""
    code = language(F.col(lang)) if lang else F.lit("und")
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), code.alias("lang"))
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, lang string, words long, windows long, log_ppl double, log_ppl_corpus double, ratio double, share double"
    grams, top, low, n = _counts(docs.select("text"), order)
    words = grams.select("b").distinct().count()
    if n <= max_bigrams and words <= max_words:
        model = df.sparkSession.sparkContext.broadcast(_fit(grams, top, low))
        return docs.mapInPandas(_score(model, order), schema)
    top = np.array([1.0, top[1], top[2]])  # as in Model
    return _score_blocks(docs, _probabilities(grams, low, n, words), top, order, schema)


def bands(scored: DataFrame, width: float = 3.0, least_ratio: float = 0.85, min_docs: int = 30) -> DataFrame:
    """(lang, low_ratio, low_log_ppl, high_log_ppl): the lower bands of the ratio and of the log-perplexity and
    the upper band of the latter, median -/+ width x scaled quartile distance of the language's documents. The band of the
    ratio is at least least_ratio, for a language in which so many documents repeat themselves that they draw its lower
    quartile down."""
    s = scored.where("windows > 0")
    r, p = (F.percentile_approx(c, [0.25, 0.5, 0.75], F.lit(1000)) for c in ("ratio", "log_ppl_corpus"))
    q = [F.count(F.lit(1)).alias("n"), r.alias("r"), p.alias("p")]
    r, p = F.col("r"), F.col("p")
    limits = {
        "low_ratio": F.greatest(r[1] - width * 1.4826 * (r[1] - r[0]), F.lit(least_ratio)),
        "low_log_ppl": p[1] - width * 1.4826 * (p[1] - p[0]),
        "high_log_ppl": p[1] + width * 1.4826 * (p[2] - p[1]),
    }
    each = s.groupBy("lang").agg(*q).select("lang", "n", F.struct(*[c.alias(k) for k, c in limits.items()]).alias("own"))
    everything = s.agg(*q).select(F.struct(*[c.alias(k) for k, c in limits.items()]).alias("all"))
    return each.crossJoin(F.broadcast(everything)).select("lang", F.when(F.col("n") < min_docs, F.col("all")).otherwise(F.col("own")).alias("x")).select("lang", "x.*")


def judge(df: DataFrame, doc_id: str, text: str, lang: str | None = None, order: int = 5, **bounds: int) -> DataFrame:
    """The scores with the band's verdict: 'repetitive', 'unlikely' or 'kept'."""
    s = durable(scores(df, doc_id, text, lang, order, **bounds))
    b = s.join(F.broadcast(bands(s)), "lang", "left")
    verdict = F.when((F.col("windows") > 0) & ((F.col("ratio") < F.col("low_ratio")) | (F.col("log_ppl") < F.col("low_log_ppl"))), "repetitive").when(F.col("log_ppl_corpus") > F.col("high_log_ppl"), "unlikely").otherwise("kept")
    return b.select(*s.columns, verdict.alias("verdict"))


def repetitive(df: DataFrame, doc_id: str, text: str, lang: str | None = None, order: int = 5, min_words: int = 50, min_share: float = 0.25) -> DataFrame:
    """(doc_id) under the lower perplexity band of their language whose share of repeated windows is large."""
    j = judge(df, doc_id, text, lang, order)
    return j.where(f"verdict = 'repetitive' and words >= {min_words} and share >= {min_share}").select("doc_id").distinct()
