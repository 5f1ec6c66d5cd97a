"""Noise in text from scanned pages: cut words, misread characters, running headings, page numbers.

1. One pass counts all words, all compounds written with a hyphen, and the templates of short lines (numbers
   as #) with how often a line breaks into a sentence. Words that make up the share `least` of all words are the lexicon;
   templates that mostly break into sentences and whose words hardly occur elsewhere are running headings.
2. Every word of the counts, rare or not, is linked to the lexicon words that plausible glyph edits (GLYPHS, at most
   `max_edits`) turn it into and that are `ratio` times as frequent.
3. A second pass counts skip-grams (two words either side) of lexicon words and of words with such a link, against the
   `dims_words` most frequent words. Among the latter their shifted positive PMI matrix, which skip-gram training with
   negative sampling factorises, is factorised into word vectors by a seeded randomised SVD; the vector of any other word is
   the sum of the vectors it stands among, over all rows. A word is misread if it stands in contexts like those of a word
   it is linked to (cosine of at least `alike`), and is corrected to the one whose contexts are most alike; a word that
   only looks like another one is left alone.
4. Furniture lines are removed, words cut at line ends joined unless the compound with the hyphen is the known
   word, misread words corrected, lines reflowed into paragraphs.

What was decided about words stays a table: records are first examined for words that may be misread, these are joined to
it, and only damaged records are read again to be repaired.

Bounds: a word is in the lexicon if it makes up `least` of all words, so by counting there are at most 1 / `least` such
words (two million; natural language has some 100,000) and no other cap; vectors `dims_words` x 32. Counts, links and
contexts cover every row; running headings are decided by Spark, all of them.

Defined cases: null keys are no records; null, empty and blank texts hold no noise; rows repeated under one key
give one result; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.bloom import may_contain
from ..session import durable, salted_join

#: What a page reader makes of a glyph, and the glyph (fixed values).
GLYPHS = [
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "b"), ("8", "b"), ("9", "g"), ("2", "z"), ("|", "l"), ("!", "l"), ("i", "l"), ("l", "i"),
    ("c", "e"), ("e", "c"), ("f", "t"), ("t", "f"), ("b", "h"), ("h", "b"), ("n", "u"), ("u", "n"), ("q", "g"), ("v", "y"), ("y", "v"), ("a", "o"), ("o", "a"),
    ("rn", "m"), ("m", "rn"), ("m", "in"), ("n", "ri"), ("ri", "n"), ("in", "m"), ("ii", "u"), ("u", "ii"), ("d", "cl"), ("cl", "d"), ("vv", "w"), ("w", "vv"), ("li", "h"), ("h", "li"), ("lc", "k"), ("nn", "m"),
    ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl"),
]
HYPHENS = "-‐­¬"
#: A line with only a page number, marks or "page" words around it (fixed pattern).
PAGE = re.compile(r"^[\s\-–—|\[\](){}<>.·•*_~=/]*(?:(?:page|pages|pag|pagina|página|seite|blz|bladzijde|p|pp|s|pg)\b[\s.:]*)?\d{1,5}(?:\s*(?:/|of|de|von|van|di|sur)\s*\d{1,5})?[\s\-–—|\[\](){}<>.·•*_~=/]*$", re.I)
BARE = re.compile(r"^\s*\d+(?:[.,]\d+)*\s*$")
_ROW = re.compile(r"^\d{2,}\s+[^\d\s]")
WORD = re.compile(r"[^\W_]+")
_APART = re.compile(r"[^\w-]+|_")
_CUT = re.compile(rf"(\S*[^\W\d_])[{HYPHENS}]$")
_START = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
_LETTER = re.compile(r"[^\W\d_]")
_STOP = tuple(".:;!?")


def template(line: str) -> str:
    return re.sub(r"\s+", " ", _DIGITS.sub("#", line)).strip()


def _count(frames):
    tokens, lines, breaks = Counter(), Counter(), Counter()

    def flush():
        words, compounds = Counter(), Counter()
        for t, n in tokens.items():
            if t[-1] in HYPHENS and len(t) > 1:
                continue
            t = t.replace("­", "").lower()
            for w in WORD.findall(t):
                words[w] += n
            if "-" in t or "‐" in t:
                for c in _APART.split(t.replace("‐", "-")):
                    c = c.strip("-")
                    if "-" in c and "--" not in c:
                        compounds[c] += n
        for kind, c in (("w", words), ("c", compounds)):
            if c:
                yield pd.DataFrame({"kind": kind, "x": list(c), "n": list(c.values()), "m": 0})
        if lines:
            yield pd.DataFrame({"kind": "t", "x": list(lines), "n": list(lines.values()), "m": [breaks[k] for k in lines]})
        for c in (tokens, lines, breaks):
            c.clear()

    for f in frames:
        for text in f["text"]:
            if not text:
                continue
            tokens.update(text.split())
            if "\n" in text:
                ls = [x.strip() for x in text.split("\n")]
                for i in range(1, len(ls)):
                    s = ls[i]
                    if s and len(s) <= 90 and not s[0].islower() and _LETTER.search(s) and not PAGE.match(s):
                        t = template(s)
                        lines[t] += 1
                        prev = next((x for x in reversed(ls[max(0, i - 3) : i]) if x and not PAGE.match(x)), "")
                        nxt = next((x for x in ls[i + 1 : i + 4] if x and not PAGE.match(x)), "")
                        if prev and nxt and prev[-1] not in _STOP and nxt[0].islower():
                            breaks[t] += 1
        if len(tokens) > 400_000 or len(lines) > 200_000:
            yield from flush()
    yield from flush()


class Lexicon:
    """Words and compounds with their counts, running headings, glyph edits and word vectors."""

    def __init__(self, words: dict[str, int], compounds: dict[str, int], headings: set[str], max_edits: int = 2):
        self.words, self.compounds, self.headings, self.max_edits = words, compounds, headings, max_edits
        self.edits: dict[str, list[str]] = {}
        for wrong, right in GLYPHS:
            self.edits.setdefault(wrong[0], []).append((wrong, right))
        self.cache: dict[str, list[str]] = {}

    def _once(self, w: str):
        for i, ch in enumerate(w):
            for wrong, right in self.edits.get(ch, ()):
                if w.startswith(wrong, i):
                    yield w[:i] + right + w[i + len(wrong) :]
            if ord(ch) > 127:
                base = unicodedata.normalize("NFD", ch)[0]
                if base != ch:
                    yield w[:i] + base + w[i + 1 :]

    def neighbours(self, w: str, least: float = 0) -> list[str]:
        """Lexicon words with more than `least` occurrences that the fewest plausible glyph edits turn w into, most frequent first."""
        seen, layer = {w}, [w]
        for _ in range(self.max_edits):
            nxt = []
            for x in layer:
                for y in self._once(x):
                    if y not in seen:
                        seen.add(y)
                        nxt.append(y)
            hit = [y for y in nxt if self.words.get(y, 0) > least]
            if hit:
                return sorted(hit, key=lambda y: (-self.words[y], y))
            layer = nxt
        return []

    def links(self, w: str, least: float = 0) -> list[str]:
        """The neighbours that a word of letters may be a misread form of."""
        letters = sum(ch.isalpha() for ch in w)
        if not 3 <= len(w) <= 40 or letters < 2 or letters * 2 <= len(w):
            return []
        return [y for y in self.neighbours(w, least) if len(y) >= 4 or len(y) == len(w) == 3 and self.words[y] >= 1000]

    def suspect(self, w: str) -> list[str]:
        """The links of a word outside the lexicon, kept for the next time."""
        if w in self.words:
            return []
        c = self.cache.get(w)
        if c is None:
            if len(self.cache) > 200_000:
                self.cache.clear()
            c = self.cache[w] = self.links(w)
        return c

    def misread(self, w: str) -> str | None:
        """The most frequent word that lower-case w may be a misread form of, or None."""
        c = self.suspect(w)
        return c[0] if c else None

    def is_cut(self, left: str, right: str, before: str) -> bool:
        """Whether left + right is a word cut in two, and not a compound cut at its own hyphen.
        before: the whole token that ends in left, with any hyphens of its own."""
        joined = self.words.get(left + right, 0)
        whole = max((self.compounds.get(x, 0) for x in ((WORD_TAIL.search(before) or [before])[0] + "-" + right, left + "-" + right)), default=0)
        if joined or whole:
            return joined > whole
        fixed = self.misread(left + right)
        l2, r2 = self.misread(left) or left, self.misread(right) or right
        if self.compounds.get(l2 + "-" + r2):
            return False
        return bool(fixed) or not (l2 in self.words and r2 in self.words)


WORD_TAIL = re.compile(r"[^\W_]+(?:[-‐][^\W_]+)*$")


def _template_words(frames):
    """Of each template (x, n) its words of four letters and more, as often as they stand in it."""
    for f in frames:
        got = [(x, w, n) for x, n in zip(f["x"], f["n"].tolist()) for w in WORD.findall(x.lower()) if len(w) >= 4 and not w.isdigit()]
        if got:  # an empty column of strings does not pass Arrow
            yield pd.DataFrame(got, columns=["x", "w", "n"])


def _links(model, ratio: float):
    """Of word counts (x, n) the rows (w, n, y): a word and one it may be a misread form of."""

    def run(frames):
        lex: Lexicon = model.value
        for f in frames:
            got = [(w, n, y) for w, n in zip(f["x"], f["n"].tolist()) for y in (lex.links(w, n * ratio) if _LETTER.search(w) else ())]
            if got:
                yield pd.DataFrame(got, columns=["w", "n", "y"])

    return run


def _contexts(model, top: list[str]):
    """Rows (w, c, n): how often a word of the lexicon, or one with links, stands within two words of the c-th most frequent."""

    def run(frames):
        lex: Lexicon = model.value
        index, v = {w: i for i, w in enumerate(top)}, len(top)
        names: list[str] = []
        tokens: dict[str, tuple[int, int]] = {}
        own: dict[str, int] = {}
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def look(t: str) -> tuple[int, int]:
            w = (WORD.findall(t.lower()) or [""])[-1]
            if w and w not in own and (w in lex.words or lex.suspect(w)):
                own[w] = len(names)
                names.append(w)
            return index.get(w, -1), own.get(w, -1)

        def merged():
            k = np.concatenate([p[0] for p in parts])
            n = np.concatenate([p[1] for p in parts])
            k, at = np.unique(k, return_inverse=True)
            return k, np.bincount(at, weights=n).astype(np.int64)

        def flush():
            k, n = merged()
            yield pd.DataFrame({"w": np.array(names, object)[k // v], "c": (k % v).astype(np.int32), "n": n})

        for f in frames:
            got: list[tuple[int, int]] = []
            for text in f["text"]:
                if text:
                    ts = text.split()
                    for t in set(ts).difference(tokens):
                        tokens[t] = look(t)
                    got += map(tokens.__getitem__, ts)
                    got += ((-1, -1), (-1, -1))
            if not got:
                continue
            x, y = np.asarray(got, np.int64).T
            for step in (1, 2):
                for a, b in ((y[:-step], x[step:]), (y[step:], x[:-step])):
                    ok = (a >= 0) & (b >= 0)
                    parts.append(np.unique(a[ok] * v + b[ok], return_counts=True))
            if sum(len(p[0]) for p in parts) > 2_000_000:
                parts = [merged()]
            if len(tokens) > 500_000 or sum(len(p[0]) for p in parts) > 1_500_000:
                if len(parts):
                    yield from flush()
                parts, names = [], []
                tokens.clear()
                own.clear()
        if parts and sum(len(p[0]) for p in parts):
            yield from flush()

    return run


def _vectors(m: np.ndarray, dims: int) -> np.ndarray:
    """Unit vectors of words from their counts of skip-grams with each other."""
    v = len(m)
    m = (m + m.T) / 2
    each = m.sum(axis=1) + 1e-9
    with np.errstate(divide="ignore"):
        a = np.maximum(np.log(m * m.sum() / np.outer(each, each**0.75 * (each.sum() / (each**0.75).sum()))), 0)
    a[~np.isfinite(a)] = 0
    q = np.random.default_rng(11).standard_normal((v, min(v, dims + 8)))
    for _ in range(4):
        q, _ = np.linalg.qr(a @ q)
    u, s, _ = np.linalg.svd(q.T @ a, full_matrices=False)
    vec = (q @ u)[:, :dims] * np.sqrt(s[:dims])
    return (vec / np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _sums(vectors: np.ndarray):
    """Of rows (w, cs, ns) the rows (w, vec): the unit vector of the contexts of w."""

    def run(frames):
        for f in frames:
            out = []
            for cs, ns in zip(f["cs"], f["ns"]):
                x = np.asarray(ns, np.float64) @ vectors[np.asarray(cs, np.int64)]
                out.append((x / max(float(np.linalg.norm(x)), 1e-9)).tolist())
            if len(f):
                yield pd.DataFrame({"w": f["w"].to_numpy(), "vec": out})

    return run


class Model:
    """The lexicon, and the table (w, fix) of misread words."""

    def __init__(self, lexicon: Lexicon, fixes: DataFrame):
        self.lexicon, self.fixes = lexicon, fixes


def fit(texts: DataFrame, least: float = 5e-7, ratio: float = 1.0, alike: float = 0.2, dims_words: int = 1024, dims: int = 32) -> Model:
    """The model over all rows of texts (text). least: the share of all words from which on a word is in the lexicon;
    ratio: how many times as frequent a word must be to correct another one; alike: the least cosine of their contexts."""
    spark = texts.sparkSession
    c = texts.mapInPandas(_count, "kind string, x string, n long, m long")
    c = durable(c.groupBy("kind", "x").agg(F.sum("n").alias("n"), F.sum("m").alias("m")))
    total = c.where("kind = 'w'").agg(F.sum("n")).first()[0] or 0
    floor = max(5, int(total * least))
    pdf = c.where((F.col("kind") != "t") & (F.col("n") >= floor)).toArrow().to_pandas()
    words, compounds = (dict(zip(p["x"], p["n"].tolist())) for p in (pdf[pdf["kind"] == "w"], pdf[pdf["kind"] == "c"]))
    # headings: templates that break into sentences, with words of their own
    often = c.where("kind = 't' and n >= 5 and m >= 3 and m >= 0.15 * n").select("x", "n")
    ws = durable(often.mapInPandas(_template_words, "x string, w string, n long"))
    inside = ws.groupBy("w").agg(F.sum("n").alias("inside")).join(c.where("kind = 'w'").select(F.col("x").alias("w"), F.col("n").alias("all")), "w", "left")
    own = inside.select("w", (F.col("inside") >= 0.7 * F.coalesce("all", F.lit(0))).alias("own"))
    headings = salted_join(ws, own, "w").groupBy("x").agg(F.count_if("own").alias("k"), F.count(F.lit(1)).alias("n")).where("2 * k >= n")
    headings = {r["x"] for r in headings.select("x").collect()}
    lex = Lexicon(words, compounds, headings)
    shared = spark.sparkContext.broadcast(lex)
    # a word of the lexicon needs a far more frequent neighbour to be in doubt at all
    need = F.when(F.col("n") >= floor, F.lit(max(20.0, ratio))).otherwise(F.lit(ratio))
    links = c.where("kind = 'w'").select("x", "n").mapInPandas(_links(shared, ratio), "w string, n long, y string")
    known = c.where((F.col("kind") == "w") & (F.col("n") >= floor)).select(F.col("x").alias("y"), F.col("n").alias("ny"))
    links = durable(links.join(known, "y").where(F.col("ny") >= need * F.col("n")).where((F.col("n") < floor) | (F.length("w") >= 4)))
    top = sorted((w for w in words if _LETTER.search(w)), key=lambda w: (-words[w], w))[:dims_words]
    counts = texts.mapInPandas(_contexts(shared, top), "w string, c int, n long")
    counts = durable(counts.groupBy("w", "c").agg(F.sum("n").alias("n")))
    place = {w: i for i, w in enumerate(top)}
    m = np.zeros((len(top), len(top)))
    got = counts.where(F.col("w").isin(top)).toArrow().to_pandas() if len(top) > 1 else pd.DataFrame({"w": [], "c": [], "n": []})  # at most dims_words x dims_words
    m[[place[w] for w in got["w"]], got["c"].to_numpy(np.int64)] = got["n"]
    vectors = _vectors(m, dims) if len(top) > 1 else np.zeros((len(top), dims), np.float32)
    each = counts.groupBy("w").agg(F.collect_list("c").alias("cs"), F.collect_list("n").alias("ns")).mapInPandas(_sums(vectors), "w string, vec array<float>")
    each = durable(each)
    j = links.join(each.withColumnRenamed("vec", "vw"), "w", "left").join(each.select(F.col("w").alias("y"), F.col("vec").alias("vy")), "y", "left")
    dot = F.aggregate(F.zip_with("vw", "vy", lambda a, b: (a * b).cast("double")), F.lit(0.0), lambda a, x: a + x)
    near = F.coalesce(dot, F.lit(1.0))  # a word without any known word around it: edits and counts alone
    fixes = j.where(near >= alike).groupBy("w").agg(F.max_by("y", F.struct(near.alias("near"), F.col("ny"), F.col("y"))).alias("fix"))
    fixes = durable(fixes)
    wrong = known.select(F.col("y").alias("w")).join(fixes, "w", "left_semi").collect()  # words of the lexicon
    for r in wrong:
        del words[r["w"]]
    return Model(Lexicon(words, compounds, headings), fixes)


def furniture(lines: list[str], lex: Lexicon) -> list[str | None]:
    """Of each stripped line: 'page_number', 'header' or None."""
    kind: list[str | None] = [None] * len(lines)
    full = [i for i, s in enumerate(lines) if s]
    for j, i in enumerate(full):
        s = lines[i]
        if len(s) <= 100 and not s[0].islower() and template(s) in lex.headings:
            kind[i] = "header"
    for j, i in enumerate(full):
        s = lines[i]
        if kind[i] or len(s) > 40 or not PAGE.match(s):  # longer than any page line
            continue
        if BARE.match(s):
            near = [full[x] for x in (j - 1, j + 1) if 0 <= x < len(full)]
            if any(kind[x] != "header" and (BARE.match(lines[x]) or _ROW.match(lines[x])) for x in near):
                continue  # one of a list of numbers or codes
            if len(s) > 3 and not (len(near) == 2 and lines[near[0]][-1] not in _STOP and lines[near[1]][0].islower()):
                continue
        kind[i] = "page_number"
    return kind


_BLOCK = re.compile(r"^(?:Article\b|ANNEX\b|\(?[0-9a-z]{1,4}[.)]\s|[-•–—]\s|HAS |HAVE |#)")


def tidy(text: str, lex: Lexicon) -> tuple[set[str], str]:
    """The kinds of noise between the words of a text, and the text without furniture and cuts, as paragraphs."""
    kinds: set[str] = set()
    if "\n" not in text:
        return kinds, text
    lines = [x.strip() for x in text.replace("\r\n", "\n").replace("\r", "\n").split("\n")]
    kept, some = [], False
    for s, k in zip(lines, furniture(lines, lex)):
        if k != "header" or some:
            kinds.update([k] if k else [])
        kept.append(None if k else s)
        some = some or (bool(s) and not k)
    out: list[str] = []
    gap = False  # furniture was between
    for s in kept:
        if s is None:
            gap = True
            continue
        if not s:
            if out and out[-1] != "" and not (gap and out[-1][-1] in HYPHENS):
                out.append("")
            continue
        if out and out[-1]:
            cut = _CUT.search(out[-1].rpartition(" ")[2]) if out[-1][-1] in HYPHENS else None
            start = _START.match(s)
            if cut and start and s[0].islower():
                before = cut.group(1)
                left = WORD.findall(before)[-1].lower()
                if lex.is_cut(left, start.group().lower(), before.lower()):
                    kinds.add("hyphenation")
                    out[-1] = out[-1][:-1] + s
                else:
                    out[-1] += s
                gap = False
                continue
            if not (_BLOCK.match(s) and not (gap and out[-1][-1] not in _STOP)):
                out[-1] += " " + s
                gap = False
                continue
        out.append(s)
        gap = False
    return kinds, "\n".join(out)


def suspects(text: str, lex: Lexicon, clean: set[str]) -> set[str]:
    """The words of a text, in small letters, that may be misread. clean: tokens without any, grows."""
    found: set[str] = set()
    for t in set(text.split()) - clean:
        got = {w for w in map(str.lower, WORD.findall(t)) if lex.suspect(w)} if _LETTER.search(t) else ()
        if got:
            found |= got
        else:
            if len(clean) > 300_000:
                clean.clear()
            clean.add(t)
    return found


def corrected(text: str, fixes: dict[str, str]) -> str:
    same_case = lambda w, f: f.capitalize() if w[0].isupper() and not w.isupper() else f.upper() if w.isupper() and len(w) > 1 else f
    return WORD.sub(lambda m: same_case(m.group(), fixes[m.group().lower()]) if m.group().lower() in fixes else m.group(), text)


def _detect(model):
    """Rows (key, noise, w): kinds of noise between words, and every word w that may be misread."""

    def run(frames):
        lex, clean = model.value, set()
        for f in frames:
            keys, kinds, words = [], [], []
            for key, text in zip(f["key"], f["text"]):
                if text:
                    found, whole = tidy(text, lex)
                    doubt = sorted(suspects(whole, lex, clean))
                    keys += [key] * (len(found) + len(doubt))
                    kinds += sorted(found) + ["misread"] * len(doubt)
                    words += [""] * len(found) + doubt
            if keys:  # an empty column of strings does not pass Arrow
                yield pd.DataFrame({"key": keys, "noise": kinds, "w": words})

    return run


def _repair(model):
    def run(frames):
        lex = model.value
        for f in frames:
            if len(f):
                text = [corrected(tidy(t, lex)[1], {p["w"]: p["fix"] for p in ps}) for t, ps in zip(f["text"], f["pairs"])]
                yield pd.DataFrame({"key": f["key"].to_numpy(), "noise": f["noise"].to_numpy(), "text": text})

    return run


def scanned_noise(df: DataFrame, key: str, text: str, repaired: bool = False, model: Model | None = None) -> DataFrame:
    """(key, noise), one row a kind; with repaired one row (key, noise, text) of each damaged record, kinds joined by commas."""
    src = df.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text")).where("key is not null and text is not null")
    model = model or fit(src.select("text"))
    shared = df.sparkSession.sparkContext.broadcast(model.lexicon)
    rows = src.mapInPandas(_detect(shared), "key string, noise string, w string")
    fixes = model.fixes.select("w", "fix")
    if not repaired:
        rows = durable(rows)
        bad = salted_join(rows.where("w <> ''"), fixes, "w", "left_semi").select("key", "noise")
        return rows.where("w = ''").select("key", "noise").unionByName(bad).distinct()
    rows = durable(rows.distinct())
    found = rows.where("w = ''").withColumn("fix", F.lit("")).unionByName(salted_join(rows.where("w <> ''"), fixes, "w").select("key", "noise", "w", "fix"))
    pair = F.when(F.col("w") != "", F.struct("w", "fix"))
    damaged = durable(found.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("noise")), ",").alias("noise"), F.collect_set(pair).alias("pairs")))
    near = may_contain(src, "key", damaged, "key").groupBy("key").agg(F.min("text").alias("text"))
    return near.join(damaged, "key").mapInPandas(_repair(shared), "key string, noise string, text string")
