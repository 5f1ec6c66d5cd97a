"""Chunked translation with an injected tokenizer and model; no model is shipped. A model is a function from a list
of texts and a strict flag to a list of texts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .quality import repetition

BUDGET, RETRY_BUDGET, MAX_CHARS = 480, 160, 100_000
#: Source languages, and a model name and revision each may be pinned to by the caller.
LANGUAGES = ("fra", "deu", "ita", "nld", "spa")
Tokenize = Callable[[str], list]
Translate = Callable[[list[str], bool], list[str]]


def chunks(text: str, tokenize: Tokenize, budget: int = BUDGET, detokenize: Callable[[list], str] = " ".join) -> list[str]:
    """Paragraphs within the budget as they are, others by sentence, single sentences beyond it cut at tokens; then
    packed greedily."""
    pieces: list[str] = []
    for para in text.split("\n"):
        if not para.strip():
            continue
        if len(tokenize(para)) <= budget:
            pieces.append(para)
            continue
        for s in re.split(r"(?<=[.;])\s+(?=[A-ZÀ-Þ(])", para):
            ts = tokenize(s)
            pieces += [s] if len(ts) <= budget else [detokenize(ts[i : i + budget]) for i in range(0, len(ts), budget)]
    out: list[str] = []
    size = 0
    for p in pieces:
        n = len(tokenize(p))
        if out and size + n <= budget:
            out[-1] += "\n" + p
            size += n
        else:
            out.append(p)
            size = n
    return out


def issue(source: str, output: str | None, document: bool = False) -> str | None:
    """The same rules as the column expression quality.translation_issue, for one pair."""
    s, o = source.strip(), (output or "").strip()
    if not o:
        return "empty_output"
    r = len(o) / max(1, len(s))
    if len(s) >= 20 and len(o) >= 200 and r > 4:
        return "excessive_expansion"
    if len(s) >= 100 and sum(c.isalpha() for c in source) >= 40 and r < 0.25:
        return "severe_contraction"
    if document and len(s) >= 1000 and r > 2.5:
        return "document_expansion"
    if document and len(s) >= 1000 and r < 0.4:
        return "document_contraction"
    words = lambda t: re.findall(r"[^\W_]+(?:['’\-][^\W_]+)*", t.lower())
    return "repetitive_output" if repetition(words(s), words(o)) else None


def translate_text(text: str, tokenize: Tokenize, model: Translate, document: bool = False) -> tuple[str | None, str | None]:
    """(translation, None) or (None, reason): each chunk may be tried once more, strictly and in smaller chunks; one
    that fails again fails the text."""
    out = []
    for c in chunks(text, tokenize):
        got = model([c], False)[0]
        if issue(c, got):
            parts = chunks(c, tokenize, RETRY_BUDGET)
            got = "\n".join(model(parts, True))
            if reason := issue(c, got):
                return None, reason
        out.append(got)
    whole = "\n".join(out)
    reason = issue(text, whole, document)
    return (None, reason) if reason else (whole, None)


def translate_lines(text: str, one: Callable[[str], str]) -> str:
    """Line by line with the line ends kept; blank lines and journal references pass through."""
    return "\n".join(x if not x.strip() or re.match(r"^\(?\d+\)?\s*OJ\s", x.strip()) else one(x) for x in text.split("\n"))


def translate_units(df: DataFrame, key: str, text: str, load: Callable[[], tuple[Tokenize, Translate]], max_chars: int = MAX_CHARS, document: bool = False) -> DataFrame:
    """(key, translation, reason) of each row; load runs once a Python worker. Texts over max_chars (0: none) are left
    with the reason too_long."""
    src = df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).where("length(trim(text)) > 0")

    def run(frames: Iterator[pd.DataFrame]):
        tokenize, model = load()
        for f in frames:
            if len(f):
                r = [(None, "too_long") if max_chars and len(t) > max_chars else translate_text(t, tokenize, model, document) for t in f["text"]]
                yield pd.DataFrame({"key": f["key"].to_numpy(), "translation": [a for a, _ in r], "reason": [b for _, b in r]}, dtype=object)

    return src.mapInPandas(run, "key string, translation string, reason string")


def apply_full_text(works: DataFrame, result: DataFrame) -> DataFrame:
    """A translated full text takes the place of the original, which is kept beside it."""
    j = works.join(result.where("translation is not null").select(F.col("key").alias("celex_id"), "translation"), "celex_id", "left")
    j = j.withColumn("full_text_original", F.when(F.col("translation").isNotNull(), F.col("full_text")).otherwise(F.col("full_text_original")))
    return j.withColumn("full_text", F.coalesce("translation", "full_text")).select(*works.columns)


def pending_full_texts(works: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Foreign works with text, not yet translated, that no ledger row holds back."""
    w = works.where("language <> 'eng' and full_text_original is null and coalesce(full_text, '') <> ''")
    return w if ledger is None else w.join(ledger.where("scope = 'full_text'").select(F.col("record_id").alias("celex_id")), "celex_id", "left_anti")
