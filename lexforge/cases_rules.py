"""Small invented rows for operators whose inputs the tables do not hold, with the rows that are to come out of them.
Each query runs the library's operator; its SQL is the expected rows as a table of values."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .cases import values_sql
from .functions import markdown_units as M, quality, splitter, text as T, translation as X
from .functions.ids import discover
from .operators import relational as R, repair, store as S, structure, validate as V
from .plans import pipeline
from .session import ship_package
from .sources import catalogue as C, pdf
from .sources.config import Config, ConfigError

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def case(columns: str, rows: list[tuple]):
    """The expected rows of the operator that the function below it runs."""

    def wrap(f):
        name = f"case_{f.__name__}"

        def query(spark: SparkSession, d: str) -> DataFrame:
            ship_package(spark)
            return f(spark)

        QUERIES[name] = query
        SQL[name] = values_sql(iter(rows), tuple(columns.split()))
        return f

    return wrap


def _df(spark: SparkSession, schema: str, *rows) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def _table(spark: SparkSession, name: str, *rows: dict) -> DataFrame:
    """Rows of a table of the store, columns that are not given null."""
    return spark.createDataFrame([{c: r.get(c) for c in S.SCHEMAS[name].names} for r in rows], S.SCHEMAS[name])


# --- text ------------------------------------------------------------------------------------------------
@case("k pos s", [("a", 0, "One is here."), ("a", 1, "Two follows;"), ("a", 2, "(3) ends. but not this"), ("b", 0, "")])
def sentences(spark):
    d = _df(spark, "k string, x string", ("a", "One is here. Two follows; (3) ends. but not this"), ("b", ""), ("c", None))
    return d.select("k", F.posexplode(T.sentences(F.col("x"))).alias("pos", "s"))


@case("k x", [("a", "a fi bc"), ("b", ""), ("c", None), ("d", "2 x")])
def compatibility_form(spark):
    d = _df(spark, "k string, x string", ("a", "  a\t ﬁ b­c "), ("b", "   "), ("c", None), ("d", "② ｘ"))
    return d.select("k", T.normalise(F.col("x")).alias("x"))


@case("k x", [("a", "Text."), ("b", "Kept\n\nmore"), ("c", "Words here."), ("d", None)])
def pdf_artefacts(spark):
    d = _df(spark, "k string, x string", ("a", "<!-- image -->\nText. Done at Riva, 3 May"), ("b", "Kept\n\n\n\nmore\nEN\nL 3/45"), ("c", "Words here. For the Council\nA name"), ("d", None))
    return d.select("k", T.pdf_artefacts(F.col("x")).alias("x"))


@case("k x", [("a", 'meta charset="UTF-8"'), ("b", "charset=utf-16"), ("c", None)])
def encoding_names(spark):
    d = _df(spark, "k string, x string", ("a", 'meta charset="unicode-1-1-utf-8"'), ("b", "charset=utf-16"), ("c", None))
    return d.select("k", T.encoding_alias(F.col("x")).alias("x"))


@case("k x", [("a", "<p>rule of it</p></body></html>"), ("b", "<p>ANNEX I</p>"), ("c", "<p>ää no mark here at all</p>")])
def oversized_pages(spark):
    d = _df(spark, "k string, x string", ("a", '<p>rule of it</p><p class="doc-ti">ANNEX</p>'), ("b", "<p>ANNEX I</p>"), ("c", "<p>ää no mark here at all</p>"))
    return d.select("k", T.truncate_html(F.col("x"), 20).alias("x"))


@case("k x", [("a", "3%281%29"), ("b", "a%2Fb")])
def percent_encoding(spark):
    return _df(spark, "k string, x string", ("a", "3(1)"), ("b", "a/b")).select("k", F.url_encode("x").alias("x"))


# --- configuration, catalogue ------------------------------------------------------------------------------
@case("k outcome", [("empty fixed", "refused"), ("fixed", "32016R0679 digest 64"), ("malformed id", "refused"), ("negative limit", "refused"), ("procedure", " digest 64"), ("reversed dates", "refused"), ("types", " digest 64"), ("unknown key", "refused"), ("no type", "refused")])
def configurations(spark):
    fixed, dates = {"mode": "fixed", "celex_ids": [" 32016r0679 "]}, {"mode": "descriptive", "document_types": ["regulation"], "start_date": "2020-01-01", "end_date": "2020-01-02"}
    raw = {
        "fixed": {"data": fixed}, "empty fixed": {"data": {"mode": "fixed"}}, "malformed id": {"data": {"mode": "fixed", "celex_ids": ["x"]}}, "unknown key": {"data": fixed, "extra": 1},
        "negative limit": {"data": fixed, "processing": {"limit": -1}}, "types": {"data": dates}, "reversed dates": {"data": dates | {"end_date": "2019-01-01"}}, "no type": {"data": dates | {"document_types": []}},
        "procedure": {"data": {"mode": "fixed", "procedure_numbers": ["2000/1"]}},
    }

    def outcome(x: dict) -> str:
        try:
            c = Config.of(x)
        except ConfigError:
            return "refused"
        return f"{','.join(getattr(c.data, 'celex_ids', []))} digest {len(c.digest())}"

    return _df(spark, "k string, outcome string", *[(k, outcome(v)) for k, v in raw.items()])


@case("k url", [("act", "u2"), ("only annexes", "u1"), ("order", "u2"), ("nothing", None)])
def stream_choices(spark):
    item = lambda u, name, order: f'<li title="item"><a href="{u}">x</a><ul><li title="stream_name">{name}</li><li title="stream_order">{order}</li></ul></li>'
    pages = {"act": item("u1", "L_1.html", 1) + item("u2", "L_ACT.html", 5), "only annexes": item("u1", "L_annex.html", 2) + item("u2", "L_cover.html", 1), "order": item("u1", "b.html", "") + item("u2", "a.html", 3), "nothing": "<p>none</p>"}
    pick = F.pandas_udf(lambda s: s.map(lambda x: C.pick_choice(C.parse_choices(x))), "string")
    return _df(spark, "k string, page string", *pages.items()).select("k", pick("page").alias("url"))


@case("status body outcome", [(200, "x", "ok"), (200, "", "missing"), (300, "x", "choices"), (403, "", "missing"), (404, "", "missing"), (410, "x", "unavailable"), (429, "", "transient"), (503, "", "transient"), (None, "", "transient")])
def answer_kinds(spark):
    kind = F.pandas_udf(lambda s, b: pd.Series([C.classify(None if pd.isna(x) else int(x), y.encode()) for x, y in zip(s, b)]), "string")
    rows = [(200, "x"), (200, ""), (300, "x"), (403, ""), (404, ""), (410, "x"), (429, ""), (503, ""), (None, "")]
    return _df(spark, "status int, body string", *rows).withColumn("outcome", kind("status", "body"))


@case("concept definition broader narrower related", [("c", "d1", "b", "", "a,z"), ("e", None, "", "n", "")])
def concept_info(spark):
    rows = [("c", "definition", "d2"), ("c", "definition", "d1"), ("c", "broader", "b"), ("c", "related", "z"), ("c", "related", "a"), ("e", "narrower", "n")]
    out = R.concept_info(_df(spark, "concept string, data_type string, value string", *rows))
    return out.select("concept", "definition", *[F.array_join(c, ",").alias(c) for c in ("broader", "narrower", "related")])


@case("celex_id", [("32000R0001",), ("32000R0002",)])
def empty_concepts_do_not_narrow(spark):
    acts = _df(spark, "celex_id string, d string", ("32000R0002", "2000-01-01"), ("32000R0001", "2000-01-01"), ("32000L0001", "2000-01-01"), ("02000R0001", "2000-01-01")).selectExpr("celex_id", "cast(d as date) as date_adopted")
    return discover(acts, ["regulation"], "2000-01-01", "2000-12-31", [])


@case("celex_id content_type language body outcome error", [("A", "html", "fra", "page", "ok", None), ("B", None, None, None, "retry", "request failed: eng html 503"), ("C", None, None, None, "missing", None), ("D", "pdf", "eng", "read", "ok", None), ("E", "pdf", "eng", None, "retry", "PDF not converted: conversion: ValueError")])
def negotiated_content(spark):
    rows = [("A", "eng", "html", 404, None), ("A", "eng", "pdf", 404, None), ("A", "fra", "html", 200, b"page"), ("B", "eng", "html", 503, None), ("C", "eng", "html", 404, None), ("D", "eng", "pdf", 200, b"%PDF-d"), ("E", "eng", "pdf", 200, b"%PDF-e")]

    def layout(c: bytes) -> str:
        if c.endswith(b"e"):
            raise ValueError("ValueError")
        return "read"

    return pipeline.negotiated(_df(spark, "celex_id string, lang string, fmt string, status int, body binary", *rows), lambda: (layout, None))


@case("key markdown backend reason error", [("a", "layout a", "layout", None, None), ("b", "layer b", "text_layer", "empty", None), ("c", "layer c", "text_layer", "conversion", "broken"), ("d", None, "none", "empty", None)])
def pdf_conversion(spark):
    def layout(c: bytes) -> str:
        if c == b"c":
            raise RuntimeError("broken")
        return "layout a" if c == b"a" else " "

    layer = lambda c: "" if c == b"d" else "layer " + c.decode()
    return pdf.convert(_df(spark, "k string, c binary", ("a", b"a"), ("b", b"b"), ("c", b"c"), ("d", b"d"), ("e", None)), "k", "c", lambda: (layout, layer))


# --- translation -------------------------------------------------------------------------------------------
@case("k pos n", [("long", 0, 480), ("long", 1, 480), ("long", 2, 245), ("packed", 0, 3), ("packed", 1, 2)])
def translation_chunks(spark):
    cut = F.pandas_udf(lambda s, b: pd.Series([[len(c.split()) for c in X.chunks(x, str.split, y)] for x, y in zip(s, b)]), "array<int>")
    d = _df(spark, "k string, x string, b int", ("long", " ".join(["w"] * 1205), 480), ("packed", "\n".join("abcde"), 3))
    return d.select("k", F.posexplode(cut("x", "b")).alias("pos", "n"))


@case("key translation reason", [("a", "ONE TWO", None), ("b", None, "empty_output"), ("c", None, "too_long"), ("d", "FIRST\nSECOND", None)])
def translated_texts(spark):
    d = _df(spark, "k string, x string", ("a", "one two"), ("b", "bad"), ("c", "x" * 60), ("d", "first\nsecond"), ("e", " "), ("f", None))
    return X.translate_units(d, "k", "x", lambda: (str.split, lambda ts, strict: ["" if t == "bad" else t.upper() for t in ts]), 50)


@case("k x", [("a", "[a]\n\n(1) OJ L 1\n[b]"), ("b", "")])
def translated_lines(spark):
    f = F.pandas_udf(lambda s: s.map(lambda x: X.translate_lines(x, lambda t: f"[{t}]")), "string")
    return _df(spark, "k string, x string", ("a", "a\n\n(1) OJ L 1\nb"), ("b", "")).select("k", f("x").alias("x"))


_LONG = "a plain sentence of some length that says one thing and then another thing about the grain trade of the north. "


@case("k issue", [("empty", "empty_output"), ("expansion", "excessive_expansion"), ("contraction", "severe_contraction"), ("document expansion", "document_expansion"), ("document contraction", "document_contraction"), ("repetitive", "repetitive_output"), ("fine", None), ("n-grams", "repetitive_output"), ("source repeats too", None)])
def translation_issues(spark):
    words = " ".join(f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst")
    pairs = [
        ("empty", "text", " ", False), ("expansion", "x" * 40, words[:220], False), ("contraction", _LONG, "word", False), ("document expansion", words[:199] * 6, words * 12, True),
        ("document contraction", words * 3 + words[:160], words, True), ("repetitive", "short text here now", "word " * 20, False), ("fine", "some words in a sentence", "other words in a sentence", False),
        ("n-grams", _LONG * 3, "the grain trade " * 9 + words[:60], False), ("source repeats too", "the grain trade " * 9 + words[:60], "le commerce de " * 9 + words[:60], False),
    ]
    d = _df(spark, "k string, s string, o string, doc boolean", *pairs)
    return d.select("k", quality.translation_issue(F.col("s"), F.col("o"), F.col("doc")).alias("issue"))


@case("k adopted", [("falls", False), ("grows", True), ("same", False), ("mixed", False)])
def adopted_candidates(spark):
    d = _df(spark, "k string, r int, a int, nr int, na int", ("falls", 3, 3, 2, 3), ("grows", 0, 3, 4, 3), ("same", 1, 1, 1, 1), ("mixed", 1, 5, 3, 4))
    return d.select("k", quality.adopt_candidate({"r": F.col("r"), "a": F.col("a")}, {"r": F.col("nr"), "a": F.col("na")}).alias("adopted"))


@case("k tag", [("a", "cellar_html_eng"), ("b", "cellar_pdf_fra__pymupdf_timeout__translated"), ("c", "cellar_html_eng__pdf_fallback__pymupdf_articles")])
def provenance(spark):
    d = _df(spark, "k string, base string, fb string, art boolean, be string, tr boolean", ("a", "cellar_html_eng", None, False, None, False), ("b", "cellar_pdf_fra", None, False, "timeout", True), ("c", "cellar_html_eng", "pdf_fallback", True, None, False))
    return d.select("k", R.provenance(F.col("base"), F.col("fb"), F.col("art"), F.col("be"), F.col("tr")).alias("tag"))


# --- structure ---------------------------------------------------------------------------------------------
@case("k turned kept", [("a", "1,2,3", "3,1,2"), ("b", "1,2,3", "1,2,3"), ("c", "2,1,4", "2,1,4"), ("d", "5,6", "5,6"), ("e", "1,2,1,2,3", "1,2,3"), ("f", "1,2,1,2,5", "1,2,1,2,5"), ("g", "1,1,2", "1,2"), ("h", "1,2,1,1,3", "1,2,1,1,3")])
def number_sequences(spark):
    d = _df(spark, "k string, n array<int>", ("a", [3, 1, 2]), ("b", [1, 2, 3]), ("c", [2, 1, 4]), ("d", [5, 6]), ("e", [1, 2, 1, 2, 3]), ("f", [1, 2, 1, 2, 5]), ("g", [1, 1, 2]), ("h", [1, 2, 1, 1, 3]))
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return d.select("k", join(structure.rotate_to_one(F.col("n"))).alias("turned"), join(structure.remove_restarts(F.col("n"))).alias("kept"))


@case("pos number text", [(0, "1", "one"), (1, "2", "two and more")])
def text_layer_articles(spark):
    """What a text layer adds to the articles of the layout; a page heading is cut off it."""
    a, l = [splitter.unit("article", "1", "one")], [splitter.unit("article", "1", "eins"), splitter.unit("article", "2", "two and more Having regard to the Treaty, no")]
    merge = F.pandas_udf(lambda s: s.map(lambda _: [(u["number"], u["text"]) for u in M.merge_text_layer(a, l)]), "array<struct<number:string,text:string>>")
    return spark.range(1).select(merge("id").alias("us")).select(F.posexplode("us").alias("pos", "u")).select("pos", "u.*")


@case("celex_id type number text text_translated", [("0A", "article", "1", "rule", None), ("0A", "recital", "1", "old one", "eins"), ("0A", "recital", "2", "old two", None), ("B", "recital", "1", "kept", None)])
def original_recitals(spark):
    u = "celex_id string, type string, number string, text string, text_translated string"
    units = _df(spark, u, ("0A", "recital", "1", "new one", "eins"), ("0A", "article", "1", "rule", None), ("B", "recital", "1", "kept", None))
    return R.original_recitals(units, _df(spark, u, ("0A", "recital", "1", "old one", None), ("0A", "recital", "2", "old two", None)))


@case("k", [("b",), ("c",)])
def units_with_content(spark):
    return R.drop_empty_units(_df(spark, "k string, title string, text string", ("a", None, " "), ("b", None, "x"), ("c", "t", ""), ("d", "", None))).select("k")


@case("celex_id type number text", [("A", "article", "1", "Rule one."), ("A", "article", "2", "Rule two."), ("B", "article", "1", "Rule one."), ("B", "article", "2", "From the PDF.")])
def fallback_readings(spark):
    """A page without structure is replaced by its PDF; a page that lacks a recital is only filled."""
    cols = "celex_id string, document_type string, content_type string, language string, body string"
    art = "".join(f'<div id="art_{n}"><p>Rule {w}.</p></div>' for n, w in ((1, "one"),))
    first = _df(spark, cols, ("A", "regulation", "html", "eng", "<p>nothing</p>"), ("B", "regulation", "html", "eng", '<div id="rct_1"><p>(1) A ground of some length is here.</p></div><p>x</p>' + art))
    other = _df(spark, cols, ("A", "regulation", "pdf", "eng", "Article 1\nRule one.\nArticle 2\nRule two."), ("B", "regulation", "pdf", "eng", "Article 1\nOther words.\nArticle 2\nFrom the PDF."))
    first = first.withColumn("body", F.regexp_replace("body", '<div id="rct_1">.*?</div>', ""))
    how = ("article", True, True, True)
    out = pipeline.with_fallbacks(pipeline.parse_units(first, *how), first, other.withColumn("body", F.when(F.col("celex_id") == "B", F.regexp_replace("body", "Article 1\nOther words.", "Article 1\nRule one.")).otherwise(F.col("body"))), None, *how)
    return out.select("celex_id", "type", "number", "text")


# --- store -------------------------------------------------------------------------------------------------
@case("celex_id eurovoc_uri", [("A", "u3"), ("B", "u2")])
def replaced_descriptors(spark):
    old = _df(spark, "celex_id string, eurovoc_uri string", ("A", "u1"), ("B", "u2"), ("C", "u9"))
    return S.replace_by_key(old, _df(spark, "celex_id string, eurovoc_uri string", ("A", "u3")), _df(spark, "celex_id string", ("A",), ("C",)))


@case("run_id status completed", [("r1", "interrupted", False), ("r2", "complete", True), ("r3", "complete_with_failures", True)])
def run_records(spark):
    runs = _table(spark, "dataset_runs", {"run_id": "r1", "status": "running"}, {"run_id": "r2", "status": "complete", "completed_at": datetime(2020, 1, 1)})
    row = dict.fromkeys(S.SCHEMAS["dataset_runs"].names) | {"run_id": "r3"}
    out = S.finish_run(S.start_run(runs, row), "r3", "complete_with_failures", datetime(2020, 1, 2))
    return out.select("run_id", "status", F.col("completed_at").isNotNull().alias("completed"))


@case("t a b c", [("works", "A", "new", "true"), ("works", "B", "old", "false"), ("relations", "A", "X", "cites"), ("relations", "A", "Z", "repeals"), ("relations", "B", "Y", "repeals"), ("eurovoc", "A", "u2", None), ("eurovoc", "B", "u1", None), ("enrichment_checkpoint", "A", "eurovoc", None), ("enrichment_checkpoint", "A", "metadata", None), ("enrichment_checkpoint", "A", "relations", None)])
def saved_enrichment(spark):
    works = _table(spark, "works", {"celex_id": "A", "author": "old"}, {"celex_id": "B", "author": "old"})
    rel = _table(spark, "relations", *[dict(id=i, source_celex=a, target_celex=b, relation_type=c) for i, (a, b, c) in enumerate([("A", "X", "cites"), ("A", "Y", "repeals"), ("B", "Y", "repeals")])])
    voc = _table(spark, "eurovoc", {"celex_id": "A", "eurovoc_uri": "u1"}, {"celex_id": "B", "eurovoc_uri": "u1"})
    meta = _table(spark, "works", {"celex_id": "A", "author": "new"}).select("celex_id", *[c for c in S.ENRICHMENT_COLUMNS if c != "enriched_at"])
    new = S.save_enrichment(works, rel, voc, _table(spark, "enrichment_checkpoint"), meta, _df(spark, "source_celex string, target_celex string, relation_type string", ("A", "Z", "repeals")), _table(spark, "eurovoc", {"celex_id": "A", "eurovoc_uri": "u2"}), _df(spark, "celex_id string", ("A",)), datetime(2020, 1, 1))
    pick = lambda n, *cs: new[n].select(F.lit(n).alias("t"), *[F.col(c).cast("string") if isinstance(c, str) else c for c in cs]).toDF("t", "a", "b", "c")
    none = F.lit(None).cast("string")
    out = pick("works", "celex_id", "author", F.col("enriched_at").isNotNull().cast("string")).unionByName(pick("relations", "source_celex", "target_celex", "relation_type"))
    return out.unionByName(pick("eurovoc", "celex_id", "eurovoc_uri", none)).unionByName(pick("enrichment_checkpoint", "celex_id", "category", none))


def _dataset(spark: SparkSession) -> dict[str, DataFrame]:
    config = '{"a":1}'
    rep = "word " * 20
    t = {
        "works": [{"celex_id": "A", "document_type": "regulation", "language": "fra", "content_source": "cellar_html_fra", "full_text": rep, "full_text_original": "un texte court"}, {"celex_id": "B", "document_type": "regulation", "language": "eng", "content_source": "cellar_html_eng", "full_text": "fine words"}],
        "text_units": [{"id": 1, "celex_id": "A", "type": "article", "unit_order": 1, "unit_key": "A:1", "text": "un mot court", "text_translated": rep}, {"id": 2, "celex_id": "B", "type": "article", "unit_order": 1, "unit_key": "B:1", "text": "a word"}],
        "relations": [], "eurovoc": [], "work_checkpoint": [{"celex_id": "A", "status": "processed"}, {"celex_id": "B", "status": "processed"}], "enrichment_checkpoint": [],
        "dataset_runs": [{"run_id": "1", "status": "running"}, {"run_id": "2", "status": "interrupted"}, {"run_id": "3", "status": "complete", "config_json": config, "config_sha256": "0"}, {"run_id": "4", "status": "complete"}],
        "translation_failures": [{"scope": "unit", "record_id": "A:1", "reason": "empty_output"}],
    }
    return {k: _table(spark, k, *v) if v else spark.createDataFrame([], S.SCHEMAS[k]) for k, v in t.items()}


@case("severity code count", [("error", "degenerate_full_text_translation", 1), ("error", "degenerate_text_unit_translation", 1), ("error", "manifest_hash_mismatch", 1), ("warning", "recorded_translation_rejection", 1), ("warning", "unfinished_runs", 2)])
def validated_ledgers(spark):
    return V.validate(_dataset(spark)).select("severity", "code", "count")


@case("severity code count detail", [("error", "missing_table", 1, "eurovoc"), ("error", "missing_table", 1, "enrichment_checkpoint")])
def missing_tables(spark):
    return V.validate({k: v for k, v in _dataset(spark).items() if k not in ("eurovoc", "enrichment_checkpoint")})


@case("severity code count detail", [("error", "missing_text_unit_column", 1, "unit_key")])
def missing_columns(spark):
    t = _dataset(spark)
    return V.validate(t | {"text_units": t["text_units"].drop("unit_key")})


@case("celex_id record scope reason action", [("A", "A", "full_text", "repetitive_output", "reset_full_text"), ("A", "A:1", "unit", "repetitive_output", "reset_unit"), ("B", "B", "work", "requested", "reprocess_work")])
def quality_repair(spark):
    t = _dataset(spark)
    return repair.quality_repair(t["works"], t["text_units"], _df(spark, "celex_id string", ("B",)))


@case("t k a b", [("works", "A", "un texte court", None), ("works", "B", "fine words", None), ("units", "A:1", "un mot court", None), ("units", "B:1", "a word", None), ("checkpoint", "A", "processed", None)])
def applied_quality_repair(spark):
    t = _dataset(spark)
    works, units, cp = repair.apply_quality_repair(t["works"], t["text_units"], t["work_checkpoint"], quality_repair(spark))
    out = works.select(F.lit("works").alias("t"), F.col("celex_id").alias("k"), F.col("full_text").alias("a"), F.col("full_text_original").alias("b"))
    out = out.unionByName(units.select(F.lit("units").alias("t"), F.col("unit_key").alias("k"), F.col("text").alias("a"), F.col("text_translated").alias("b")))
    return out.unionByName(cp.select(F.lit("checkpoint").alias("t"), F.col("celex_id").alias("k"), F.col("status").alias("a"), F.lit(None).cast("string").alias("b")))


@case("celex_id pending", [("F1", True)])
def pending_translations(spark):
    works = _table(spark, "works", *[dict(celex_id=k, language=l, full_text=t, full_text_original=o) for k, l, t, o in (("F1", "fra", "a", None), ("F2", "fra", "b", "c"), ("E", "eng", "d", None), ("F3", "fra", "", None), ("F4", "fra", "e", None))])
    ledger = _table(spark, "translation_failures", {"scope": "full_text", "record_id": "F4"})
    return X.pending_full_texts(works, ledger).select("celex_id", F.lit(True).alias("pending"))
