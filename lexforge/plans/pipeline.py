"""A run from ids to a written dataset: fetch, parse by route, repair, number, save, check off. Everything between the
source and the store is one DataFrame plan; requests that failed are rows, not exceptions, and are checked off as failed;
the checkpoint is written last."""

from __future__ import annotations

import json
import platform
import uuid
from datetime import datetime, timezone
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType

from ..functions import com_units, html_units, ids as I, markdown_units, quality, text as T, translation as X
from ..functions import splitter
from ..functions.splitter import UNIT
from ..operators import relational as R, store as S, structure
from ..session import durable
from ..sources import pdf
from ..sources.config import Config, Descriptive
from ..sources.protocols import CatalogueSource

#: Type of the only unit of a document on which its reader failed; the text is the reason.
BROKEN = "broken"
TRIPLE = ["source_celex", "target_celex", "relation_type"]
RELATION_TYPES = ("cites", "amends", "adopts", "based_on", "proposes_to_amend", "consolidates")


def parse_units(content: DataFrame, granularity: str = "article", recitals: bool = True, articles: bool = True, annexes: bool = True) -> DataFrame:
    """content (celex_id, document_type, content_type, body): (celex_id, pos, unit fields). Each document goes to the
    reader of its route; documents without a route have no units."""
    d = content.withColumn("route", I.route(F.col("document_type"))).where("body is not null and route in ('structural', 'com')")
    us = _units(F.col("body"), F.col("route"), F.col("content_type") == "html", F.lit(granularity), F.lit(recitals), F.lit(articles), F.lit(annexes))
    u = d.select("celex_id", us.alias("us")).select("celex_id", F.posexplode("us").alias("pos", "u"))
    return u.select("celex_id", "pos", *[F.col(f"u.{n}").alias(n) for n in UNIT.names])


@F.pandas_udf(ArrayType(UNIT))
def _units(body: pd.Series, route: pd.Series, html: pd.Series, g: pd.Series, r: pd.Series, a: pd.Series, x: pd.Series) -> pd.Series:
    """The reader of each document's route over one scan of all documents."""

    def read(body, route, html, *wanted):
        try:
            if route == "structural":
                return html_units.act_units(body, *wanted) if html else markdown_units.markdown_units(body, *wanted)
            return com_units.com_units(body) if html else com_units.text_units(body)
        except Exception as e:  # one document must not end the run of all
            return [splitter.unit(BROKEN, None, f"{type(e).__name__}: {e}"[:500])]

    return pd.Series([read(*row) for row in zip(body, route, html, g, r, a, x)])


def with_fallbacks(units: DataFrame, content: DataFrame, alternatives: DataFrame | None, originals: DataFrame | None, *how) -> DataFrame:
    """The chain behind the first reading. content and alternatives (celex_id, document_type, content_type, language, body).

    An act whose structures came out too thin is read again from its alternative (a PDF, another language): that reading
    takes the place of the first if no count falls and one grows, else it fills the articles and annexes that only it has.
    originals (celex_id of a consolidated act, the rest of its original): recitals are those of the original.
    """
    if alternatives is not None:
        units = durable(units)
        docs = content.select("celex_id", "document_type", "language").distinct()
        counts = ["recitals", "articles", "annexes", "bodies", "units"]
        p = docs.join(structure.profile(units), "celex_id", "left").na.fill(0, counts)
        c = F.col
        thin = F.coalesce(quality.needs_fallback(c("language"), c("document_type"), c("recitals"), c("articles"), c("annexes")), F.lit(False))
        weak = p.where(thin | (quality.needs_pdf_retry(c("units"), c("bodies"), c("articles"), c("recitals")) & (I.route(c("document_type")) == "structural")))
        other = durable(parse_units(alternatives.join(weak.select("celex_id"), "celex_id", "left_semi"), *how).where(F.col("type") != BROKEN))
        q = structure.profile(other).withColumnsRenamed({k: f"new_{k}" for k in counts})
        better = quality.adopt_candidate({k: c(k) for k in counts[:3]}, {k: c(f"new_{k}") for k in counts[:3]})
        taken = durable(weak.join(q, "celex_id").where(better).select("celex_id"))
        kept = units.join(taken, "celex_id", "left_anti")
        filled = structure.merge_units(kept, other.join(taken, "celex_id", "left_anti").where("type in ('article', 'annex')"))
        units = filled.unionByName(other.join(taken, "celex_id", "left_semi"))
    if originals is not None:
        units = R.original_recitals(units, parse_units(originals, *how))
    return units


def tidy_units(units: DataFrame, strip: bool = True) -> DataFrame:
    """Closing formulas off the last article, then units without content off."""
    units = durable(units)  # parsed once: numbering reads the rows more than once
    if not strip:
        return structure.number_units(units)
    n = structure.last_of_type(units, "article", order="pos")
    n = n.withColumn("text", F.when(F.col("is_last"), T.strip_boilerplate(F.col("text"))).otherwise(F.col("text"))).drop("is_last")
    return structure.number_units(R.drop_empty_units(n))


def decode_metadata(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Catalogue rows (celex_id, data_type, value): metadata, relations, descriptors."""
    title = rows.where("startswith(data_type, 'title')").withColumn("l", F.coalesce(F.nullif(F.regexp_extract("data_type", "title_fallback_([a-z]{3})", 1), F.lit("")), F.lit("eng")))
    titles = R.language_fallback(title.select("celex_id", F.col("l").alias("lang"), F.col("value").alias("title")), "celex_id", "lang", "title").select("celex_id", "title")
    dates = rows.where("data_type = 'date'").groupBy("celex_id").agg(F.min(F.col("value").try_cast("date")).alias("date_adopted"))
    meta = rows.select("celex_id").distinct().join(titles, "celex_id", "left").join(dates, "celex_id", "left").withColumn("document_type", I.document_type(F.col("celex_id")))
    rel = rows.where(F.col("data_type").isin(*RELATION_TYPES)).select(F.col("celex_id").alias("source_celex"), F.col("value").alias("target_celex"), F.col("data_type").alias("relation_type"))
    uri, label = T.split_label(F.col("value"))
    voc = rows.where("data_type = 'eurovoc'").select("celex_id", uri.alias("eurovoc_uri"), label.alias("eurovoc_label"))
    return meta, S.clean_relations(rel), voc.distinct()


def decode_enrichment(rows: DataFrame, categories: tuple[str, ...] = S.CATEGORIES) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(metadata, relations, descriptors, complete ids): answers without every category's sentinel are left out."""
    want = F.array(*[F.lit(f"zz_complete_{c}") for c in categories])
    ok = rows.groupBy("celex_id").agg(F.collect_set(F.when(F.col("data_type").startswith("zz_complete_"), F.col("data_type"))).alias("s")).where(F.size(F.array_except(want, "s")) == 0).select("celex_id")
    r = rows.join(ok, "celex_id", "left_semi")
    v = F.when(F.col("data_type").isin("author", "subject_matter", "procedure_type"), T.uri_tail(F.col("value"))).otherwise(F.col("value"))
    m = r.withColumn("value", v)
    one = lambda c: F.min(F.when(F.col("data_type") == c, F.col("value")))
    many = lambda c: F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(F.col("data_type") == c, F.col("value")))), "; "), F.lit(""))
    date = lambda c: one(c).try_cast("date")
    meta = m.groupBy("celex_id").agg(
        date("date_entry_into_force").alias("date_entry_into_force"), date("date_end_of_validity").alias("date_end_of_validity"),
        F.lower(one("is_in_force")).isin("true", "1").alias("is_in_force"), one("eli").alias("eli"), many("author").alias("author"),
        many("subject_matter").alias("subject_matter"), one("procedure_type").alias("procedure_type"),
        one("procedure_reference").alias("procedure_reference"), one("procedure_legal_basis").alias("procedure_legal_basis"),
    )
    rel = r.where(F.col("data_type").isin(*S.ENRICHMENT_RELATIONS)).select(F.col("celex_id").alias("source_celex"), F.col("value").alias("target_celex"), F.col("data_type").alias("relation_type"))
    uri, label = T.split_label(F.col("value"))
    voc = r.where("data_type = 'eurovoc'").select("celex_id", uri.alias("eurovoc_uri"), label.alias("eurovoc_label")).distinct()
    return meta, S.clean_relations(rel), voc, ok


def negotiated(attempts: DataFrame, load_pdf=None) -> DataFrame:
    """Attempts as `lex_rest` gives them (celex_id, lang, fmt, status, body): content rows with outcome (ok, missing or
    retry) and error. A PDF goes through the injected readers (see sources/pdf.py); one that they cannot convert, or that
    no reader was given for, is to be retried. The answers are kept, so that nothing is requested twice."""
    t = durable(attempts)
    best = R.negotiate(t.select(F.col("celex_id").alias("id"), "lang", "fmt", "status", F.col("body").isNull().alias("empty"))).withColumnRenamed("id", "celex_id")
    said = F.concat(F.lit("request failed: "), F.array_join(F.array_sort(F.collect_set(F.concat_ws(" ", "lang", "fmt", F.coalesce(F.col("status").cast("string"), F.lit("no answer"))))), ", "))
    said = t.groupBy("celex_id").agg(said.alias("said"))
    body = t.groupBy("celex_id", "lang", "fmt").agg(F.first("body", ignorenulls=True).alias("raw"))
    c = best.join(body, ["celex_id", "lang", "fmt"], "left").join(said, "celex_id")
    files = c.where("outcome = 'ok' and fmt = 'pdf'").select("celex_id", "raw")
    md = pdf.convert(files, "celex_id", "raw", load_pdf or (lambda: (None, None)))
    c = c.join(durable(md).withColumnRenamed("key", "celex_id"), "celex_id", "left")
    unread = (F.col("outcome") == "ok") & (F.col("fmt") == "pdf") & F.col("markdown").isNull()
    text = F.when(F.col("fmt") == "pdf", F.col("markdown")).otherwise(F.col("raw").cast("string"))
    return c.select(
        "celex_id", F.col("fmt").alias("content_type"), F.col("lang").alias("language"), text.alias("body"), F.when(unread, "retry").otherwise(F.col("outcome")).alias("outcome"),
        F.when(unread, F.concat_ws(": ", F.lit("PDF not converted"), F.col("reason"), F.col("error"))).when(F.col("outcome") == "retry", F.col("said")).alias("error"),
    )


def process(data: S.Dataset, config: Config, metadata: DataFrame, content: DataFrame, alternatives: DataFrame | None = None, originals: DataFrame | None = None) -> dict[str, int]:
    """One batch into the dataset. metadata: catalogue rows; content (celex_id, content_type, language, body), body null
    where the document had none, and, where the source tells them, outcome and error. A document whose outcome is
    'retry' is checked off as failed with its error and changes no other table; it remains to be done. Tables are written
    in order, the checkpoint last, so a broken run repeats the batch. alternatives, originals: see with_fallbacks."""
    p = config.processing
    failed = content.limit(0).select("celex_id", F.lit(None).cast("string").alias("error"))
    if "outcome" in content.columns:
        failed = content.where("outcome = 'retry'").groupBy("celex_id").agg(F.coalesce(F.min("error") if "error" in content.columns else F.lit(None), F.lit("request failed")).alias("error"))
        metadata, content = (df.join(failed, "celex_id", "left_anti") for df in (metadata, content))
    meta, rel, voc = decode_metadata(metadata)
    c = content.join(meta.select("celex_id", "document_type"), "celex_id", "left")
    how = (p.text_unit_granularity, p.include_recitals, p.include_articles, p.include_annexes)
    named = [None if x is None else x.join(meta.select("celex_id", "document_type"), "celex_id") for x in (alternatives, originals)]
    first = durable(parse_units(c, *how))
    broken = durable(first.where(F.col("type") == BROKEN).select("celex_id", F.col("text").alias("error")))
    if not broken.isEmpty():
        failed = failed.unionByName(broken)
        meta, c, content, first = (df.join(broken.select("celex_id"), "celex_id", "left_anti") for df in (meta, c, content, first))
        rel = rel.join(broken.select(F.col("celex_id").alias("source_celex")), "source_celex", "left_anti")
        voc = voc.join(broken.select("celex_id"), "celex_id", "left_anti")
    units = tidy_units(with_fallbacks(first, c, *named, *how), p.strip_boilerplate)
    full = F.when(F.col("content_type") == "html", html_full_text(F.col("body"))).otherwise(F.col("body"))
    w = meta.join(content.withColumn("full_text", full), "celex_id", "left").select(
        "celex_id", "title", "date_adopted", "document_type", "language", "full_text", F.lit(None).cast("string").alias("full_text_original"),
        F.when(F.lit(p.store_raw_html) & (F.col("content_type") == "html"), F.col("body")).alias("full_text_html"),
        F.when(F.col("body").isNotNull(), F.concat_ws("_", F.lit("cellar"), "content_type", "language")).alias("content_source"), F.col("body").isNotNull().alias("fetched"),
    )
    ids = w.select("celex_id")
    got = w.where("fetched").select("celex_id")
    works = S.save_works(data.read("works"), w)
    data.write("works", works)
    works = data.read("works")
    before = data.read("text_units")
    old = before.drop("id")
    fresh = units.withColumn("text_translated", F.col("text_translated")).select(*old.columns)
    state = S.replace_by_key(old, fresh, got)
    data.write("text_units", _with_ids(state, before, ["unit_key", "celex_id", "unit_order"]).select(*S.SCHEMAS["text_units"].names))
    linked = data.read("relations")
    data.write("relations", _with_ids(S.save_relations(linked, rel, ids, works), linked, TRIPLE).select(*S.SCHEMAS["relations"].names))
    data.write("eurovoc", S.replace_by_key(data.read("eurovoc"), voc, ids).distinct())
    mark = ids.select("celex_id", F.lit("processed").alias("status"), F.lit(None).cast("string").alias("error"))
    mark = mark.unionByName(failed.select("celex_id", F.lit("failed").alias("status"), "error")).withColumn("timestamp", F.current_timestamp())
    data.write("work_checkpoint", S.upsert(data.read("work_checkpoint"), mark, ["celex_id"]))
    return {r["status"]: r["n"] for r in S.checkpoint_summary(data.read("work_checkpoint")).collect()}


html_full_text = html_units.T.html_full_text


def _with_ids(df: DataFrame, old: DataFrame, key: list[str], most: int = 2**31 - 1) -> DataFrame:
    """id: that of the row of the same key in the old state, else the next number after the greatest of the old state; no two
    rows have the same. Where the numbers would exceed `most`, all rows are numbered anew."""
    have = old.where("id is not null").groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.min("id").alias("id"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    rows = durable(df.drop("id").join(have, same, "left").drop(*[f"_{k}" for k in key]))
    again = F.row_number().over(Window.partitionBy("id").orderBy(*key)) > 1
    kept = rows.where("id is not null").withColumn("_again", again)
    rows = durable(kept.withColumn("id", F.when(~F.col("_again"), F.col("id"))).drop("_again").unionByName(rows.where("id is null")))
    top, new = old.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0], rows.where("id is null").count()
    if top + new > most:
        rows, top = rows.withColumn("id", F.lit(None).cast("int")), 0
    fresh = rows.where("id is null").withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    offsets, at = [], top + 1
    for p, n in sorted((r["_p"], r["count"]) for r in fresh.groupBy("_p").count().collect()):
        offsets.append((p, at))
        at += n
    start = F.broadcast(df.sparkSession.createDataFrame(offsets, "_p int, _start long"))
    fresh = fresh.join(start, "_p").withColumn("id", (F.col("_start") + F.col("_i")).cast("int")).drop("_p", "_i", "_start")
    return rows.where("id is not null").unionByName(fresh.select(*rows.columns))


def run_row(config: Config, version: str = "0.1.0") -> dict:
    return {
        "run_id": uuid.uuid4().hex, "started_at": datetime.now(timezone.utc), "completed_at": None, "config_json": config.canonical(), "config_sha256": config.digest(),
        "package_version": version, "source_revision": None, "source_dirty": None, "python_version": platform.python_version(), "dependency_versions": json.dumps({}),
    }


def selected(config: Config, source: CatalogueSource) -> DataFrame:
    """The ids that a configuration asks for: given ones and those of procedures, or those of types, dates and keywords."""
    d = config.data
    if isinstance(d, Descriptive):
        concepts = source.concepts(d.keywords) if d.keywords else []
        return source.discover(d.document_types, d.start_date, d.end_date, concepts, d.include_corrigenda, d.include_consolidated)
    return R.procedures_to_ids(source.procedures(d.procedure_numbers)).select("celex_id")


def run(data: S.Dataset, config: Config, fetch=None, source: CatalogueSource | None = None) -> str:
    """Returns the run's status. source: finds the ids and reads them; or fetch(ids DataFrame) -> (metadata rows, content
    rows) for ids that the configuration gives."""
    row = run_row(config)
    data.write("dataset_runs", S.start_run(data.read("dataset_runs"), row))
    try:
        ids = data.spark.createDataFrame([(i,) for i in getattr(config.data, "celex_ids", [])], "celex_id string")
        if isinstance(config.data, Descriptive) or config.data.procedure_numbers:
            if source is None:
                raise ValueError("this configuration needs a catalogue to find its documents in")
            ids = ids.unionByName(selected(config, source)).distinct()
        todo = durable(S.remaining(ids, data.read("work_checkpoint"), config.processing.limit))
        got = fetch(todo) if fetch else (source.metadata(todo), source.content(todo))
        counts = process(data, config, *got)
        status = "complete_with_failures" if counts.get("failed") else "complete"
    except Exception:
        data.write("dataset_runs", S.finish_run(data.read("dataset_runs"), row["run_id"], "failed", datetime.now(timezone.utc)))
        raise
    data.write("dataset_runs", S.finish_run(data.read("dataset_runs"), row["run_id"], status, datetime.now(timezone.utc)))
    return status


def translate(data: S.Dataset, load, max_chars: int = X.MAX_CHARS, policy: int = 1) -> dict[str, int]:
    """Both passes of translation with an injected tokenizer and model (see functions/translation.py): full texts of foreign
    works, then their units. What is refused goes to the ledger `translation_failures`, which holds it back until its
    text or the policy changes. Returns how many texts of each pass were translated and refused."""
    works, units = data.read("works"), data.read("text_units")
    ledger = durable(S.current_failures(data.read("translation_failures"), works, units, policy))
    w = X.pending_full_texts(works, ledger)
    full = durable(X.translate_units(w, "celex_id", "full_text", load, max_chars, True))
    foreign = works.where("language <> 'eng'").select("celex_id")
    held = ledger.where("scope = 'unit'").select(F.col("record_id").alias("unit_key"))
    u = units.where("text_translated is null and unit_key is not null").join(foreign, "celex_id", "left_semi").join(held, "unit_key", "left_anti")
    part = durable(X.translate_units(u, "unit_key", "text", load, 0))
    sha = lambda c: F.sha2(c, 256).alias("source_sha256")
    sources = works.select(F.lit("full_text").alias("scope"), F.col("celex_id").alias("record_id"), "celex_id", sha("full_text"))
    sources = sources.unionByName(u.select(F.lit("unit").alias("scope"), F.col("unit_key").alias("record_id"), "celex_id", sha("text")))
    said = full.withColumn("scope", F.lit("full_text")).unionByName(part.withColumn("scope", F.lit("unit"))).withColumnRenamed("key", "record_id")
    refused = said.where("reason is not null and reason <> 'too_long'").join(sources, ["scope", "record_id"])
    refused = refused.select("scope", "record_id", "celex_id", "source_sha256", "reason", F.lit(policy).alias("policy_version"), F.current_timestamp().alias("attempted_at"))
    names = S.SCHEMAS["translation_failures"].names
    refused = durable(refused.select(*names))
    data.write("works", X.apply_full_text(works, full))
    done = part.where("translation is not null").select(F.col("key").alias("unit_key"), "translation")
    new = units.join(done, "unit_key", "left").withColumn("text_translated", F.coalesce("text_translated", "translation"))
    data.write("text_units", new.select(*S.SCHEMAS["text_units"].names))
    data.write("translation_failures", ledger.select(*names).unionByName(refused))
    counts = said.groupBy("scope").agg(F.count("translation").alias("ok"), F.count_if(F.col("translation").isNull()).alias("no")).collect()
    return {f"{r['scope']}_{k}": r[c] for r in counts for k, c in (("translated", "ok"), ("refused", "no"))}


def enrich(data: S.Dataset, fetch, categories: tuple[str, ...] = S.CATEGORIES, force: bool = False) -> int:
    """fetch(ids) -> catalogue rows with sentinels. Returns how many documents were completed."""
    todo = S.missing_categories(data.read("works"), data.read("enrichment_checkpoint"), categories, force)
    meta, rel, voc, ok = decode_enrichment(fetch(todo.select("celex_id")), categories)
    n = ok.count()
    if n:
        new = S.save_enrichment(data.read("works"), data.read("relations"), data.read("eurovoc"), data.read("enrichment_checkpoint"), meta, rel, voc, ok, datetime.now(timezone.utc))
        for name, df in new.items():
            data.write(name, (_with_ids(df, data.read(name), TRIPLE) if name == "relations" else df).select(*S.SCHEMAS[name].names))
    return n
