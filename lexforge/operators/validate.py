"""Integrity and quality checks of a dataset: rows (severity, code, count), only where something was found."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import quality
from .store import SCHEMAS

E, W = "error", "warning"
NEEDED = ("works", "text_units", "relations", "eurovoc", "work_checkpoint", "enrichment_checkpoint")


LEGISLATIVE, READ = ("regulation", "directive", "decision"), ("regulation", "directive", "decision", "communication", "proposal", "staff working document")
#: Severity of each check (fixed values).
SEVERITY = {
    E: "duplicate_work_id duplicate_text_unit_id duplicate_relation_id duplicate_checkpoint_id checkpoint_without_work work_without_checkpoint orphan_text_unit orphan_relation_source "
    "orphan_eurovoc orphan_enrichment_checkpoint duplicate_relation duplicate_eurovoc duplicate_unit_key duplicate_unit_order missing_unit_identity marker_only_recital "
    "translated_fallback_marker_gap pending_pdf_repair content_without_text_units manifest_hash_mismatch degenerate_full_text_translation degenerate_text_unit_translation",
    W: "untranslated_non_english_unit works_without_content failed_checkpoints structural_body_fallback unextractable_document_type unfinished_runs recorded_translation_rejection",
}


def _keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _without(child: DataFrame, key: str, parent: DataFrame, parent_key: str = "celex_id") -> DataFrame:
    return child.select(F.col(key).alias("k")).join(parent.select(F.col(parent_key).alias("k")).distinct(), "k", "left_anti")


def _conditions(t: dict[str, DataFrame]) -> list[tuple[DataFrame, dict[str, Column]]]:
    """Checks that one pass over a table settles: the rows, and of each code what is counted."""
    works, units, cp = t["works"], t["text_units"], t["work_checkpoint"]
    c, n = F.col, F.count_if
    filled = lambda x: F.coalesce(c(x), F.lit("")) != ""
    acts = works.select("celex_id", "language", "content_source", "document_type", F.lit(True).alias("known"))
    joined = units.join(acts, "celex_id", "left")
    known = F.coalesce("known", F.lit(False))
    out = [
        (works, {
            "pending_pdf_repair": n(c("content_source").startswith("repair_pending__")),
            "works_without_content": n(~filled("full_text")),
            "unextractable_document_type": n(c("document_type").isNull() | ~c("document_type").isin(*READ)),
            "degenerate_full_text_translation": n(c("full_text_original").isNotNull() & c("full_text").isNotNull() & quality.translation_issue(c("full_text_original"), c("full_text"), True).isNotNull()),
        }),
        (joined, {
            "orphan_text_unit": n(~known),
            "missing_unit_identity": n(c("unit_order").isNull() | c("unit_key").isNull()),
            "marker_only_recital": n((c("type") == "recital") & (F.trim("text") == F.concat(F.lit("("), "number", F.lit(")")))),
            "translated_fallback_marker_gap": n(known & c("content_source").endswith("__translated") & (c("type") != "recital") & ~filled("text_translated")),
            "untranslated_non_english_unit": n(known & (c("language") != "eng") & filled("text") & ~filled("text_translated")),
            "structural_body_fallback": F.countDistinct(F.when(known & c("document_type").isin(*LEGISLATIVE) & (c("type") == "body"), c("celex_id"))),
            "degenerate_text_unit_translation": n(c("text").isNotNull() & c("text_translated").isNotNull() & quality.translation_issue(c("text"), c("text_translated")).isNotNull()),
        }),
        (cp, {"failed_checkpoints": n(c("status") == "failed")}),
    ]
    if "dataset_runs" in t:
        changed = c("config_json").isNotNull() & (F.sha2("config_json", 256) != c("config_sha256"))
        out.append((t["dataset_runs"], {"unfinished_runs": n(c("status").isin("running", "interrupted")), "manifest_hash_mismatch": n(changed)}))
    if "translation_failures" in t:
        out.append((t["translation_failures"], {"recorded_translation_rejection": F.count(F.lit(1))}))
    return out


def _keyed(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Checks on keys: the offending keys."""
    works, units, rel, voc, cp, ecp = (t[n] for n in NEEDED)
    return {
        "duplicate_work_id": _keys(works, "celex_id"),
        "duplicate_text_unit_id": _keys(units, "id"),
        "duplicate_relation_id": _keys(rel, "id"),
        "duplicate_checkpoint_id": _keys(cp, "celex_id"),
        "checkpoint_without_work": _without(cp.where("status = 'processed'"), "celex_id", works),
        "work_without_checkpoint": _without(works, "celex_id", cp),
        "orphan_relation_source": _without(rel, "source_celex", works),
        "orphan_eurovoc": _without(voc, "celex_id", works),
        "orphan_enrichment_checkpoint": _without(ecp, "celex_id", works),
        "duplicate_relation": _keys(rel, "source_celex", "target_celex", "relation_type"),
        "duplicate_eurovoc": _keys(voc, "celex_id", "eurovoc_uri"),
        "duplicate_unit_key": _keys(units.where("unit_key is not null"), "unit_key"),
        "duplicate_unit_order": _keys(units.where("unit_order is not null"), "celex_id", "unit_order"),
        "content_without_text_units": _without(works.where("coalesce(full_text, '') <> ''"), "celex_id", units),
    }


def validate(t: dict[str, DataFrame], only: set[str] | None = None) -> DataFrame:
    """The report. Missing tables end it, then missing identity columns. All conditions on the rows of a table are counted
    in one pass; keys are grouped or anti-joined on their own columns only."""
    spark = next(iter(t.values())).sparkSession
    missing = [(E, "missing_table", 1, n) for n in NEEDED if n not in t]
    if not missing:
        missing = [(E, "missing_text_unit_column", 1, c) for c in SCHEMAS["text_units"].names if c in ("unit_order", "unit_key") and c not in t["text_units"].columns]
    if missing:
        return spark.createDataFrame(missing, "severity string, code string, count long, detail string")
    severity = {code: s for s, codes in SEVERITY.items() for code in codes.split()}
    parts = []
    for rows, counts in _conditions(t):
        asked = {code: x.alias(code) for code, x in counts.items() if only is None or code in only}
        if asked:
            stack = F.stack(F.lit(len(asked)), *[y for code in asked for y in (F.lit(code), F.col(code))]).alias("code", "count")
            parts.append(rows.agg(*asked.values()).select(stack))
    parts += [df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(code).alias("code"), "count") for code, df in _keyed(t).items() if only is None or code in only]
    named = F.element_at(F.create_map(*[F.lit(x) for kv in severity.items() for x in kv]), F.col("code"))
    report = reduce(DataFrame.unionByName, parts).where("count > 0")
    return report.select(named.alias("severity"), "code", "count", F.lit(None).cast("string").alias("detail"))


def has_errors(report: DataFrame) -> bool:
    return not report.where("severity = 'error'").isEmpty()
