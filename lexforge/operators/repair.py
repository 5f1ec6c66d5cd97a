"""Audits and repairs. Each returns the audit and, unless it is a dry run, the new states; nothing is written here."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import quality
from .store import keep_first
from .structure import profile

PENDING = "repair_pending__"


def pdf_repair(works: DataFrame, units: DataFrame, checkpoint: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Processed works read from PDF: audit (id, tag, hash of the text, units); new works with the tag marked
    pending, new checkpoint without them."""
    hit = works.where("content_source like 'cellar_pdf%'").join(checkpoint.where("status = 'processed'").select("celex_id").distinct(), "celex_id", "left_semi")
    n = units.groupBy("celex_id").agg(F.count(F.lit(1)).alias("unit_count"))
    audit = hit.select("celex_id", "content_source", F.sha2(F.coalesce("full_text", F.lit("")), 256).alias("text_sha256")).join(n, "celex_id", "left")
    audit = audit.withColumn("unit_count", F.coalesce("unit_count", F.lit(0)))
    ids = audit.select("celex_id", F.lit(True).alias("_hit"))
    new = works.join(ids, "celex_id", "left")
    new = new.withColumn("content_source", F.when(F.col("_hit"), F.concat(F.lit(PENDING), "content_source")).otherwise(F.col("content_source"))).drop("_hit")
    return audit, new, checkpoint.join(ids, "celex_id", "left_anti")


def quality_repair(works: DataFrame, units: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """(celex_id, record, scope, reason, action) of failed translations and of the documents asked for."""
    tag = F.col("content_source").like("%\\_\\_translated")
    w = works.where("full_text_original is not null").withColumn("reason", quality.translation_issue(F.col("full_text_original"), F.col("full_text"), True)).where("reason is not null")
    w = w.select("celex_id", F.col("celex_id").alias("record"), F.lit("full_text").alias("scope"), "reason", F.when(tag, "reprocess_work").otherwise("reset_full_text").alias("action"))
    u = units.where("text_translated is not null").withColumn("reason", quality.translation_issue(F.col("text"), F.col("text_translated"))).where("reason is not null")
    u = u.join(works.select("celex_id", "content_source"), "celex_id", "left")
    u = u.select("celex_id", F.col("unit_key").alias("record"), F.lit("unit").alias("scope"), "reason", F.when(tag, "reprocess_work").otherwise("reset_unit").alias("action"))
    out = w.unionByName(u)
    if requested is not None:
        unknown = requested.join(works.select("celex_id"), "celex_id", "left_anti")
        if not unknown.isEmpty():
            raise ValueError(f"{unknown.count()} requested documents are not in the dataset")
        out = out.unionByName(requested.select("celex_id", F.col("celex_id").alias("record"), F.lit("work").alias("scope"), F.lit("requested").alias("reason"), F.lit("reprocess_work").alias("action")))
    return out


def apply_quality_repair(works: DataFrame, units: DataFrame, checkpoint: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Full texts go back to their original, unit translations to null, reprocessed works lose their checkpoint."""
    a = lambda kind: actions.where(F.col("action") == kind)
    full = a("reset_full_text").select("celex_id", F.lit(True).alias("_r")).distinct()
    w = works.join(full, "celex_id", "left")
    w = w.withColumn("full_text", F.when(F.col("_r"), F.col("full_text_original")).otherwise(F.col("full_text")))
    w = w.withColumn("full_text_original", F.when(F.col("_r"), F.lit(None).cast("string")).otherwise(F.col("full_text_original"))).drop("_r")
    one = a("reset_unit").select(F.col("record").alias("unit_key"), F.lit(True).alias("_r")).distinct()
    u = units.join(one, "unit_key", "left")
    u = u.withColumn("text_translated", F.when(F.col("_r"), F.lit(None).cast("string")).otherwise(F.col("text_translated"))).select(*units.columns)
    return w.select(*works.columns), u, checkpoint.join(a("reprocess_work").select("celex_id"), "celex_id", "left_anti")


def structural_regressions(old_units: DataFrame, new_units: DataFrame) -> DataFrame:
    """(celex_id, reasons): fewer articles or annexes than before, or recitals that are only their marker."""
    o, n = (profile(x).select("celex_id", F.col("articles").alias(f"{p}_articles"), F.col("annexes").alias(f"{p}_annexes")) for x, p in ((old_units, "old"), (new_units, "new")))
    marker = new_units.where("type = 'recital' and trim(text) = concat('(', number, ')')").select("celex_id", F.lit(True).alias("marker")).distinct()
    j = o.join(n, "celex_id", "full_outer").join(marker, "celex_id", "full_outer").na.fill(0)
    reasons = F.array_compact(F.array(
        F.when(F.col("marker"), "marker_only_recital"), F.when(F.col("new_articles") < F.col("old_articles"), "article_count_regression"),
        F.when(F.col("new_annexes") < F.col("old_annexes"), "annex_count_regression"),
    ))
    return j.select("celex_id", "old_articles", "new_articles", "old_annexes", "new_annexes", F.array_join(reasons, ",").alias("reasons")).where("reasons <> ''")


def replayed(df: DataFrame, key: str) -> DataFrame:
    """(key, copies, identical) of keys that come more than once."""
    whole = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in df.columns])
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"), (F.countDistinct(whole) == 1).alias("identical")).where("copies > 1")


def drop_replayed(df: DataFrame, key: str) -> DataFrame:
    """Keeps the first of identical copies; different rows under one key are an error."""
    if not replayed(df, key).where("not identical").isEmpty():
        raise ValueError(f"different rows under one {key}")
    return keep_first(df, [key], [F.col(c).asc_nulls_last() for c in df.columns if c != key] or [F.col(key)])


def coverage(ours: DataFrame, theirs: DataFrame, key: str = "celex_id") -> DataFrame:
    """One row: sizes, both, only one side, and the overlap in percent of the other list."""
    a, b = ours.select(key).distinct(), theirs.select(key).distinct()
    j = a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), key, "full_outer")
    both = F.count_if((F.col("a") == 1) & (F.col("b") == 1))
    return j.agg(F.count("a").alias("ours"), F.count("b").alias("theirs"), both.alias("both"), F.count_if(F.col("b").isNull()).alias("only_ours"), F.count_if(F.col("a").isNull()).alias("only_theirs"),
                 F.round(100 * both / F.greatest(F.count("b"), F.lit(1)), 1).alias("overlap_pct"))


def decomposition(units: DataFrame) -> DataFrame:
    """Per document: units of each kind and different articles with paragraphs or points."""
    art = lambda c: F.countDistinct(F.when((F.col("type") == "article") & c, F.col("number")))
    return units.groupBy("celex_id").agg(
        F.count_if(F.col("type") == "recital").alias("recitals"), art(F.lit(True)).alias("articles"),
        art(F.col("paragraph_num").isNotNull()).alias("articles_with_paragraphs"), F.count_if(F.col("point_letter").isNotNull()).alias("points"),
    )
