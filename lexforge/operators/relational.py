"""Joins, set operations, pivots and picks of the reference's data model, as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.ids import LANGUAGES


def substring_join(keywords: DataFrame, labels: DataFrame, keyword: str = "keyword", label: str = "label", max_keywords: int = 100_000) -> DataFrame:
    """Keyword is in label, letter case aside. The keywords are the few side, and their size is checked; beyond it
    keywords and labels meet on their shared three-letter pieces instead, each keyword under its rarest piece, one of
    fewer than three letters under itself. The rows are the same both ways."""
    n = keywords.count()
    hit = F.contains(F.lower(F.col(label)), F.lower(F.col(keyword)))
    if n <= max_keywords:
        return labels.join(F.broadcast(keywords), hit)

    def gram(c: Column, size: int) -> Column:
        low = F.lower(c)
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - (size - 1), F.lit(1))), lambda i: F.substr(low, i, F.lit(size))))

    each, some = labels.select(label).where(F.col(label).isNotNull()).distinct(), keywords.select(keyword).where(F.col(keyword).isNotNull()).distinct()
    g = each.select(label, F.explode(gram(F.col(label), 3)).alias("g"))
    freq = g.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    short = F.length(F.lower(keyword)) < 3
    k = some.where(~short).select(keyword, F.explode(gram(F.col(keyword), 3)).alias("g")).join(freq, "g", "left")
    k = k.groupBy(keyword).agg(F.min_by("g", F.struct(F.coalesce("n", F.lit(0)), F.col("g"))).alias("g"))
    pieces = F.array_distinct(F.concat(F.array(F.lit("")), gram(F.col(label), 1), gram(F.col(label), 2)))
    s = some.where(short).select(keyword, F.lower(keyword).alias("g"))
    pairs = g.join(k, "g").unionByName(each.select(label, F.explode(pieces).alias("g")).join(s, "g")).where(hit).select(label, keyword).distinct()
    return labels.join(pairs, label).join(keywords, keyword).select(*labels.columns, *keywords.columns)


def metadata_rows(works: DataFrame, columns: list[str]) -> DataFrame:
    """(celex_id, data_type, value) of the filled columns: the shape in which a triple store answers."""
    stack = ", ".join(f"'{c}', cast({c} as string)" for c in columns)
    return works.select("celex_id", F.expr(f"stack({len(columns)}, {stack}) as (data_type, value)")).where("value is not null")


def pivot_metadata(rows: DataFrame, columns: list[str], single: str = "min") -> DataFrame:
    """One row an id and a column a data type; of several values the least one, so that reruns agree."""
    pick = F.min if single == "min" else F.max
    return rows.groupBy("celex_id").agg(*[pick(F.when(F.col("data_type") == c, F.col("value"))).alias(c) for c in columns])


def collapse_values(rows: DataFrame, keys: list[str], value: str, sep: str = "; ") -> DataFrame:
    return rows.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(value)), sep).alias(value))


def language_fallback(rows: DataFrame, group: str, lang: str, value: str) -> DataFrame:
    """The value in English, else in the first language of the chain, else in the least language."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(x) for x in LANGUAGES]), F.col(lang)), F.lit(0).cast("long")), F.lit(99))
    return rows.where(F.col(value).isNotNull()).groupBy(group).agg(F.min(F.struct(rank.alias("r"), F.col(lang), F.col(value))).alias("m")).select(group, F.col(f"m.{lang}").alias(lang), F.col(f"m.{value}").alias(value))


def best_candidate(items: DataFrame, group: list[str], name: str, order: str, url: str) -> DataFrame:
    """Of a choice of streams the main text: annexes, covers and corrections only if nothing else is there; a
    name with ACT first, then the least order, then the url."""
    low = F.lower(F.col(name))
    out = low.rlike("annexe|annex|cover|erratum|corrigendum")
    score = F.coalesce(F.col(order), F.lit(999)) - F.when(F.upper(F.col(name)).contains("ACT"), 1000).otherwise(0)
    return items.groupBy(*group).agg(F.min_by(F.col(url), F.struct(out.cast("int"), F.when(out, F.coalesce(F.col(order), F.lit(999))).otherwise(score), F.col(url))).alias(url))


def negotiate(attempts: DataFrame) -> DataFrame:
    """attempts (id, lang, fmt, status, empty): the first success in language order, HTML before PDF; without one
    'retry' if any attempt failed for a passing reason, else 'missing'. After a passing failure of a PDF no other
    PDF counts."""
    kind = (
        F.when((F.col("status") == 200) & ~F.col("empty"), "ok")
        .when((F.col("status") == 429) | (F.col("status") >= 500) | F.col("status").isNull(), "transient")
        .otherwise("unavailable")
    )
    lang = F.array_position(F.array(*[F.lit(x) for x in LANGUAGES]), F.col("lang"))
    fmt = F.when(F.col("fmt") == "html", 0).otherwise(1)
    d = attempts.withColumn("kind", kind).withColumn("rank", lang * 2 + fmt).where("rank >= 2")
    w = Window.partitionBy("id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    blocked = F.coalesce(F.max(F.when((F.col("fmt") == "pdf") & (F.col("kind") == "transient"), 1)).over(w), F.lit(0))
    d = d.withColumn("ok", (F.col("kind") == "ok") & ~((F.col("fmt") == "pdf") & (blocked == 1)))
    g = d.groupBy("id").agg(F.min(F.when(F.col("ok"), F.struct("rank", "lang", "fmt"))).alias("m"), F.bool_or(F.col("kind") == "transient").alias("t"))
    return g.select("id", F.col("m.lang").alias("lang"), F.col("m.fmt").alias("fmt"), F.when(F.col("m").isNotNull(), "ok").when(F.col("t"), "retry").otherwise("missing").alias("outcome"))


def procedures_to_ids(rows: DataFrame) -> DataFrame:
    """rows (procedure, work, proposal): the adopted work of each row, else its proposal (PC, no bracket)."""
    p = F.when(F.col("proposal").contains("PC") & ~F.col("proposal").contains("("), F.col("proposal"))
    return rows.select("procedure", F.coalesce("work", p).alias("celex_id")).where("celex_id is not null").distinct()


def concept_info(rows: DataFrame) -> DataFrame:
    """rows (concept, data_type, value): one row a concept with the least definition and the sorted labels around it."""
    many = lambda k: F.array_sort(F.collect_set(F.when(F.col("data_type") == k, F.col("value")))).alias(k)
    return rows.groupBy("concept").agg(F.min(F.when(F.col("data_type") == "definition", F.col("value"))).alias("definition"), many("broader"), many("narrower"), many("related"))


def set_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """(key, side): both, left, right."""
    j = a.distinct().withColumn("a", F.lit(1)).join(b.distinct().withColumn("b", F.lit(1)), a.columns[0], "full_outer")
    return j.select(a.columns[0], F.when(F.col("a").isNull(), "right").when(F.col("b").isNull(), "left").otherwise("both").alias("side"))


def original_recitals(units: DataFrame, originals: DataFrame) -> DataFrame:
    """Recitals of consolidated acts by those of the original act, translations carried by number."""
    tr = units.where("type = 'recital'").groupBy("celex_id", "number").agg(F.max("text_translated").alias("_t"))
    new = originals.where("type = 'recital'").join(tr, ["celex_id", "number"], "left").withColumn("text_translated", F.coalesce("_t", "text_translated")).drop("_t")
    has = new.select("celex_id").distinct()
    rest = units.join(has.withColumn("_h", F.lit(True)), "celex_id", "left").where("type <> 'recital' or _h is null").drop("_h")
    return rest.select(*units.columns).unionByName(new.select(*units.columns))


def provenance(base: Column, pdf_fallback: Column | None = None, articles: Column | None = None, backend: Column | None = None, translated: Column | None = None) -> Column:
    """The tag of where a text came from, composed in order."""
    out = base
    if pdf_fallback is not None:
        out = F.when(pdf_fallback.isNotNull(), F.concat(out, F.lit("__"), pdf_fallback)).otherwise(out)
    if articles is not None:
        out = F.when(articles, F.concat(out, F.lit("__pymupdf_articles"))).otherwise(out)
    if backend is not None:
        out = F.when(backend.isNotNull(), F.concat(out, F.lit("__pymupdf_"), backend)).otherwise(out)
    if translated is not None:
        out = F.when(translated, F.concat(out, F.lit("__translated"))).otherwise(out)
    return out


def parse_provenance(tag: Column) -> dict[str, Column]:
    return {
        "pending": F.coalesce(tag.startswith("repair_pending__"), F.lit(False)),
        "format": F.nullif(F.regexp_extract(tag, "cellar_(html|pdf)_", 1), F.lit("")),
        "lang": F.nullif(F.regexp_extract(tag, "cellar_(?:html|pdf)_([a-z]{3})", 1), F.lit("")),
        "reason": F.nullif(F.regexp_extract(tag, "__pymupdf_([a-z]+)", 1), F.lit("")),
        "translated": F.coalesce(tag.endswith("__translated"), F.lit(False)),
    }


def drop_empty_units(units: DataFrame) -> DataFrame:
    return units.where("coalesce(trim(text), '') <> '' or coalesce(trim(title), '') <> ''")


