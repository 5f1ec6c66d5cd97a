"""Registered queries of the core and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import cases, cases_rules, queries_core
from .functions import ids
from .operators import orphans
from .session import table

SIDES = {"source": "source_celex", "target": "target_celex"}


def _orphans(spark, d, period=None):
    return orphans.orphan_references(table(spark, d, "relations"), "id", SIDES, table(spark, d, "works"), "celex_id", period)


def p1_found(spark, d):
    return _orphans(spark, d).select("id", "side").distinct()


def p1_by_year(spark, d):
    """Orphan references per side and year written in the citing id (null where it holds none)."""
    year = F.expr("try_cast(nullif(regexp_extract(upper(source_celex), '^[ \\\\t\\\\u00a0]*[0-9A-Z]([0-9]{4})', 1), '') as int)")
    return orphans.orphans_by_period(_orphans(spark, d, year))


#: Tables whose rows name an act of works, beside the relations: table, its id columns.
CHILDREN = {"text_units": ["id"], "eurovoc": ["eurovoc_uri"], "work_checkpoint": ["status"], "enrichment_checkpoint": ["category"]}


def p1_by_table(spark, d):
    """Orphan references and missing acts per table and per year written in the missing id, of all tables that name acts."""
    year = lambda c: F.expr(f"try_cast(nullif(regexp_extract(upper({c}), '^[ \\\\t\\\\u00a0]*[0-9A-Z]([0-9]{{4}})', 1), '') as int)")
    works, out = table(spark, d, "works"), None
    for name, columns in CHILDREN.items():
        rows = table(spark, d, name).select(F.xxhash64(*columns, "celex_id").alias("id"), "celex_id")
        found = orphans.orphan_references(rows, "id", {name: "celex_id"}, works, "celex_id", year("celex_id"))
        out = found if out is None else out.unionByName(found)
    for side, column in SIDES.items():
        found = orphans.orphan_references(table(spark, d, "relations"), "id", {f"relations.{side}": column}, works, "celex_id", year(column))
        out = out.unionByName(found.withColumn("id", F.col("id").cast("long")))
    return orphans.orphans_by_period(out).withColumnRenamed("side", "table_name")


def p1_reasons(spark, d):
    """Orphan references per side and reason, as far as the checkpoint of the acts tells one."""
    out = orphans.orphan_reasons(_orphans(spark, d), table(spark, d, "work_checkpoint"))
    return out.groupBy("side", "reason").agg(F.count(F.lit(1)).alias("orphan_refs"), F.countDistinct("ref").alias("missing_keys"))


QUERIES = queries_core.Q | cases.QUERIES | cases_rules.QUERIES | {"p1_found": p1_found, "p1_by_year": p1_by_year, "p1_by_table": p1_by_table, "p1_reasons": p1_reasons}

_TRIM = "' ' || chr(9) || chr(160)"
_ORPHANS = f"""with r as (
  select id, 'source' as side, upper(trim(source_celex, {_TRIM})) as ref, try_cast(nullif(regexp_extract(upper(trim(source_celex, {_TRIM})), '^[0-9A-Z]([0-9]{{4}})', 1), '') as integer) as period from relations
  union all
  select id, 'target', upper(trim(target_celex, {_TRIM})), try_cast(nullif(regexp_extract(upper(trim(source_celex, {_TRIM})), '^[0-9A-Z]([0-9]{{4}})', 1), '') as integer) from relations),
o as (select distinct id, side, ref, period from r where ref <> '' and not exists (select 1 from works w where w.celex_id = r.ref))
"""
_CHILD = " union all ".join(
    [f"select distinct '{t}' as table_name, {', '.join(f'cast({c} as varchar) as k' for c in cs)}, upper(trim(celex_id, {_TRIM})) as ref, celex_id as raw from {t}" for t, cs in CHILDREN.items()]
    + [f"select distinct 'relations.{s}', cast(id as varchar), upper(trim({c}, {_TRIM})), {c} from relations" for s, c in SIDES.items()]
)
SQL = queries_core.SQL | cases.SQL | cases_rules.SQL | {
    "p1_reasons": _ORPHANS
    + f""", s as (select upper(trim(celex_id, {_TRIM})) as ref, bool_or(status = 'processed') as done, bool_or(status = 'failed') as failed from work_checkpoint group by 1)
select side, case when not regexp_matches(o.ref, '{ids.VALID_ID[4:]}') then 'malformed' when done then 'dropped' when failed then 'failed' else 'unknown' end as reason, count(*) as orphan_refs, count(distinct o.ref) as missing_keys
from (select distinct id, side, ref from o) o left join s on s.ref = o.ref group by 1, 2""",
    "p1_by_table": f"""with r as ({_CHILD}), o as (select *, try_cast(nullif(regexp_extract(ref, '^[0-9A-Z]([0-9]{{4}})', 1), '') as integer) as period from r where ref <> '' and not exists (select 1 from works w where w.celex_id = r.ref))
select table_name, period, count(*) as orphan_refs, count(distinct ref) as missing_keys from o group by 1, 2""",
    "p1_found": _ORPHANS + "select distinct id, side from o",
    "p1_by_year": _ORPHANS + "select side, period, count(*) as orphan_refs, count(distinct ref) as missing_keys from o group by side, period",
}
