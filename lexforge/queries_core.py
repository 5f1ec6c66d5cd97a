"""Registered queries of the reference's own operators over its tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .functions import ids, quality, text as T
from .operators import relational as R, repair, store, structure, validate as V
from .session import spread, table

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def wrap(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return wrap


def _t(spark, d, *names):
    out = [table(spark, d, n) for n in names]
    return out[0] if len(out) == 1 else out


def _all(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {n: table(spark, d, n) for n in V.NEEDED}


def _units(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The text units without replayed rows: only the columns asked for and the id are read and grouped."""
    return table(spark, d, "text_units").select("id", *columns).distinct()


# --- order, keys, profiles -------------------------------------------------------------------------------
_UNITS = "(select distinct * from text_units)"
_POS = "coalesce(unit_order, 1000000), id"


@query(f"select id, celex_id, row_number() over (partition by celex_id order by {_POS}) as pos from {_UNITS}")
def unit_rows(spark, d):
    u = _units(spark, d, "celex_id", "unit_order").select("id", "celex_id", F.coalesce("unit_order", F.lit(1_000_000)).alias("o"))
    return structure.Spread("celex_id", F.col("o"), [F.col("o"), F.col("id")]).row_number(u, "pos").drop("o")


_P = lambda c: f"coalesce(nullif({c}, ''), '-')"
_KEY = f"celex_id || ':' || type || ':' || {_P('number')} || ':' || {_P('paragraph_num')} || ':' || {_P('subparagraph_num')} || ':' || {_P('point_letter')}"


@query(
    f"""with a as (select id, celex_id, {_KEY} as base, row_number() over (partition by celex_id order by {_POS}) as o from {_UNITS}),
b as (select *, row_number() over (partition by base order by o) as k from a)
select id, o as unit_order, case when k > 1 then base || ':' || k else base end as unit_key from b"""
)
def unit_keys(spark, d):
    u = _units(spark, d, "celex_id", "type", "number", "paragraph_num", "subparagraph_num", "point_letter", "unit_order")
    u = u.withColumn("pos", F.coalesce("unit_order", F.lit(1_000_000))).drop("unit_order")
    return structure.number_units(u, ties=("id",)).select("id", F.col("unit_order").cast("long"), "unit_key")


@query(
    f"""select celex_id, count(*) filter (type = 'recital') as recitals, count(distinct coalesce(number, 'unnumbered')) filter (type = 'article') as articles,
count(distinct coalesce(number, 'unnumbered')) filter (type = 'annex') as annexes, count(*) filter (type = 'body') as bodies, count(*) as units from {_UNITS} group by celex_id"""
)
def structure_profile(spark, d):
    return structure.profile(_units(spark, d, "celex_id", "type", "number"))


@query(
    f"""with a as (select celex_id, case when lower(number) = 'sole' then 'sole' else regexp_replace(lower(number), '[a-z]+$', '') end as base, min(unit_order) as pl from {_UNITS} where type = 'article' group by 1, 2),
r as (select *, row_number() over (partition by celex_id order by pl nulls first, base nulls first) as k from a)
select celex_id, count(*) as articles, bool_and(coalesce(try_cast(base as integer) = k, false)) or (count(*) = 1 and min(base) = 'sole') as complete from r group by celex_id"""
)
def sequence_complete(spark, d):
    return structure.sequence_complete(_units(spark, d, "celex_id", "type", "number", "unit_order"))


@query(
    f"""select id, celex_id, last_value(title ignore nulls) over (partition by celex_id order by {_POS} rows between unbounded preceding and current row) as heading,
count(*) filter (type = 'article') over (partition by celex_id order by {_POS} rows between unbounded preceding and current row) as section from {_UNITS}"""
)
def heading_context(spark, d):
    u = _units(spark, d, "celex_id", "title", "type", "unit_order").withColumn("o", F.coalesce("unit_order", F.lit(1_000_000))).drop("unit_order")
    h = structure.carried(u, "celex_id", ["o", "id"], F.col("title"), "heading")
    return structure.Spread("celex_id", F.col("o"), [F.col("o"), F.col("id")]).running_count(h, F.col("type") == "article", "section").select("id", "celex_id", "heading", "section")


@query(
    f"""select id, type = 'article' and unit_order = max(case when type = 'article' then unit_order end) over (partition by celex_id) as is_last from {_UNITS} where unit_order is not null and celex_id is not null"""
)
def last_article(spark, d):
    u = _units(spark, d, "celex_id", "type", "unit_order").where("unit_order is not null and celex_id is not null")
    return structure.last_of_type(u, "article").select("id", "is_last")


@query(
    f"""with u as (select celex_id, count(*) filter (type <> 'body') as s, count(*) filter (type = 'body') as b from {_UNITS} group by celex_id),
w as (select w.celex_id, content_source, coalesce(length(full_text) > 0, false) as has, s, b from works w left join u using (celex_id)),
t as (select content_source, count(*) as n from works where content_source is not null group by 1 order by n desc, 1 limit 1)
select (select count(*) from w where s > 0) as structured, (select count(*) from w where s = 0 and b > 0) as body_only,
(select count(*) from w where has and s is null) as text_without_units, (select count(*) from w where not has) as without_text, t.content_source as top_source, t.n as top_count from t"""
)
def extraction_stats(spark, d):
    return structure.extraction_stats(_t(spark, d, "works"), _units(spark, d, "celex_id", "type"))


@query(
    """with l as (select celex_id, unnest(string_split(full_text, chr(10))) as line from works where full_text is not null)
select celex_id, count(*) filter (trim(line) <> '') as lines, count(*) filter (starts_with(line, 'Article ')) as article_lines from l group by celex_id"""
)
def line_counts(spark, d):
    w = _t(spark, d, "works").where("full_text is not null")
    l = w.select("celex_id", F.explode(F.split("full_text", "\n")).alias("line"))
    return l.groupBy("celex_id").agg(F.count_if(F.trim("line") != "").alias("lines"), F.count_if(F.col("line").startswith("Article ")).alias("article_lines"))


# --- ids and types ---------------------------------------------------------------------------------------
_CODE = "regexp_replace(substr(celex_id, 6, 2), '[0-9]+$', '')"
_NAME = f"case {_CODE} " + " ".join(f"when '{k}' then '{v}'" for k, v in ids.DOC_TYPES.items()) + " else 'unknown' end"


@query(
    f"""select celex_id, regexp_matches(celex_id, '(?i){ids.VALID_ID[4:]}') as valid, starts_with(celex_id, '0') as consolidated, regexp_matches(celex_id, 'R\\([0-9]+\\)$') as corrigendum,
case when starts_with(celex_id, '0') then '3' || substr(split_part(celex_id, '-', 1), 2) else celex_id end as original, {_CODE} as type_code, {_NAME} as doc_type,
case when {_NAME} in ('regulation','directive','decision') then 'structural' when {_NAME} in ('communication','proposal','staff working document') then 'com' else 'text' end as route,
try_cast(substr(celex_id, 2, 4) as integer) as year from works"""
)
def celex_ids(spark, d):
    c = F.col("celex_id")
    t = ids.document_type(c)
    return _t(spark, d, "works").select(
        "celex_id", ids.is_valid_id(c).alias("valid"), ids.is_consolidated(c).alias("consolidated"), ids.is_corrigendum(c).alias("corrigendum"),
        ids.original_id(c).alias("original"), ids.type_code(c).alias("type_code"), t.alias("doc_type"), ids.route(t).alias("route"), ids.year_of(c).alias("year"),
    )


@query(
    f"""select distinct celex_id from works where (({_CODE} = 'R' and starts_with(celex_id, '3')) or ({_CODE} = 'DC' and starts_with(celex_id, '5')))
and date_adopted between date '1980-01-01' and date '2015-12-31' and not regexp_matches(celex_id, 'R\\([0-9]+\\)$') and not starts_with(celex_id, '0')"""
)
def discover_ids(spark, d):
    return ids.discover(_t(spark, d, "works"), ["regulation", "communication", "no such type"], "1980-01-01", "2015-12-31")


@query(
    """select distinct celex_id from works w where substr(celex_id, 6, 1) = 'R' and starts_with(celex_id, '3') and date_adopted between date '1960-01-01' and date '2030-01-01'
and exists (select 1 from eurovoc e where e.celex_id = w.celex_id and e.eurovoc_uri in (select eurovoc_uri from eurovoc group by 1 order by count(*) desc, 1 limit 3))"""
)
def discover_by_concept(spark, d):
    w, e = _t(spark, d, "works", "eurovoc")
    top = [r[0] for r in e.groupBy("eurovoc_uri").count().orderBy(F.desc("count"), "eurovoc_uri").limit(3).collect()]
    return ids.discover(w, ["regulation"], "1960-01-01", "2030-01-01", top, corrigenda=True, consolidated=True, descriptors=e)


# --- text functions --------------------------------------------------------------------------------------
@query("select celex_id, sha256(full_text) as h, length(full_text) as n from works where full_text is not null")
def content_sha256(spark, d):
    return _t(spark, d, "works").where("full_text is not null").select("celex_id", T.sha256(F.col("full_text")).alias("h"), F.length("full_text").cast("long").alias("n"))


@query("select celex_id, trim(regexp_replace(replace(title, chr(173), ''), '[\\s\\x{00A0}\\x{2000}-\\x{200A}\\x{202F}\\x{3000}]+', ' ', 'g')) as title from works where title is not null")
def normalised_titles(spark, d):
    return _t(spark, d, "works").where("title is not null").select("celex_id", T.collapse(F.col("title")).alias("title"))


@query("select id, length(regexp_replace(text, '[^\\p{L}]', '', 'g')) as letters, length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) as alnum from (select distinct id, text from text_units where text is not null)")
def letter_count(spark, d):
    u = _t(spark, d, "text_units").where("text is not null").select("id", "text").distinct()
    return u.select("id", T.letters(F.col("text")).cast("long").alias("letters"), T.alphanumerics(F.col("text")).cast("long").alias("alnum"))


_LET = "length(regexp_replace(text, '[^\\p{L}]', '', 'g'))"
_STRIP = "regexp_replace(text, '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g')"


@query(f"select id from (select distinct id, coalesce(text, '') as text from text_units) where length({_STRIP}) = 0 or {_LET} < 3 or (length({_STRIP}) >= 20 and {_LET} < 0.08 * length({_STRIP}))")
def low_information_units(spark, d):
    u = _t(spark, d, "text_units").select("id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    return u.where(T.low_information(F.col("text"))).select("id")


_ENDS = "|".join([*T.BINDING, *(x + "\\b" for x in T.SIGNED), T.SIGNED_AT, T.JOURNAL_REFERENCE])
_bp = f"rtrim(regexp_replace(full_text, '(?s)(?:{_ENDS}).*$', ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160))"
_bp = f"rtrim(regexp_replace({_bp}, '-{{3,}}$', ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160))"


@query(f"select celex_id, sha256({_bp}) as h from works where full_text is not null")
def boilerplate_strip(spark, d):
    w = _t(spark, d, "works").where("full_text is not null")
    return w.select("celex_id", T.sha256(T.strip_boilerplate(F.col("full_text"))).alias("h"))


@query(
    "select id, regexp_replace(regexp_replace(t, '(?s)\\s*\\(\\s*\\d+\\s*\\)\\s*OJ\\s.*$', ''), '\\s+$', '') as body, case when length(regexp_replace(t, '^\\s+|\\s+$', '', 'g')) <= 30 then 'subheading' end as subtype from (select distinct id, text || ' (3) OJ L 12, p. 4' as t from text_units where type = 'recital' and text is not null)"
)
def recital_tail(spark, d):
    u = _t(spark, d, "text_units").where("type = 'recital' and text is not null").select("id", F.concat("text", F.lit(" (3) OJ L 12, p. 4")).alias("t")).distinct()
    return u.select("id", T.recital_tail(F.col("t")).alias("body"), T.recital_subtype(F.col("t")).alias("subtype"))


@query("select distinct eurovoc_uri, regexp_extract(eurovoc_uri, '[^/:]*$') as tail, upper(coalesce(eurovoc_label, '')) as label from eurovoc where eurovoc_uri is not null")
def uri_tails(spark, d):
    both = F.concat_ws("|", F.regexp_replace("eurovoc_uri", ":", "/"), F.coalesce("eurovoc_label", F.lit("")))
    uri, label = T.split_label(both)
    return _t(spark, d, "eurovoc").where("eurovoc_uri is not null").select("eurovoc_uri", T.uri_tail(uri).alias("tail"), F.upper(label).alias("label")).distinct()


@query("select id, len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+(?:[''’\\-][\\p{L}\\p{N}]+)*')) as tokens from (select distinct id, text from text_units where text is not null)")
def word_token_counts(spark, d):
    u = _t(spark, d, "text_units").where("text is not null").select("id", "text").distinct()
    return u.select("id", F.size(T.word_tokens(F.col("text"))).cast("long").alias("tokens"))


@query("select id, 1 + len(regexp_extract_all(text, '[.;]\\s+[\\p{Lu}(]')) as sentences from (select distinct id, text from text_units where text is not null)")
def sentence_counts(spark, d):
    u = _t(spark, d, "text_units").where("text is not null").select("id", "text").distinct()
    return u.select("id", F.size(T.sentences(F.col("text"))).alias("sentences"))


@query(
    """select celex_id, try_cast(v as date) as as_date, try_cast(y as bigint) as as_integer, lower(b) in ('true', '1') as as_boolean from
(select celex_id, cast(date_adopted as varchar) as v, substr(celex_id, 2, 4) as y, cast(is_in_force as varchar) as b from works)"""
)
def typed_literals(spark, d):
    w = _t(spark, d, "works")
    lit = lambda c, k, n: T.typed_literal(c.cast("string"), F.lit(f"http://www.w3.org/2001/XMLSchema#{k}"))[n]
    return w.select("celex_id", lit(F.col("date_adopted"), "date", "as_date").alias("as_date"), lit(F.substring("celex_id", 2, 4), "gYear", "as_integer").alias("as_integer"), lit(F.col("is_in_force"), "boolean", "as_boolean").alias("as_boolean"))


# --- joins and sets --------------------------------------------------------------------------------------
@query("select u.id, w.language, w.document_type from (select distinct id, celex_id from text_units) u join works w using (celex_id) where w.language <> 'eng'")
def foreign_units(spark, d):
    w, u = _t(spark, d, "works", "text_units")
    return u.select("id", "celex_id").distinct().join(w.where("language <> 'eng'").select("celex_id", "language", "document_type"), "celex_id").select("id", "language", "document_type")


@query("select distinct c.celex_id from work_checkpoint c left join works w on w.celex_id = c.celex_id where c.status = 'processed' and w.celex_id is null")
def checkpoint_without_work(spark, d):
    w, c = _t(spark, d, "works", "work_checkpoint")
    return c.where("status = 'processed'").select("celex_id").distinct().join(w.select("celex_id"), "celex_id", "left_anti")


@query("select w.celex_id from works w where not exists (select 1 from work_checkpoint c where c.celex_id = w.celex_id)")
def work_without_checkpoint(spark, d):
    w, c = _t(spark, d, "works", "work_checkpoint")
    return w.select("celex_id").join(c.select("celex_id"), "celex_id", "left_anti")


@query("select w.celex_id, count(u.id) as units from works w left join (select distinct id, celex_id from text_units) u using (celex_id) group by w.celex_id")
def units_per_work(spark, d):
    w, u = _t(spark, d, "works", "text_units")
    n = u.groupBy("celex_id").agg(F.countDistinct("id").alias("n"))
    return w.select("celex_id").join(n, "celex_id", "left").select("celex_id", F.coalesce("n", F.lit(0).cast("long")).alias("units"))


@query(
    """select w.celex_id from works w where exists (select 1 from relations r where r.source_celex = w.celex_id and r.relation_type = 'repeals')
or exists (select 1 from eurovoc e where e.celex_id = w.celex_id) and w.language = 'fra' or not exists (select 1 from text_units u where u.celex_id = w.celex_id)"""
)
def or_exists(spark, d):
    w, r, e, u = _t(spark, d, "works", "relations", "eurovoc", "text_units")
    flag = lambda df, k, n: df.select(F.col(k).alias("celex_id")).distinct().withColumn(n, F.lit(True))
    j = w.join(flag(r.where("relation_type = 'repeals'"), "source_celex", "a"), "celex_id", "left").join(flag(e, "celex_id", "b"), "celex_id", "left").join(flag(u, "celex_id", "c"), "celex_id", "left")
    return j.where("a or (b and language = 'fra') or c is null").select("celex_id")


@query("select distinct k.keyword, e.eurovoc_label as label from (values ('dairy'), ('NOISE'), ('quota'), ('xx')) k(keyword) join eurovoc e on contains(lower(e.eurovoc_label), lower(k.keyword))")
def keyword_concepts(spark, d):
    k = spark.createDataFrame([("dairy",), ("NOISE",), ("quota",), ("xx",)], "keyword string")
    labels = _t(spark, d, "eurovoc").select(F.col("eurovoc_label").alias("label")).where("label is not null").distinct()
    return R.substring_join(k, labels).select("keyword", "label")


@query("select coalesce(a.k, b.k) as celex_id, case when a.k is null then 'right' when b.k is null then 'left' else 'both' end as side from (select distinct celex_id as k from works) a full join (select distinct celex_id as k from work_checkpoint where celex_id is not null) b on a.k = b.k")
def id_set_overlap(spark, d):
    w, c = _t(spark, d, "works", "work_checkpoint")
    return R.set_overlap(w.select("celex_id"), c.where("celex_id is not null").select("celex_id"))


@query("(select celex_id from works intersect select celex_id from eurovoc) except select celex_id from enrichment_checkpoint")
def id_set_algebra(spark, d):
    w, e, c = _t(spark, d, "works", "eurovoc", "enrichment_checkpoint")
    return w.select("celex_id").intersect(e.select("celex_id")).subtract(c.select("celex_id"))


@query("select 'cites' as kind, source_celex as id from relations where relation_type = 'cites' union select 'amends', source_celex from relations where relation_type = 'amends' union select 'label', celex_id from eurovoc")
def union_branches(spark, d):
    r, e = _t(spark, d, "relations", "eurovoc")
    one = lambda k: r.where(F.col("relation_type") == k).select(F.lit(k).alias("kind"), F.col("source_celex").alias("id"))
    return one("cites").unionByName(one("amends")).unionByName(e.select(F.lit("label").alias("kind"), F.col("celex_id").alias("id"))).distinct()


@query(
    """with p as (select distinct procedure_reference as procedure, celex_id from works where procedure_reference is not null),
r as (select coalesce(w.procedure, q.procedure) as procedure, w.celex_id as work, q.celex_id as proposal from (select * from p where substr(celex_id, 6, 2) <> 'PC') w
full join (select * from p where substr(celex_id, 6, 2) = 'PC') q on w.procedure = q.procedure)
select distinct procedure, coalesce(work, case when contains(proposal, 'PC') and not contains(proposal, '(') then proposal end) as celex_id from r where work is not null or (contains(proposal, 'PC') and not contains(proposal, '('))"""
)
def procedure_ids(spark, d):
    w = _t(spark, d, "works").where("procedure_reference is not null").select(F.col("procedure_reference").alias("procedure"), "celex_id").distinct()
    pc = F.substring("celex_id", 6, 2) == "PC"
    rows = w.where(~pc).withColumnRenamed("celex_id", "work").join(w.where(pc).withColumnRenamed("celex_id", "proposal"), "procedure", "full_outer")
    return R.procedures_to_ids(rows)


# --- aggregates ------------------------------------------------------------------------------------------
@query("select source_celex, target_celex, relation_type, count(*) as n from relations group by all having count(*) > 1")
def duplicate_relations(spark, d):
    r = _t(spark, d, "relations")
    return r.groupBy("source_celex", "target_celex", "relation_type").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


_META = ["author", "subject_matter", "procedure_type", "eli"]


@query(
    """with r as (select celex_id, 'author' as t, author as v from works union all select celex_id, 'subject_matter', subject_matter from works union all select celex_id, 'procedure_type', procedure_type from works union all select celex_id, 'eli', eli from works)
select celex_id, min(v) filter (t = 'author') as author, min(v) filter (t = 'subject_matter') as subject_matter, min(v) filter (t = 'procedure_type') as procedure_type, min(v) filter (t = 'eli') as eli from r where v is not null group by celex_id"""
)
def metadata_pivot(spark, d):
    return R.pivot_metadata(R.metadata_rows(_t(spark, d, "works"), _META), _META)


@query("select celex_id, string_agg(distinct eurovoc_label, '; ' order by eurovoc_label) as eurovoc_label from eurovoc where eurovoc_label is not null group by celex_id")
def multi_value_collapse(spark, d):
    return R.collapse_values(_t(spark, d, "eurovoc").where("eurovoc_label is not null"), ["celex_id"], "eurovoc_label")


@query(
    """with r as (select substr(celex_id, 2, 4) as year, language, title, coalesce(nullif(list_position(['eng','fra','deu','ita','nld','spa'], language), 0), 99) as k from works where title is not null),
q as (select *, row_number() over (partition by year order by k, language nulls first, title) as n from r) select year, language, title from q where n = 1"""
)
def title_fallback(spark, d):
    w = _t(spark, d, "works").withColumn("year", F.substring("celex_id", 2, 4))
    return R.language_fallback(w, "year", "language", "title")


@query("select status, count(*) as n from work_checkpoint group by status")
def checkpoint_summary(spark, d):
    return store.checkpoint_summary(_t(spark, d, "work_checkpoint"))


@query(
    """with r as (select distinct source_celex, target_celex as url, case when relation_type like '%repeals' then 'L_annex_' || relation_type else 'L_' || relation_type || case when relation_type = 'adopts' then '_act' else '' end end as name, case when id % 5 > 0 then id % 5 end as o from relations where source_celex is not null and target_celex is not null),
s as (select *, case when contains(name, 'annex') then 1 else 0 end as out, coalesce(o, 999) - case when not contains(name, 'annex') and contains(upper(name), 'ACT') then 1000 else 0 end as score from r),
q as (select *, row_number() over (partition by source_celex order by out, score, url) as n from s) select source_celex, url from q where n = 1"""
)
def best_candidate(spark, d):
    """Relations as a choice of streams: repeals stand for annexes, adoptions for the act."""
    r = _t(spark, d, "relations").where("source_celex is not null and target_celex is not null")
    name = F.when(F.col("relation_type").endswith("repeals"), F.concat(F.lit("L_annex_"), "relation_type")).otherwise(F.concat(F.lit("L_"), "relation_type", F.when(F.col("relation_type") == "adopts", "_act").otherwise("")))
    items = r.select("source_celex", name.alias("name"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("o"), F.col("target_celex").alias("url")).distinct()
    return R.best_candidate(items, ["source_celex"], "name", "o", "url")


@query(
    """select celex_id, case when coalesce(starts_with(content_source, 'repair_pending__'), false) then true else false end as pending, nullif(regexp_extract(content_source, 'cellar_(html|pdf)_', 1), '') as format,
nullif(regexp_extract(content_source, 'cellar_(?:html|pdf)_([a-z]{3})', 1), '') as lang, nullif(regexp_extract(content_source, '__pymupdf_([a-z]+)', 1), '') as reason, coalesce(ends_with(content_source, '__translated'), false) as translated from works"""
)
def provenance_tags(spark, d):
    return _t(spark, d, "works").select("celex_id", *[c.alias(k) for k, c in R.parse_provenance(F.col("content_source")).items()])


# --- store -----------------------------------------------------------------------------------------------
_OWNED = "('repeals', 'implicitly_repeals')"


@query(
    f"""with ids as (select celex_id from works where substr(celex_id, 6, 1) = 'R'), r as (select * from relations),
gone as (select id from r where source_celex in (select celex_id from ids) and relation_type not in {_OWNED}),
kept as (select source_celex, target_celex, relation_type from r where id not in (select id from gone)),
new as (select distinct source_celex, upper(target_celex) as target_celex, relation_type from r where source_celex is not null and target_celex is not null and relation_type is not null and relation_type = 'cites' and source_celex in (select celex_id from ids))
select * from kept union all select n.* from new n where n.source_celex in (select celex_id from works) and not exists (select 1 from kept k where k.source_celex = n.source_celex and k.target_celex = n.target_celex and k.relation_type = n.relation_type)"""
)
def relation_refresh(spark, d):
    w, r = _t(spark, d, "works", "relations")
    ids_ = w.where("substring(celex_id, 6, 1) = 'R'").select("celex_id")
    batch = r.join(ids_.withColumnRenamed("celex_id", "source_celex"), "source_celex", "left_semi").where("relation_type = 'cites'").select("source_celex", F.upper("target_celex").alias("target_celex"), "relation_type")
    return store.save_relations(r, batch, ids_, w)


@query(
    """with b as (select celex_id, 'failed' as status, 'again' as error, max(timestamp) + interval 1 day as timestamp from work_checkpoint where substr(celex_id, 6, 1) = 'L' group by celex_id),
u as (select *, 0 as s from work_checkpoint union all select *, 1 from b), q as (select *, row_number() over (partition by celex_id order by timestamp desc nulls last, s desc, status nulls last, error nulls last) as n from u)
select celex_id, status, error, cast(epoch_us(timestamp) as bigint) as us from q where n = 1"""
)
def checkpoint_upsert(spark, d):
    c = _t(spark, d, "work_checkpoint")
    b = c.where("substring(celex_id, 6, 1) = 'L'").groupBy("celex_id").agg((F.max("timestamp") + F.expr("interval 1 day")).alias("timestamp")).select("celex_id", F.lit("failed").alias("status"), F.lit("again").alias("error"), "timestamp")
    return store.upsert(c, b, ["celex_id"]).select("celex_id", "status", "error", F.unix_micros("timestamp").alias("us"))


@query(
    """with n as (select celex_id, substr(celex_id, 6, 1) = 'R' as fetched, upper(title) as title, language from works where substr(celex_id, 6, 1) in ('R', 'L'))
select w.celex_id, case when n.fetched then n.title else coalesce(n.title, w.title) end as title, case when n.fetched then n.language else w.language end as language, case when n.fetched then 'new' else w.content_source end as content_source, w.author from works w left join n using (celex_id)"""
)
def works_upsert(spark, d):
    w = _t(spark, d, "works")
    n = w.where("substring(celex_id, 6, 1) in ('R', 'L')").withColumns({"fetched": F.substring("celex_id", 6, 1) == "R", "title": F.upper("title"), "content_source": F.lit("new")})
    return store.save_works(w, n).select("celex_id", "title", "language", "content_source", "author")


@query("select id, celex_id, text from text_units u where not exists (select 1 from works w where w.celex_id = u.celex_id and w.language = 'fra') union all select distinct id, u.celex_id, upper(text) from text_units u join works w on w.celex_id = u.celex_id where w.language = 'fra' and type = 'article'")
def replace_units_by_doc(spark, d):
    w, u = _t(spark, d, "works", "text_units")
    ids_ = w.where("language = 'fra'").select("celex_id")
    batch = u.join(ids_, "celex_id", "left_semi").where("type = 'article'").select("id", "celex_id", F.upper("text").alias("text")).distinct()
    return store.replace_by_key(u.select("id", "celex_id", "text"), batch, ids_)


@query("select distinct celex_id from works w where not exists (select 1 from work_checkpoint c where c.celex_id = w.celex_id and c.status = 'processed') order by 1 limit 50")
def resume_remaining_limit(spark, d):
    w, c = _t(spark, d, "works", "work_checkpoint")
    return store.remaining(w, c, 50)


@query(
    """with w as (select celex_id, c from works, (values (1, 'metadata'), (2, 'relations'), (3, 'eurovoc')) t(k, c)), m as (select celex_id, c, case c when 'metadata' then 1 when 'relations' then 2 else 3 end as k from w where not exists (select 1 from enrichment_checkpoint e where e.celex_id = w.celex_id and e.category = w.c))
select celex_id, string_agg(c, ',' order by k) as missing from m group by celex_id"""
)
def missing_category_worklist(spark, d):
    w, e = _t(spark, d, "works", "enrichment_checkpoint")
    return store.missing_categories(w, e)


@query(
    """select celex_id, category, cast(epoch_us(timestamp) as bigint) as us from enrichment_checkpoint union all
select celex_id, c, cast(epoch_us(enriched_at) as bigint) from works w, (values ('metadata'), ('relations'), ('eurovoc')) t(c) where enriched_at is not null and not exists (select 1 from enrichment_checkpoint e where e.celex_id = w.celex_id)"""
)
def legacy_backfill(spark, d):
    w, e = _t(spark, d, "works", "enrichment_checkpoint")
    return store.legacy_backfill(w, e).select("celex_id", "category", F.unix_micros("timestamp").alias("us"))


@query(
    """with s as (select celex_id, 'X' as author, enriched_at + (case when substr(celex_id, 6, 1) = 'R' then interval 1 day else interval (-1) day end) as at from works where enriched_at is not null)
select w.celex_id, case when s.at > w.enriched_at then s.author else w.author end as author, cast(epoch_us(case when s.at > w.enriched_at then s.at else w.enriched_at end) as bigint) as us from works w left join s using (celex_id)"""
)
def import_newer_enrichment(spark, d):
    w = _t(spark, d, "works")
    s = w.withColumn("author", F.lit("X")).withColumn("enriched_at", F.expr("enriched_at + case when substring(celex_id, 6, 1) = 'R' then interval 1 day else interval -1 day end"))
    return store.import_enrichment(w, s).select("celex_id", "author", F.unix_micros("enriched_at").alias("us"))


@query("with q as (select *, row_number() over (partition by id order by celex_id nulls last, text nulls last) as n from text_units) select id, celex_id, text from q where n = 1")
def keep_first_duplicate(spark, d):
    u = _t(spark, d, "text_units")
    return store.keep_first(u, ["id"], [F.col("celex_id").asc_nulls_last(), F.col("text").asc_nulls_last()]).select("id", "celex_id", "text")


@query("select id, count(*) as copies, count(distinct coalesce(source_celex, chr(1)) || chr(2) || coalesce(target_celex, chr(1)) || chr(2) || coalesce(relation_type, chr(1))) = 1 as identical from relations group by id having count(*) > 1")
def replayed_rows(spark, d):
    return repair.replayed(_t(spark, d, "relations"), "id")


# --- validation and repair -------------------------------------------------------------------------------
_V = {
    "duplicate_work_id": "select celex_id from works group by 1 having count(*) > 1",
    "duplicate_text_unit_id": "select id from text_units group by 1 having count(*) > 1",
    "duplicate_relation_id": "select id from relations group by 1 having count(*) > 1",
    "duplicate_checkpoint_id": "select celex_id from work_checkpoint group by 1 having count(*) > 1",
    "checkpoint_without_work": "select 1 from work_checkpoint c left join works w using (celex_id) where c.status = 'processed' and w.celex_id is null",
    "work_without_checkpoint": "select 1 from works w where not exists (select 1 from work_checkpoint c where c.celex_id = w.celex_id)",
    "orphan_text_unit": "select 1 from text_units u where not exists (select 1 from works w where w.celex_id = u.celex_id)",
    "orphan_relation_source": "select 1 from relations u where not exists (select 1 from works w where w.celex_id = u.source_celex)",
    "orphan_eurovoc": "select 1 from eurovoc u where not exists (select 1 from works w where w.celex_id = u.celex_id)",
    "orphan_enrichment_checkpoint": "select 1 from enrichment_checkpoint u where not exists (select 1 from works w where w.celex_id = u.celex_id)",
    "duplicate_relation": "select 1 from relations group by source_celex, target_celex, relation_type having count(*) > 1",
    "duplicate_eurovoc": "select 1 from eurovoc group by celex_id, eurovoc_uri having count(*) > 1",
    "duplicate_unit_key": "select 1 from text_units where unit_key is not null group by unit_key having count(*) > 1",
    "duplicate_unit_order": "select 1 from text_units where unit_order is not null group by celex_id, unit_order having count(*) > 1",
    "missing_unit_identity": "select 1 from text_units where unit_order is null or unit_key is null",
    "marker_only_recital": "select 1 from text_units where type = 'recital' and trim(text) = '(' || number || ')'",
    "translated_fallback_marker_gap": "select 1 from text_units u join works w using (celex_id) where ends_with(w.content_source, '__translated') and u.type <> 'recital' and coalesce(u.text_translated, '') = ''",
    "pending_pdf_repair": "select 1 from works where starts_with(content_source, 'repair_pending__')",
    "untranslated_non_english_unit": "select 1 from text_units u join works w using (celex_id) where w.language <> 'eng' and coalesce(u.text, '') <> '' and coalesce(u.text_translated, '') = ''",
    "works_without_content": "select 1 from works where coalesce(full_text, '') = ''",
    "failed_checkpoints": "select 1 from work_checkpoint where status = 'failed'",
    "structural_body_fallback": "select distinct u.celex_id from text_units u join works w using (celex_id) where w.document_type in ('regulation', 'directive', 'decision') and u.type = 'body'",
    "content_without_text_units": "select 1 from works w where coalesce(full_text, '') <> '' and not exists (select 1 from text_units u where u.celex_id = w.celex_id)",
    "unextractable_document_type": "select 1 from works where document_type is null or document_type not in ('regulation', 'directive', 'decision', 'communication', 'proposal', 'staff working document')",
}
_WARN = {"untranslated_non_english_unit", "works_without_content", "failed_checkpoints", "structural_body_fallback", "unextractable_document_type"}


@query("select * from (" + " union all ".join(f"select '{'warning' if c in _WARN else 'error'}' as severity, '{c}' as code, (select count(*) from ({s})) as count, cast(null as varchar) as detail" for c, s in _V.items()) + ") where count > 0")
def validation_report(spark, d):
    return V.validate(_all(spark, d), set(_V))


@query()
def validation_full(spark, d):
    """All checks, with those on translations that SQL cannot express."""
    return V.validate(_all(spark, d))


@query(
    """with h as (select celex_id, content_source, sha256(coalesce(full_text, '')) as text_sha256 from works w where starts_with(content_source, 'cellar_pdf') and exists (select 1 from work_checkpoint c where c.celex_id = w.celex_id and c.status = 'processed'))
select h.*, (select count(*) from text_units u where u.celex_id = h.celex_id) as unit_count from h"""
)
def pdf_repair_audit(spark, d):
    return repair.pdf_repair(*_t(spark, d, "works", "text_units", "work_checkpoint"))[0]


@query(
    f"""with n as (select * from {_UNITS} where not (type = 'article' and number = '3') and not (type = 'annex' and number = 'II')),
p as (select celex_id, count(distinct coalesce(number, 'unnumbered')) filter (type = 'article') as a, count(distinct coalesce(number, 'unnumbered')) filter (type = 'annex') as x from {_UNITS} group by 1),
q as (select celex_id, count(distinct coalesce(number, 'unnumbered')) filter (type = 'article') as a, count(distinct coalesce(number, 'unnumbered')) filter (type = 'annex') as x from n group by 1),
m as (select distinct celex_id from n where type = 'recital' and trim(text) = '(' || number || ')'),
j as (select celex_id, coalesce(p.a, 0) as old_articles, coalesce(q.a, 0) as new_articles, coalesce(p.x, 0) as old_annexes, coalesce(q.x, 0) as new_annexes, m.celex_id is not null as mk from p left join q using (celex_id) left join m using (celex_id))
select celex_id, old_articles, new_articles, old_annexes, new_annexes, concat_ws(',', case when mk then 'marker_only_recital' end, case when new_articles < old_articles then 'article_count_regression' end, case when new_annexes < old_annexes then 'annex_count_regression' end) as reasons
from j where mk or new_articles < old_articles or new_annexes < old_annexes"""
)
def structural_regression(spark, d):
    u = _units(spark, d, "celex_id", "type", "number", "text")
    return repair.structural_regressions(u, u.where("not (type = 'article' and coalesce(number, '') = '3') and not (type = 'annex' and coalesce(number, '') = 'II')"))


@query(
    """with a as (select distinct celex_id from works), b as (select distinct celex_id from eurovoc where celex_id is not null)
select (select count(*) from a) as ours, (select count(*) from b) as theirs, (select count(*) from a join b using (celex_id)) as both, (select count(*) from a where celex_id not in (select celex_id from b)) as only_ours, (select count(*) from b where celex_id not in (select celex_id from a)) as only_theirs, round(100.0 * (select count(*) from a join b using (celex_id)) / (select count(*) from b), 1)::double as overlap_pct"""
)
def coverage(spark, d):
    w, e = _t(spark, d, "works", "eurovoc")
    return repair.coverage(w, e.where("celex_id is not null"))


@query(f"select celex_id, count(*) filter (type = 'recital') as recitals, count(distinct number) filter (type = 'article') as articles, count(distinct number) filter (type = 'article' and paragraph_num is not null) as articles_with_paragraphs, count(*) filter (point_letter is not null) as points from {_UNITS} group by celex_id")
def decomposition(spark, d):
    return repair.decomposition(_units(spark, d, "celex_id", "type", "number", "paragraph_num", "point_letter"))


# --- translation quality ---------------------------------------------------------------------------------
@query(
    """with p as (select distinct id, regexp_replace(text, '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g') as s, regexp_replace(coalesce(text_translated, ''), '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g') as o, text from text_units where text is not null),
q as (select id, length(s) as ls, length(o) as lo, length(regexp_replace(text, '[^\\p{L}]', '', 'g')) as l from p)
select id, case when lo = 0 then 'empty_output' when ls >= 20 and lo >= 200 and lo > 4 * ls then 'excessive_expansion' when ls >= 100 and l >= 40 and lo < 0.25 * ls then 'severe_contraction' end as issue from q"""
)
def translation_ratio_flags(spark, d):
    u = _t(spark, d, "text_units").where("text is not null").select("id", "text", "text_translated").distinct()
    return u.select("id", quality.translation_issue(F.col("text"), F.col("text_translated"), False, False).alias("issue"))


_GRAMS = ", ".join(f"g{k} as (select doc_id, max(c) as c from (select doc_id, w[i:i+{k - 1}] as g, count(*) as c from d, unnest(range(1, greatest(len(w) - {k - 2}, 1))) u(i) group by all) group by 1)" for k in (1, 2, 3, 4))


@query(
    f"""with d as (select distinct doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+(?:[''’\\-][\\p{{L}}\\p{{N}}]+)*') as w from documents where text is not null),
t as (select doc_id, w[i] as x, i - row_number() over (partition by doc_id, w[i] order by i) as g from d, unnest(range(1, len(w) + 1)) u(i)),
r as (select doc_id, max(c) as run from (select doc_id, x, g, count(*) as c from t group by all) group by 1), {_GRAMS}
select doc_id, coalesce(len(w) >= 10 and (run >= 10 or (len(w) >= 30 and ((g1.c >= 20 and g1.c >= 0.4 * len(w)) or {" or ".join(f"(g{k}.c >= 8 and {k} * g{k}.c >= 0.4 * len(w))" for k in (2, 3, 4))}))), false) as repetitive
from d left join r using (doc_id) {" ".join(f"left join g{k} using (doc_id)" for k in (1, 2, 3, 4))}"""
)
def repetition_flags(spark, d):
    """The repetition rule of each document's own text against an empty source."""
    docs = _t(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", quality.repeats(F.array().cast("array<string>"), T.word_tokens(F.col("text"))).alias("repetitive"))


@query(
    f"""with p as (select celex_id, count(*) filter (type = 'recital') as r, count(distinct coalesce(number, 'unnumbered')) filter (type = 'article') as a, count(*) filter (type = 'body') as b, count(*) as n from {_UNITS} group by 1)
select w.celex_id, coalesce(language <> 'eng' and document_type in ('regulation', 'directive', 'decision') and (coalesce(r, 0) < 3 or coalesce(a, 0) = 0), false) as fallback,
coalesce(n, 0) = 0 or n = b or coalesce(a, 0) = 0 or (coalesce(r, 0) = 0 and coalesce(a, 0) > 0) as pdf_retry from works w left join p using (celex_id)"""
)
def fallback_triggers(spark, d):
    w, u = _t(spark, d, "works"), _units(spark, d, "celex_id", "type", "number")
    p = w.select("celex_id", "language", "document_type").join(structure.profile(u), "celex_id", "left").na.fill(0, ["recitals", "articles", "annexes", "bodies", "units"])
    c = F.col
    return p.select("celex_id", F.coalesce(quality.needs_fallback(c("language"), c("document_type"), c("recitals"), c("articles"), c("annexes")), F.lit(False)).alias("fallback"), quality.needs_pdf_retry(c("units"), c("bodies"), c("articles"), c("recitals")).alias("pdf_retry"))


# --- structure readers (no SQL can say them) ---------------------------------------------------------------
def _exploded(df: DataFrame, units) -> DataFrame:
    """The array once into a column, then one row a unit."""
    u = df.select("celex_id", units.alias("us")).select("celex_id", F.posexplode("us").alias("pos", "u"))
    return u.select("celex_id", "pos", "u.*")


@query()
def html_units(spark, d):
    from .functions.html_units import html_units as f

    return _exploded(_t(spark, d, "works").where("full_text_html is not null"), f(F.col("full_text_html"), "point"))


@query()
def html_blocks(spark, d):
    from .functions.tree import html_blocks as f

    w = _t(spark, d, "works").where("full_text_html is not null")
    return w.select("celex_id", F.explode(f(F.col("full_text_html"))).alias("b")).select("celex_id", "b.*")


@query("select celex_id, trim(regexp_replace(regexp_replace(full_text_html, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) as full_text from works where full_text_html is not null")
def html_full_text(spark, d):
    from .functions.tree import html_full_text as f

    return _t(spark, d, "works").where("full_text_html is not null").select("celex_id", f(F.col("full_text_html")).alias("full_text"))


@query()
def markdown_units(spark, d):
    """Structural acts read from PDF."""
    from .functions.markdown_units import md_units

    w = spread(_t(spark, d, "works").where("full_text is not null and content_source like '%pdf%'").select("celex_id", "document_type", "full_text"))
    return _exploded(w.where(ids.route(F.col("document_type")) == "structural"), md_units(F.col("full_text"), "paragraph"))


@query()
def com_units(spark, d):
    from .functions.com_units import com_text_units

    w = _t(spark, d, "works").where("full_text is not null")
    return _exploded(w.where(ids.route(F.col("document_type")) == "com"), com_text_units(F.col("full_text")))


def _split(granularity):
    def f(spark, d):
        from .functions.splitter import split_units

        u = _units(spark, d, "type", "number", "title", "text").where("type = 'article' and text is not null")
        parts = split_units(F.array("text"), F.col("number"), F.col("title"), granularity, True)
        return u.select("id", parts.alias("us")).select("id", F.posexplode("us").alias("pos", "u")).select("id", "pos", "u.*")

    return f


for _g in ("article", "paragraph", "point"):
    Q[f"split_article_{_g}"] = _split(_g)
SQL["split_article_article"] = (
    "select id, 0 as pos, 'article' as type, cast(null as varchar) as subtype, number, cast(null as varchar) as paragraph_num, cast(null as varchar) as subparagraph_num, cast(null as varchar) as point_letter, title, "
    "regexp_replace(text, '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g') as text, cast(null as varchar) as text_translated from (select distinct id, number, title, text from text_units where type = 'article' and text is not null)"
)


@query()
def parsed_dataset(spark, d):
    """The reading plan over all works with text: route, parse, tidy, number."""
    from .plans import pipeline

    w = _t(spark, d, "works").where("full_text is not null")
    c = spread(w.select("celex_id", "document_type", F.lit("text").alias("content_type"), F.col("full_text").alias("body")))
    return pipeline.tidy_units(pipeline.parse_units(c)).drop("pos")




@query(
    """with a as (select source_celex as id, (row_number() over (partition by source_celex order by id, target_celex nulls first) - 1) as k, id % 7 as s from (select distinct * from relations) where source_celex is not null),
r as (select id, k, case when s = 0 then 503 when s < 5 then 404 else 200 end as status from a where k < 12),
b as (select *, coalesce(max(case when k % 2 = 1 and status >= 500 then 1 end) over (partition by id order by k rows between unbounded preceding and 1 preceding), 0) as blocked from r),
m as (select id, min(k) filter (status = 200 and not (k % 2 = 1 and blocked = 1)) as best, bool_or(status >= 500) as t from b group by id)
select id, case when best is null then null else ['eng','fra','deu','ita','nld','spa'][best // 2 + 1] end as lang, case when best is null then null when best % 2 = 0 then 'html' else 'pdf' end as fmt, case when best is not null then 'ok' when t then 'retry' else 'missing' end as outcome from m"""
)
def content_negotiation(spark, d):
    r = _t(spark, d, "relations").where("source_celex is not null").distinct()
    k = F.row_number().over(Window.partitionBy("source_celex").orderBy("id", F.col("target_celex").asc_nulls_first())) - 1
    lang = F.element_at(F.array(*[F.lit(x) for x in ids.LANGUAGES]), F.floor(F.col("k") / 2).cast("int") + 1)
    status = F.when(F.col("id") % 7 == 0, 503).when(F.col("id") % 7 < 5, 404).otherwise(200)
    a = r.withColumn("k", k).where("k < 12").select(F.col("source_celex").alias("id"), lang.alias("lang"), F.when(F.col("k") % 2 == 0, "html").otherwise("pdf").alias("fmt"), status.alias("status"), F.lit(False).alias("empty"))
    return R.negotiate(a)


# --- streams -----------------------------------------------------------------------------------------------
@query("select date_trunc('day', collected_at) as day, count(*) as arrivals from documents where collected_at is not null group by 1")
def arrivals_stream(spark, d):
    """The documents as a stream, counted per day of event time by Structured Streaming."""
    import uuid

    from .session import shared_folder
    from .streaming import landing

    docs = _t(spark, d, "documents")
    stream = spark.readStream.schema(docs.schema).parquet(f"{d}/documents.parquet*").select("celex_id", F.col("collected_at").alias("arrived_at"))
    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    landing.counted(landing.arrivals_per_window(stream, "1 day", "3650 days"), f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return landing.latest_counts(spark, f"{at}/out").select(F.col("window.start").alias("day"), "arrivals")


# --- reports, ledgers, decoding ----------------------------------------------------------------------------
@query("select 'missing_content' as report, celex_id, document_type as detail from works where content_source is null union all select 'non_english', celex_id, language from works where language is not null and language <> 'eng'")
def run_reports(spark, d):
    r = store.reports(_t(spark, d, "works"))
    a = r["missing_content"].select(F.lit("missing_content").alias("report"), "celex_id", F.col("document_type").alias("detail"))
    return a.unionByName(r["non_english"].select(F.lit("non_english").alias("report"), "celex_id", F.col("language").alias("detail")))


@query("select celex_id, error from work_checkpoint where status = 'failed'")
def failed_documents(spark, d):
    return store.failures(_t(spark, d, "work_checkpoint"))


@query("select celex_id, status from work_checkpoint where status <> 'failed' or status is null")
def reset_failed(spark, d):
    return store.reset(_t(spark, d, "work_checkpoint"), "failed").select("celex_id", "status")


@query(
    """with l as (select 'full_text' as scope, celex_id as record_id, case when length(full_text) % 2 = 0 then sha256(full_text) else 'stale' end as source_sha256, case when length(full_text) % 3 = 0 then 1 else 2 end as policy_version from works where full_text is not null
union all select 'unit', unit_key, sha256(text), 2 from (select distinct unit_key, text from text_units where unit_key is not null and text is not null and type = 'recital'))
select scope, record_id from l where policy_version = 2 and (
 exists (select 1 from works w where l.scope = 'full_text' and w.celex_id = l.record_id and w.language <> 'eng' and sha256(w.full_text) = l.source_sha256)
 or exists (select 1 from text_units u join works w using (celex_id) where l.scope = 'unit' and w.language <> 'eng' and u.unit_key = l.record_id and sha256(u.text) = l.source_sha256))"""
)
def ledger_invalidation(spark, d):
    w, u = _t(spark, d, "works", "text_units")
    n = F.length("full_text")
    a = w.where("full_text is not null").select(F.lit("full_text").alias("scope"), F.col("celex_id").alias("record_id"), F.when(n % 2 == 0, F.sha2("full_text", 256)).otherwise("stale").alias("source_sha256"), F.when(n % 3 == 0, 1).otherwise(2).alias("policy_version"))
    b = u.where("unit_key is not null and text is not null and type = 'recital'").select("unit_key", "text").distinct()
    b = b.select(F.lit("unit").alias("scope"), F.col("unit_key").alias("record_id"), F.sha2("text", 256).alias("source_sha256"), F.lit(2).alias("policy_version"))
    return store.current_failures(a.unionByName(b), w, u, 2).select("scope", "record_id")


@query(
    """with ok as (select celex_id from enrichment_checkpoint group by celex_id having count(distinct category) = 3)
select w.celex_id, w.author, w.subject_matter, w.eli, w.is_in_force, w.date_entry_into_force from works w join ok using (celex_id)
where w.author is not null or w.subject_matter is not null or w.eli is not null or w.is_in_force is not null or w.date_entry_into_force is not null"""
)
def enrichment_decode(spark, d):
    """Catalogue rows made from the works, with a sentinel a finished category; documents lacking one are refused."""
    from .plans.pipeline import decode_enrichment

    w, e = _t(spark, d, "works", "enrichment_checkpoint")
    rows = R.metadata_rows(w, ["author", "subject_matter", "eli", "is_in_force", "date_entry_into_force"])
    done = e.where("category is not null").select("celex_id", F.concat(F.lit("zz_complete_"), "category").alias("data_type"), F.lit("1").alias("value")).distinct()
    meta = decode_enrichment(rows.unionByName(done))[0].select("celex_id", "author", "subject_matter", "eli", "is_in_force", "date_entry_into_force")
    some = F.coalesce("author", "subject_matter", "eli", F.col("is_in_force").cast("string"), F.col("date_entry_into_force").cast("string")).isNotNull()
    return meta.where(some).join(w.select("celex_id"), "celex_id", "left_semi")


_LINE_SQL = "with l as (select celex_id, trim(unnest(string_split(full_text, chr(10))), ' ' || chr(13) || chr(9)) as line from works where full_text is not null) "


@query(
    _LINE_SQL
    + "select celex_id, case "
    + " ".join(f"when regexp_matches(line, '{p}') then '{k}'" for k, p in T.HEADINGS.items())
    + " end as kind, count(*) as n from l where line <> '' group by all"
)
def heading_kinds(spark, d):
    w = _t(spark, d, "works").where("full_text is not null")
    l = w.select("celex_id", F.explode(F.split("full_text", "\n")).alias("line")).select("celex_id", F.regexp_replace("line", "^[ \\r\\t]+|[ \\r\\t]+$", "").alias("line")).where("line <> ''")
    return l.groupBy("celex_id", T.heading_kind(F.col("line")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("select celex_id, contains(lower(substr(x, 1, 500)), '<html') or contains(lower(substr(x, 1, 500)), '<div') or contains(lower(substr(x, 1, 500)), '<!doctype') as html, starts_with(x, '%PDF-') as pdf from (select celex_id, coalesce(full_text_html, full_text) as x from works) where x is not null")
def content_sniff(spark, d):
    w = _t(spark, d, "works").select("celex_id", F.coalesce("full_text_html", "full_text").alias("x")).where("x is not null")
    return w.select("celex_id", T.looks_like_html(F.col("x")).alias("html"), T.looks_like_pdf(F.encode("x", "UTF-8")).alias("pdf"))


@query(
    """with n as (select distinct celex_id, type, lower(coalesce(number, '')) as num from text_units where type = 'article'),
b as (select * from n where celex_id not in (select celex_id from works where language = 'eng') or num in ('1', '2')), 
s as (select celex_id, count(*) as o from n group by 1), q as (select celex_id, count(*) as c from b group by 1)
select s.celex_id, case when s.o > coalesce(c, 0) then s.o else c end as articles from s left join q using (celex_id) where s.celex_id is not null"""
)
def merge_structures(spark, d):
    """English acts cut down to their first two articles are completed from the full ones; others are as they are."""
    w, u = _t(spark, d, "works"), _units(spark, d, "celex_id", "type", "number", "title", "text")
    full = u.where("type = 'article' and celex_id is not null")
    eng = w.where("language = 'eng'").select("celex_id", F.lit(True).alias("e"))
    base = full.join(eng, "celex_id", "left").where("e is null or lower(coalesce(number, '')) in ('1', '2')").drop("e")
    solid = full.withColumn("text", F.coalesce("text", F.lit("")))
    merged = structure.merge_units(base, solid.withColumn("title", F.lit("abc")))
    return merged.groupBy("celex_id").agg(F.countDistinct(F.lower(F.coalesce("number", F.lit("")))).alias("articles"))
