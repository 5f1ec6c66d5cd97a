"""Registered queries of the llm operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import spread, table
from . import cooccurrence, eval_leaks, mixing, near_duplicates, noise, repetition, shared_spans, splitting

#: Texts of the two tables: table, key, text.
TEXTS = (("works", "celex_id", "full_text"), ("text_units", "id", "text"))


def _both(spark: SparkSession, d: str, f) -> DataFrame:
    parts = [f(spread(table(spark, d, t).select(k, x)), t, k, x).withColumn("table_name", F.lit(t)) for t, k, x in TEXTS]
    return reduce(DataFrame.unionByName, parts)


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """Both tables as (table_name, key, text), for operators that tell scopes apart."""
    parts = [table(spark, d, t).select(F.lit(t).alias("table_name"), F.col(k).cast("string").alias("key"), F.col(x).alias("text")) for t, k, x in TEXTS]
    return spread(reduce(DataFrame.unionByName, parts))


def _documents(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text", *columns))


def p2_found(spark, d):
    links, members = near_duplicates.near_duplicates(_texts(spark, d), "key", "text", threshold=0.6, shingle=3, min_words=25, scope="table_name")
    return near_duplicates.expand_pairs(links, members).withColumnRenamed("scope", "table_name").select("table_name", "key_a", "key_b")


def p2_groups(spark, d):
    """Group of every record that is like another one, or its copy, at the usual setting (five words, 0.8)."""
    out = near_duplicates.groups(_texts(spark, d), "key", "text", scope="table_name")
    return out.select(F.col("scope").alias("table_name"), F.col("key").alias("record_key"), "group_key", "group_size")


LIMITS = {"works": 8000, "text_units": 2000}


def p3_found(spark, d):
    f = lambda df, t, k, x: splitting.split_oversized(df, k, x, LIMITS[t], once=False).where("piece = 1 and pieces > 1").select("key").distinct()
    return _both(spark, d, f).select("table_name", F.col("key").alias("record_key"))


def p3_pieces(spark, d):
    f = lambda df, t, k, x: splitting.split_oversized(df, k, x, LIMITS[t])
    return _both(spark, d, f).select("table_name", F.col("key").alias("record_key"), "piece", "pieces", "start", "text")


def p3_whole(spark, d):
    """Whether the pieces of each record keep the limit, share 100 characters with the piece before and make up its text."""
    out = p3_pieces(spark, d).withColumn("limit", F.when(F.col("table_name") == "works", LIMITS["works"]).otherwise(LIMITS["text_units"]))
    own = F.when(F.col("piece") == 1, F.col("text")).otherwise(F.substring("text", 101, 1 << 30))
    begins = F.struct(F.col("piece"), F.substring("text", 1, 100).alias("head"), F.expr("right(text, 100)").alias("tail"), own.alias("own"))
    g = out.groupBy("table_name", "record_key").agg(F.array_sort(F.collect_list(begins)).alias("p"), F.max(F.length("text") - F.col("limit")).alias("over"))
    n = F.size("p")
    follow = F.forall(F.sequence(F.lit(2), n), lambda i: F.element_at(F.col("p"), i)["head"] == F.element_at(F.col("p"), i - 1)["tail"])
    whole = F.array_join(F.transform("p", lambda x: x["own"]), "")
    return g.select("table_name", "record_key", (F.col("over") <= 0).alias("within"), follow.alias("shares"), F.length(whole).cast("long").alias("length"), F.md5(whole).alias("digest"))


def p4_found(spark, d):
    return cooccurrence.labels_together(table(spark, d, "eurovoc"), "celex_id", "eurovoc_label").select("label_a", "label_b")


def p4_pairs(spark, d):
    return cooccurrence.labels_together(table(spark, d, "eurovoc"), "celex_id", "eurovoc_label", 1, 0.0)


def _noise(spark, d, repaired):
    model = noise.fit(_texts(spark, d).select("text"))
    return _both(spark, d, lambda df, t, k, x: noise.scanned_noise(df, k, x, repaired, model))


def p5_found(spark, d):
    return _noise(spark, d, False).select("table_name", F.col("key").alias("record_key"), "noise")


def p5_repaired(spark, d):
    return _noise(spark, d, True).select("table_name", F.col("key").alias("record_key"), "noise", "text")


def p6_found(spark, d):
    out = shared_spans.records_with_shared_span(_texts(spark, d), "key", "text", 30, "table_name")
    return out.select(F.col("scope").alias("table_name"), F.col("key").alias("record_key"))


def p6_shared(spark, d):
    out = shared_spans.shared_spans(_texts(spark, d), "key", "text", 30, "table_name")
    return out.select(F.col("scope").alias("table_name"), F.col("key").alias("record_key"), "tokens", "shared_tokens", "shared_share", "level")


def _leaks(spark, d):
    return eval_leaks.leaked_items(_documents(spark, d), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text", 15)


def p7_found(spark, d):
    return _leaks(spark, d).where("kind = 'verbatim'").select("doc_id", "item_id")


def p7_leaks(spark, d):
    """Verbatim and re-parameterised leaks."""
    return _leaks(spark, d)


def _vocabulary(spark) -> str:
    """The vocabulary file that the session names, else the one of this box."""
    return spark.conf.get("spark.lexforge.tokenizer", "/opt/tokenizers/byte_bpe_50k.tiktoken")


def _mix(spark, d):
    return mixing.mix_sources(_documents(spark, d, "source"), "doc_id", "text", "source", table(spark, d, "mix_targets"), _vocabulary(spark))


def p8_mix(spark, d):
    return _mix(spark, d)[0]


def p8_shares(spark, d):
    return _mix(spark, d)[1]


def p8_kept(spark, d):
    """Of each source: whether no record is used too often, whether the selected tokens are those of its blocks but for a
    document a shard, and whether no other source that holds more had a better claim to its last block."""
    chosen, report = _mix(spark, d)
    t = table(spark, d, "mix_targets").select(F.lower(F.trim(F.regexp_replace("source", "[\\t\\u00a0]", " "))).alias("source"), F.coalesce("max_repeats", F.lit(1)).alias("most"))
    used = chosen.groupBy("source").agg(F.max("uses").alias("uses"), F.max("tokens").alias("longest"))
    r = report.join(t, "source").join(used, "source", "left").na.fill(0, ["uses", "longest"])
    capped = (F.col("blocks") + 1) * 1024 > F.col("most") * F.col("available_tokens")
    best = r.where(~capped).agg(F.coalesce(F.max(F.col("target_share") / (2 * F.col("blocks") + 1)), F.lit(0.0)).alias("next"))
    r = r.crossJoin(F.broadcast(best))  # one row
    shards = F.ceil(F.col("available_tokens") / 20_000_000)
    return r.select(
        "source", "target_share", (F.col("uses") <= F.col("most")).alias("uses_kept"),
        (F.abs(F.col("selected_tokens") - 1024 * F.col("blocks")) <= shards * F.col("longest")).alias("quota_kept"),
        ((F.col("blocks") == 0) | (F.col("target_share") / (2 * F.col("blocks") - 1) >= F.col("next") - 1e-12)).alias("apportioned"),
    )


def p9_found(spark, d):
    return repetition.repetitive(_documents(spark, d, "lang"), "doc_id", "text", "lang")


def p9_scores(spark, d):
    return repetition.judge(_documents(spark, d, "lang"), "doc_id", "text", "lang").select("doc_id", "lang", "words", "windows", "share", "verdict")


def p9_shares(spark, d):
    """Words, windows of five words and the share of repeated ones of every document."""
    s = repetition.scores(_documents(spark, d, "lang"), "doc_id", "text", "lang")
    return s.select("doc_id", "words", "windows", F.round("share", 6).alias("share")).distinct()


QUERIES = {
    f.__name__: f
    for f in (p2_found, p2_groups, p3_found, p3_pieces, p3_whole, p4_found, p4_pairs, p5_found, p5_repaired, p6_found, p6_shared, p7_found, p7_leaks, p8_mix, p8_shares, p8_kept, p9_found, p9_scores, p9_shares)
}

_E = """with e as (select distinct upper(trim(celex_id, ' ' || chr(9) || chr(160))) as r,
  trim(regexp_replace(lower(eurovoc_label), '[ \\t\\x{00A0}]+', ' ', 'g')) as x from eurovoc
  where celex_id is not null and eurovoc_label is not null),
f as (select r, x from e where r <> '' and x <> ''), n as (select x, count(*) as n from f group by x),
t as (select count(distinct r) as t from f),
p as (select a.x as label_a, b.x as label_b, count(*) as c from f a join f b on a.r = b.r and a.x < b.x group by 1, 2)
"""
_W = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"
_ROWS_SQL = "select distinct 'works' as tn, celex_id as k, full_text as text from works where full_text is not null and celex_id is not null union all select distinct 'text_units', cast(id as varchar), text from text_units where text is not null and id is not null"
_P2 = f"""with r as ({_ROWS_SQL}), w as (select tn, k, {_W} as w from r),
g as (select distinct tn, k, hash(w[i:i+2]) as h from w, unnest(range(1, len(w) - 1)) u(i) where len(w) >= 25),
n as (select tn, k, count(*) as n from g group by tn, k),
c as (select a.tn, a.k as ka, b.k as kb, count(*) as c from g a join g b on a.tn = b.tn and a.h = b.h and a.k < b.k group by 1, 2, 3)
select c.tn as table_name, ka as key_a, kb as key_b from c join n x on x.tn = c.tn and x.k = ka join n y on y.tn = c.tn and y.k = kb where c >= 0.6 * (x.n + y.n - c)"""
_P6 = f"""with r as ({_ROWS_SQL}), w as (select tn, k, regexp_extract_all(text, '[^ \\t\\n\\r]+') as w from r),
g as (select distinct tn, k, hash(w[i:i+29]) as h from w, unnest(range(1, greatest(len(w) - 28, 1))) u(i) where len(w) >= 30),
s as (select tn, h from g group by tn, h having count(distinct k) > 1)
select distinct tn as table_name, k as record_key from g join s using (tn, h)"""
_P2_GROUPS = f"""with recursive r as ({_ROWS_SQL}), w as (select tn, k, {_W} as w from r),
g as (select distinct tn, k, hash(w[i:i+4]) as h from w, unnest(range(1, len(w) - 3)) u(i) where len(w) >= 5),
n as (select tn, k, count(*) as n from g group by tn, k),
c as (select a.tn, a.k as ka, b.k as kb, count(*) as c from g a join g b on a.tn = b.tn and a.h = b.h and a.k <> b.k group by 1, 2, 3),
e as (select c.tn, ka, kb from c join n x on x.tn = c.tn and x.k = ka join n y on y.tn = c.tn and y.k = kb where c >= 0.8 * (x.n + y.n - c)),
t as (select tn, ka, kb from e union select t.tn, t.ka, e.kb from t join e on t.tn = e.tn and t.kb = e.ka)
select tn as table_name, ka as record_key, min(kb) as group_key, count(*) as group_size from t group by 1, 2"""
_LEVELS = (30, 60, 120, 240, 480, 960, 1920, 3840, 7680, 15360)
_P6_SHARED = (
    f"""with r as ({_ROWS_SQL}), w as (select tn, k, regexp_extract_all(text, '[^ \t\n\r]+') as w from r),
g as (select tn, k, i, hash(w[i:i+29]) as h from w, unnest(range(1, greatest(len(w) - 28, 1))) u(i) where len(w) >= 30),
s as (select tn, h from g group by tn, h having count(distinct k) > 1),
c as (select distinct tn, k, i from g join s using (tn, h)),
e as (select tn, k, least(30, coalesce(i - lag(i) over (partition by tn, k order by i), 30)) as n from c),
t as (select tn, k, sum(n) as shared_tokens from e group by tn, k),
v as (select w.tn, w.k, w.w from w join t on t.tn = w.tn and t.k = w.k),
"""
    + ", ".join(
        f"g{n} as (select tn, k, hash(w[i:i+{n - 1}]) as h from v, unnest(range(1, greatest(len(w) - {n - 2}, 1))) u(i) where len(w) >= {n}), "
        f"l{n} as (select distinct tn, k, {n} as level from g{n} join (select tn, h from g{n} group by tn, h having count(distinct k) > 1) using (tn, h))"
        for n in _LEVELS
    )
    + ", x as (select tn, k, max(level) as level from ("
    + " union all ".join(f"select * from l{n}" for n in _LEVELS)
    + """) group by tn, k)
select t.tn as table_name, t.k as record_key, len(v.w) as tokens, shared_tokens, round(shared_tokens / len(v.w), 6) as shared_share, level from t join v on v.tn = t.tn and v.k = t.k join x on x.tn = t.tn and x.k = t.k"""
)
_P7_LEAKS = f"""with a as (select unnest(regexp_extract_all(text, '(?:[.?!:] *)?[\\p{{L}}\\p{{N}}]+')[2:]) as w from eval_items where text is not null),
inner_ as (select w from a where not regexp_matches(w, '^[.?!:]')),
names as (select distinct lower(w) as l from inner_ where regexp_full_match(w, '\\p{{Lu}}\\p{{Ll}}+') and lower(w) not in (select w from inner_ where lower(w) = w)),
b as (select 'd' as t, doc_id as id, {_W} as w from documents where text is not null union all select 'i', item_id, {_W} from eval_items where text is not null),
k as (select t, id, i, w[i] as x, case when regexp_full_match(w[i], '[0-9]+') then '#1' when l is not null then '#2' when w[i] in ({', '.join(f"'{u}'" for u in eval_leaks.UNITS)}) then '#3' else w[i] end as c
 from b cross join unnest(range(1, len(w) + 1)) u(i) left join names on l = w[i]),
l as (select t, id, list(c order by i) as cs, list(case when starts_with(c, '#') then x else '' end order by i) as ss from k group by t, id),
win as (select t, id, i, hash(cs[i:i+14]) as h, ss[i:i+14] as s from l, unnest(range(1, greatest(len(cs) - 13, 1))) u(i) where len(cs) >= 15),
hits as (select distinct d.id, e.id as item, d.i - e.i as copy, d.s as ds, e.s as es from win d join win e on d.t = 'd' and e.t = 'i' and d.h = e.h),
v as (select distinct id, item from hits where ds = es),
p as (select distinct id, item, copy, ds[j] as x, es[j] as y from hits, unnest(range(1, 16)) u(j) where ds[j] <> ''),
o as (select id, item, copy, count(*) as n, count(distinct x) as nx, count(distinct y) as ny, bool_or(x <> y) as other from p group by 1, 2, 3),
r as (select distinct id, item from o where other and n = nx and n = ny)
select id as doc_id, item as item_id, 'verbatim' as kind from v union all select r.id, r.item, 'reparameterised' from r anti join v on v.id = r.id and v.item = r.item"""
SQL = {
    "p7_leaks": _P7_LEAKS,
    "p2_groups": _P2_GROUPS,
    "p6_shared": _P6_SHARED,
    "p8_kept": "select lower(trim(source, ' ' || chr(9) || chr(160))) as source, target_share, true as uses_kept, true as quota_kept, true as apportioned from mix_targets",
    "p9_shares": f"""with d as (select distinct doc_id, {_W} as w from documents union select doc_id, [] from documents where text is null),
g as (select doc_id, len(w) as words, greatest(len(w) - 4, 0) as windows, list_unique([hash(w[k:k+4]) for k in range(1, greatest(len(w) - 3, 1))]) as u from d where w is not null)
select distinct doc_id, words, windows, case when windows = 0 then 0.0 else round(1 - u / windows, 6) end as share from g""",
    "p3_found": "select distinct 'works' as table_name, celex_id as record_key from works where length(full_text) > 8000 and celex_id is not null union all select distinct 'text_units', cast(id as varchar) from text_units where length(text) > 2000 and id is not null",
    "p3_whole": """with r as (select distinct 'works' as table_name, celex_id as record_key, full_text as t from works where length(full_text) > 8000 and celex_id is not null
union all select 'text_units', cast(id as varchar), min(text) from text_units where length(text) > 2000 and id is not null group by id)
select table_name, record_key, true as within, true as shares, length(t) as length, md5(t) as digest from r""",
    "p4_found": _E + "select label_a, label_b from p join n na on na.x = label_a join n nb on nb.x = label_b, t where c >= 5 and c * t >= 3 * na.n * nb.n",
    "p4_pairs": _E
    + """select label_a, label_b, c as n_both, na.n as n_a, nb.n as n_b, t as n_records, round(c::double * t / (na.n::double * nb.n), 6) as lift,
  round((c + 0.5) * (t - na.n - nb.n + c + 0.5) / ((na.n - c + 0.5) * (nb.n - c + 0.5)), 6) as odds_ratio
  from p join n na on na.x = label_a join n nb on nb.x = label_b, t""",
    "p2_found": _P2,
    "p6_found": _P6,
    "p7_found": f"""with i as (select item_id, {_W} as w from eval_items where text is not null),
iw as (select distinct item_id, hash(w[k:k+14]) as h from i, unnest(range(1, greatest(len(w) - 13, 1))) u(k) where len(w) >= 15),
d as (select doc_id, {_W} as w from documents where text is not null),
dw as (select doc_id, hash(w[k:k+14]) as h from d, unnest(range(1, greatest(len(w) - 13, 1))) u(k) where len(w) >= 15)
select distinct doc_id, item_id from dw join iw using (h)""",
    "p9_found": f"""with d as (select doc_id, {_W} as w from documents where text is not null),
g as (select doc_id, count(*) as n, count(distinct hash(w[k:k+4])) as u from d, unnest(range(1, len(w) - 3)) t(k) where len(w) >= 50 group by doc_id)
select doc_id from g where 1 - u::double / n >= 0.25""",
}
