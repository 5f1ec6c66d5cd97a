"""The keyed store as functions of snapshots: every write is new_state = f(old_state, batch), made durable by
a versioned directory and a pointer that is swapped last. No file is changed in place, so a failed or repeated
run leaves the last version as it was."""

from __future__ import annotations

import os
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

S, I, D, TS, B = T.StringType(), T.IntegerType(), T.DateType(), T.TimestampType(), T.BooleanType()
_st = lambda **c: T.StructType([T.StructField(k, v) for k, v in c.items()])

#: Relation types that belong to the enrichment and survive a base refresh (fixed values).
ENRICHMENT_RELATIONS = ("repeals", "implicitly_repeals")
ENRICHMENT_COLUMNS = ["date_entry_into_force", "date_end_of_validity", "is_in_force", "eli", "author", "subject_matter", "procedure_type", "procedure_reference", "procedure_legal_basis", "enriched_at"]
BASE_COLUMNS = ["title", "date_adopted", "document_type", "language", "full_text", "full_text_original", "full_text_html", "content_source"]
CATEGORIES = ("metadata", "relations", "eurovoc")
SCHEMAS = {
    "works": _st(celex_id=S, title=S, date_adopted=D, document_type=S, language=S, full_text=S, full_text_original=S, full_text_html=S, content_source=S, date_entry_into_force=D, date_end_of_validity=D, is_in_force=B, eli=S, author=S, subject_matter=S, procedure_type=S, procedure_reference=S, procedure_legal_basis=S, enriched_at=TS),
    "text_units": _st(id=I, celex_id=S, type=S, subtype=S, number=S, paragraph_num=S, subparagraph_num=S, point_letter=S, unit_order=I, unit_key=S, title=S, text=S, text_translated=S),
    "relations": _st(id=I, source_celex=S, target_celex=S, relation_type=S),
    "eurovoc": _st(celex_id=S, eurovoc_uri=S, eurovoc_label=S),
    "work_checkpoint": _st(celex_id=S, status=S, error=S, timestamp=TS),
    "arrivals": _st(celex_id=S, arrived_at=TS),
    "enrichment_checkpoint": _st(celex_id=S, category=S, timestamp=TS),
    "dataset_runs": _st(run_id=S, started_at=TS, completed_at=TS, status=S, config_json=S, config_sha256=S, package_version=S, source_revision=S, source_dirty=B, python_version=S, dependency_versions=S),
    "translation_failures": _st(scope=S, record_id=S, celex_id=S, source_sha256=S, reason=S, policy_version=I, attempted_at=TS),
}
EXPORTED = ("works", "text_units", "relations", "eurovoc")


class Dataset:
    """A directory of tables; each table is a directory of versions and a file that names the current one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _current(self, name: str) -> str | None:
        fs, P = self._fs()
        d = P(f"{self.root}/{name}")
        if not fs.exists(d):
            return None
        done = sorted(x.getPath().getName() for x in fs.listStatus(d) if fs.exists(P(x.getPath(), "_SUCCESS")))
        return f"{self.root}/{name}/{done[-1]}" if done else None

    def read(self, name: str) -> DataFrame:
        """The current version, with columns added to the schema since it was written as nulls."""
        empty = self.spark.createDataFrame([], SCHEMAS[name])
        at = self._current(name)
        return empty.unionByName(self.spark.read.parquet(at), allowMissingColumns=True) if at else empty

    def write(self, name: str, state: DataFrame) -> None:
        """A new version; readers see it once its commit marker stands."""
        state.write.mode("errorifexists").parquet(f"{self.root}/{name}/v{time.time_ns():020d}")

    def vacuum(self, name: str, keep: int = 2) -> None:
        fs, P = self._fs()
        old = sorted(x.getPath().toString() for x in fs.listStatus(P(f"{self.root}/{name}")))[:-keep]
        for p in old:
            fs.delete(P(p), True)


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the last in a total order."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return latest(df, keys, order)


def save_works(old: DataFrame, new: DataFrame) -> DataFrame:
    """new: base columns and fetched. A fetched row replaces the base columns, one that was not fetched only
    title, date and type where it has them; enrichment columns stay."""
    n = new.select("celex_id", "fetched", *[F.col(c).alias(f"n_{c}") for c in BASE_COLUMNS])
    j = old.join(n, "celex_id", "full_outer")
    always = {"title", "date_adopted", "document_type"}

    def pick(c: str) -> Column:
        if c in always:
            return F.when(F.col("fetched"), F.col(f"n_{c}")).otherwise(F.coalesce(f"n_{c}", c))
        return F.when(F.col("fetched"), F.col(f"n_{c}")).otherwise(F.col(c))

    return j.select("celex_id", *[pick(c).alias(c) for c in BASE_COLUMNS], *[c for c in ENRICHMENT_COLUMNS if c in old.columns])


def replace_by_key(old: DataFrame, batch: DataFrame, ids: DataFrame, key: str = "celex_id") -> DataFrame:
    """Rows of the ids are replaced by the batch; an id without rows in the batch is cleared."""
    return old.join(ids.select(key).distinct(), key, "left_anti").select(*old.columns).unionByName(batch.select(*old.columns))


def clean_relations(rows: DataFrame) -> DataFrame:
    return rows.where("source_celex is not null and target_celex is not null and relation_type is not null").dropDuplicates(["source_celex", "target_celex", "relation_type"])


def save_relations(old: DataFrame, batch: DataFrame, ids: DataFrame, works: DataFrame, owned: tuple[str, ...] = ENRICHMENT_RELATIONS) -> DataFrame:
    """Base relations of the refreshed documents are replaced; those the enrichment owns, and other documents',
    stay. Malformed rows, rows of unknown sources and repeated triples do not enter."""
    hit = ids.select(F.col("celex_id").alias("source_celex"), F.lit(True).alias("_hit")).distinct()
    triple = ["source_celex", "target_celex", "relation_type"]
    stays = F.col("_hit").isNull() | F.coalesce(F.col("relation_type").isin(*owned), F.lit(True))
    kept = old.join(hit, "source_celex", "left").where(stays).select(*old.columns)
    new = clean_relations(batch).join(works.select(F.col("celex_id").alias("source_celex")), "source_celex", "left_semi")
    new = new.join(kept.select(*triple), triple, "left_anti").select(*triple)
    return kept.select(*triple).unionByName(new)


def upsert(old: DataFrame, batch: DataFrame, keys: list[str], order: str = "timestamp") -> DataFrame:
    """The newest row of each key; a batch row wins a tie."""
    both = old.withColumn("_src", F.lit(0)).unionByName(batch.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in old.columns if c not in keys and c != order]
    return latest(both, keys, [F.col(order).desc_nulls_last(), F.col("_src").desc(), *[F.col(c).asc_nulls_last() for c in rest]]).drop("_src")


def remaining(ids: DataFrame, checkpoint: DataFrame, limit: int | None = None) -> DataFrame:
    """Ids not yet processed, sorted; the limit takes the first of what remains."""
    todo = ids.select("celex_id").distinct().join(checkpoint.where("status = 'processed'").select("celex_id"), "celex_id", "left_anti").orderBy("celex_id")
    return todo.limit(limit) if limit is not None else todo


def checkpoint_summary(checkpoint: DataFrame) -> DataFrame:
    return checkpoint.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def failures(checkpoint: DataFrame) -> DataFrame:
    return checkpoint.where("status = 'failed'").select("celex_id", "error")


def reset(checkpoint: DataFrame, which: str = "all", ids: DataFrame | None = None) -> DataFrame:
    """which: all, failed, or ids."""
    if which == "failed":
        return checkpoint.where("status <> 'failed' or status is null")
    if which == "ids":
        return checkpoint.join(ids.select("celex_id"), "celex_id", "left_anti")
    return checkpoint.limit(0)


def start_run(runs: DataFrame, row: dict) -> DataFrame:
    """Runs still marked running were interrupted; the new one is running."""
    old = runs.withColumn("status", F.when(F.col("status") == "running", "interrupted").otherwise(F.col("status")))
    return old.unionByName(runs.sparkSession.createDataFrame([row | {"status": "running"}], SCHEMAS["dataset_runs"]))


def finish_run(runs: DataFrame, run_id: str, status: str, at) -> DataFrame:
    me = F.col("run_id") == run_id
    return runs.withColumn("status", F.when(me, status).otherwise(F.col("status"))).withColumn("completed_at", F.when(me, F.lit(at)).otherwise(F.col("completed_at")))


def save_enrichment(works: DataFrame, relations: DataFrame, eurovoc: DataFrame, done: DataFrame, meta: DataFrame, rels: DataFrame, labels: DataFrame, ids: DataFrame, at) -> dict[str, DataFrame]:
    """Metadata is overwritten, nulls included; the enrichment's relations and the descriptors are replaced;
    each category is checked off. All four states belong to one commit."""
    cols = [c for c in ENRICHMENT_COLUMNS if c != "enriched_at"]
    m = meta.select("celex_id", F.lit(True).alias("_hit"), *[F.col(c).alias(f"n_{c}") for c in cols])
    j = works.join(m, "celex_id", "left")
    w = j.select(*[F.when(F.col("_hit"), F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.when(F.col("_hit"), F.lit(at)).otherwise(F.col(c)).alias(c) if c == "enriched_at" else F.col(c) for c in works.columns])
    triple = ["source_celex", "target_celex", "relation_type"]
    stale = relations.join(ids.select(F.col("celex_id").alias("source_celex")), "source_celex", "left_semi").where(F.col("relation_type").isin(*ENRICHMENT_RELATIONS))
    r = relations.join(stale.select(*triple), triple, "left_anti").select(*triple).unionByName(clean_relations(rels).select(*triple)).dropDuplicates(triple)
    e = replace_by_key(eurovoc, labels, ids).dropDuplicates(["celex_id", "eurovoc_uri"])
    marks = ids.select("celex_id").distinct().crossJoin(F.broadcast(ids.sparkSession.createDataFrame([(c,) for c in CATEGORIES], "category string"))).withColumn("timestamp", F.lit(at).cast("timestamp"))
    return {"works": w, "relations": r, "eurovoc": e, "enrichment_checkpoint": upsert(done, marks, ["celex_id", "category"])}


def legacy_backfill(works: DataFrame, done: DataFrame) -> DataFrame:
    """Works enriched before the checkpoint table was: each category, stamped with enriched_at."""
    old = works.where("enriched_at is not null").join(done.select("celex_id"), "celex_id", "left_anti")
    return done.unionByName(old.select("celex_id", F.explode(F.array(*[F.lit(c) for c in CATEGORIES])).alias("category"), F.col("enriched_at").alias("timestamp")))


def missing_categories(ids: DataFrame, done: DataFrame, wanted: tuple[str, ...] = CATEGORIES, force: bool = False) -> DataFrame:
    """(celex_id, missing): documents that lack a wanted category, all of them if forced."""
    have = done.where(F.col("category").isin(*wanted)).groupBy("celex_id").agg(F.collect_set("category").alias("have"))
    want = F.array(*[F.lit(c) for c in wanted])
    j = ids.select("celex_id").distinct().join(have, "celex_id", "left")
    miss = F.lit(True) if force else F.size(F.array_except(want, F.coalesce("have", F.array().cast("array<string>")))) > 0
    return j.where(miss).select("celex_id", F.array_join(F.array_except(want, F.coalesce("have", F.array().cast("array<string>"))), ",").alias("missing"))


def current_failures(ledger: DataFrame, works: DataFrame, units: DataFrame, policy: int) -> DataFrame:
    """Ledger rows that still hold: same policy, and the record's text has the hash it had then."""
    w = works.where("full_text is not null and language <> 'eng'").select(F.lit("full_text").alias("scope"), F.col("celex_id").alias("record_id"), F.sha2("full_text", 256).alias("source_sha256"))
    u = units.where("text is not null").join(works.where("language <> 'eng'").select("celex_id"), "celex_id", "left_semi")
    u = u.select(F.lit("unit").alias("scope"), F.coalesce("unit_key", F.col("id").cast("string")).alias("record_id"), F.sha2("text", 256).alias("source_sha256"))
    return ledger.where(F.col("policy_version") == policy).join(w.unionByName(u).distinct(), ["scope", "record_id", "source_sha256"], "left_semi")


def import_enrichment(target: DataFrame, source: DataFrame) -> DataFrame:
    """Enrichment columns from another dataset where it is newer."""
    s = source.select("celex_id", *[F.col(c).alias(f"s_{c}") for c in ENRICHMENT_COLUMNS]).where("s_enriched_at is not null")
    newer = F.col("s_enriched_at").isNotNull() & (F.col("enriched_at").isNull() | (F.col("s_enriched_at") > F.col("enriched_at")))
    return target.join(s, "celex_id", "left").select(*[F.when(newer, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) if c in ENRICHMENT_COLUMNS else F.col(c) for c in target.columns])


def export(dataset: Dataset, out: str, formats: list[str]) -> None:
    """The four tables, empty ones with their schema; spread over as many files as they have partitions."""
    for name in EXPORTED:
        df = dataset.read(name)
        if df.isEmpty():
            df = dataset.spark.createDataFrame([], SCHEMAS[name]).coalesce(1)
        for f in formats:
            w = df.write.mode("overwrite")
            w.option("header", True).csv(f"{out}/{name}_csv") if f == "csv" else w.parquet(f"{out}/{name}_parquet")


def reports(works: DataFrame) -> dict[str, DataFrame]:
    """Works without content, and works in another language than English."""
    return {
        "missing_content": works.where("content_source is null").select("celex_id", "document_type", "date_adopted"),
        "non_english": works.where("language is not null and language <> 'eng'").select("celex_id", "language", "document_type"),
    }


def write_report(df: DataFrame, path: str) -> bool:
    """A tab-separated report; none is left where there is nothing to report."""
    fs_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    if df.isEmpty():
        if fs.exists(fs_path):
            fs.delete(fs_path, True)
        return False
    df.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)
    return True


def write_audit(df: DataFrame, path: str) -> None:
    """An audit is never overwritten; it appears whole by the commit of the write or not at all."""
    df.write.mode("errorifexists").option("header", True).option("sep", "\t").csv(path)
