import datetime as dt

import pytest
from lexforge.operators import repair, store as S, structure, validate as V
from lexforge.operators.components import connected_components
from pyspark.sql import functions as F

T0, T1 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)


def empty(spark, name):
    return spark.createDataFrame([], S.SCHEMAS[name])


def rows(spark, name, *given):
    names = S.SCHEMAS[name].names
    return spark.createDataFrame([tuple(g.get(n) for n in names) for g in given], S.SCHEMAS[name])


def test_versions_and_additive_schema(spark, tmp_path):
    d = S.Dataset(spark, str(tmp_path))
    assert d.read("eurovoc").count() == 0
    d.write("eurovoc", spark.createDataFrame([("X1", "u")], "celex_id string, eurovoc_uri string"))
    assert d.read("eurovoc").columns == S.SCHEMAS["eurovoc"].names
    d.write("eurovoc", rows(spark, "eurovoc", {"celex_id": "X2"}))
    assert [r.celex_id for r in d.read("eurovoc").collect()] == ["X2"]
    S.export(d, str(tmp_path / "out"), ["parquet", "csv"])
    assert spark.read.parquet(str(tmp_path / "out/works_parquet")).columns == S.SCHEMAS["works"].names


def test_work_upsert_keeps_enrichment_and_unfetched_text(spark):
    old = rows(spark, "works", {"celex_id": "A", "title": "t", "full_text": "x", "author": "z"}, {"celex_id": "B", "title": "b", "full_text": "y"})
    new = rows(spark, "works", {"celex_id": "A", "title": "n"}, {"celex_id": "B", "title": "m"}, {"celex_id": "C"}).withColumn("fetched", F.col("celex_id") != "B")
    got = {r.celex_id: (r.title, r.full_text, r.author) for r in S.save_works(old, new).collect()}
    assert got == {"A": ("n", None, "z"), "B": ("m", "y", None), "C": (None, None, None)}


def test_relation_refresh_respects_owner(spark):
    old = rows(spark, "relations", {"id": 1, "source_celex": "A", "target_celex": "B", "relation_type": "cites"}, {"id": 2, "source_celex": "A", "target_celex": "B", "relation_type": "repeals"}, {"id": 3, "source_celex": "C", "target_celex": "B", "relation_type": "cites"})
    batch = rows(spark, "relations", {"source_celex": "A", "target_celex": "D", "relation_type": "cites"}, {"source_celex": "Z", "target_celex": "D", "relation_type": "cites"}, {"source_celex": "A", "target_celex": None, "relation_type": "cites"})
    ids, works = spark.createDataFrame([("A",)], "celex_id string"), spark.createDataFrame([("A",), ("C",)], "celex_id string")
    got = {tuple(r) for r in S.save_relations(old, batch, ids, works).collect()}
    assert got == {("A", "B", "repeals"), ("C", "B", "cites"), ("A", "D", "cites")}


def test_replace_clears_and_checkpoint_upsert(spark):
    old = rows(spark, "eurovoc", {"celex_id": "A"}, {"celex_id": "B"})
    assert [r.celex_id for r in S.replace_by_key(old, old.limit(0), spark.createDataFrame([("A",)], "celex_id string")).collect()] == ["B"]
    cp = rows(spark, "work_checkpoint", {"celex_id": "A", "status": "failed", "timestamp": T0}, {"celex_id": "B", "status": "processed", "timestamp": T1})
    up = S.upsert(cp, rows(spark, "work_checkpoint", {"celex_id": "A", "status": "processed", "timestamp": T1}, {"celex_id": "B", "status": "failed", "timestamp": T0}), ["celex_id"])
    assert {(r.celex_id, r.status) for r in up.collect()} == {("A", "processed"), ("B", "processed")}
    assert S.remaining(spark.createDataFrame([("A",), ("C",)], "celex_id string"), cp).count() == 2
    assert S.reset(cp, "failed").count() == 1 and S.reset(cp).count() == 0


def test_unit_keys(spark):
    u = spark.createDataFrame([("A", "article", "1", "", None, None, 5), ("A", "article", "1", None, None, None, 9), ("A", "recital", None, None, None, "a", 1)], "celex_id string, type string, number string, paragraph_num string, subparagraph_num string, point_letter string, pos int")
    got = [(r.unit_order, r.unit_key) for r in structure.number_units(u).orderBy("unit_order").collect()]
    assert got == [(1, "A:recital:-:-:-:a"), (2, "A:article:1:-:-:-"), (3, "A:article:1:-:-:-:2")]


def test_folds(spark):
    one = lambda e: spark.range(1).select(e.alias("x")).first().x
    arr = lambda *v: F.array(*[F.lit(i) for i in v])
    assert one(structure.rotate_to_one(arr(3, 4, 1, 2))) == [1, 2, 3, 4]
    assert one(structure.rotate_to_one(arr(3, 1, 2, 5))) == [3, 1, 2, 5]


def test_validation_codes(spark):
    ok = {"celex_id": "A", "full_text": "x", "document_type": "regulation", "language": "eng"}
    t = {n: empty(spark, n) for n in V.NEEDED}
    t["works"] = rows(spark, "works", ok)
    t["text_units"] = rows(spark, "text_units", {"id": 1, "celex_id": "A", "type": "article", "unit_order": 1, "unit_key": "k", "text": "t"})
    t["work_checkpoint"] = rows(spark, "work_checkpoint", {"celex_id": "A", "status": "processed"})
    assert V.validate(t).count() == 0
    bad = dict(t)
    bad["works"] = rows(spark, "works", ok, ok, {"celex_id": "B", "content_source": "repair_pending__x"})
    bad["text_units"] = rows(spark, "text_units", {"id": 1, "celex_id": "Q", "type": "recital", "number": "3", "text": "(3) "}, {"id": 1, "celex_id": "Q"})
    bad["dataset_runs"] = rows(spark, "dataset_runs", {"status": "running", "config_json": "{}", "config_sha256": "no"})
    codes = {r.code: r["count"] for r in V.validate(bad).collect()}
    assert codes["duplicate_work_id"] == 1 and codes["duplicate_text_unit_id"] == 1 and codes["orphan_text_unit"] == 2
    assert codes["marker_only_recital"] == 1 and codes["missing_unit_identity"] == 2 and codes["pending_pdf_repair"] == 1
    assert codes["work_without_checkpoint"] == 1 and codes["content_without_text_units"] == 2 and codes["unfinished_runs"] == 1 and codes["manifest_hash_mismatch"] == 1
    assert [r.code for r in V.validate({"works": t["works"]}).collect()][0] == "missing_table"


def test_repairs(spark):
    w = rows(spark, "works", {"celex_id": "A", "content_source": "cellar_pdf_eng"}, {"celex_id": "B", "content_source": "cellar_html_eng"})
    cp = rows(spark, "work_checkpoint", {"celex_id": "A", "status": "processed"}, {"celex_id": "B", "status": "processed"})
    audit, works, left = repair.pdf_repair(w, empty(spark, "text_units"), cp)
    assert [(r.celex_id, r.unit_count) for r in audit.collect()] == [("A", 0)] and left.count() == 1
    assert {r.content_source for r in works.collect()} == {"repair_pending__cellar_pdf_eng", "cellar_html_eng"}
    u = rows(spark, "text_units", {"id": 1, "text": "a"}, {"id": 1, "text": "a"}, {"id": 2, "text": "b"})
    assert repair.drop_replayed(u, "id").count() == 2
    with pytest.raises(ValueError):
        repair.drop_replayed(u.unionByName(rows(spark, "text_units", {"id": 2, "text": "c"})), "id")
    q = repair.quality_repair(rows(spark, "works", {"celex_id": "A", "full_text": "", "full_text_original": "mots"}), empty(spark, "text_units"))
    assert [(r.reason, r.action) for r in q.collect()] == [("empty_output", "reset_full_text")]


def test_components(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e"), ("f", "f"), (None, "x")] + [(f"n{i:03}", f"n{i + 1:03}") for i in range(40)], "a string, b string")
    got = {r.node: r.component for r in connected_components(e).collect()}
    assert got["c"] == "a" and got["e"] == "d" and got["n040"] == "n000" and len(got) == 47
    assert connected_components(e.limit(0)).count() == 0


def test_restart_removal(spark):
    f = lambda v: spark.range(1).select(structure.remove_restarts(F.array(*[F.lit(i) for i in v])).alias("x")).first().x
    assert f([1, 2, 3, 1, 2, 4, 5]) == [1, 2, 3, 4, 5]
    assert f([1, 2, 3]) == [1, 2, 3]


def test_spread_equals_one_window(spark):
    d = spark.createDataFrame([("a", i % 37, i, "v" if i % 11 == 0 else None) for i in range(400)] + [("b", None, 1, "x"), ("b", 3, 2, None), (None, 1, 1, "n")], "doc string, o int, t int, v string")
    s = structure.Spread("doc", F.col("o"), [F.col("o"), F.col("t")], step=5)
    out = s.running_count(s.running_last(s.row_number(d, "rn"), F.when(F.col("v").isNotNull(), F.concat("v", F.col("t").cast("string"))), "lv"), F.col("v").isNotNull(), "c")
    got = {(r.doc, r.o, r.t): (r.rn, r.lv, r.c) for r in out.collect()}
    for doc in ("a", "b", None):
        rows = sorted((r for r in d.collect() if r.doc == doc), key=lambda r: (r.o is None, r.o, r.t))
        last, c = None, 0
        for i, r in enumerate(rows, 1):
            last, c = (f"{r.v}{r.t}", c + 1) if r.v else (last, c)
            assert got[(r.doc, r.o, r.t)] == (i, last, c)
