import json
import os
import time

import pytest
from lexforge.functions import ids, quality, text as T
from lexforge.operators import relational as R, store as S
from lexforge.plans import pipeline
from lexforge.sources import catalogue
from lexforge.sources.config import Config
from lexforge.sources.local import LocalCatalogue
from lexforge.streaming import landing
from pyspark.sql import functions as F

CFG = Config.of({"data": {"mode": "fixed", "celex_ids": ["32000R0001", "52000DC0001"]}})
PAGE = '<div id="art_1"><p>Body of it.</p></div><div id="art_2"><p>It ends. Done at Town, 1 May 1999.</p></div>'
META = [("title", "An act"), ("date", "2000-01-02"), ("cites", "31999R0001"), ("cites", "31999R0001"), ("eurovoc", "u/1|label")]


def fetch(spark):
    def f(todo):
        i = [r.celex_id for r in todo.collect()]
        rows = spark.createDataFrame([(x, *m) for x in i for m in META], "celex_id string, data_type string, value string")
        return rows, spark.createDataFrame([(x, "html", "eng", PAGE if "R" in x else None) for x in i], "celex_id string, content_type string, language string, body string")

    return f


def test_run_twice_and_enrich(spark, tmp_path):
    d = S.Dataset(spark, str(tmp_path))
    assert pipeline.run(d, CFG, fetch(spark)) == "complete"
    units = [(r.number, r.text, r.unit_key) for r in d.read("text_units").orderBy("unit_order").collect()]
    assert units == [("1", "Body of it.", "32000R0001:article:1:-:-:-"), ("2", "It ends.", "32000R0001:article:2:-:-:-")]
    assert d.read("works").count() == 2 and d.read("relations").count() == 2 and d.read("eurovoc").count() == 2
    assert pipeline.run(d, CFG, fetch(spark)) == "complete" and d.read("text_units").count() == 2
    done = [("zz_complete_" + c, "1") for c in S.CATEGORIES] + [("author", "x/B"), ("author", "x/A"), ("is_in_force", "true"), ("repeals", "Q")]

    def answers(todo):
        rows = [(r.celex_id, *m) for r in todo.collect() for m in (done if "R" in r.celex_id else done[1:])]
        return spark.createDataFrame(rows, "celex_id string, data_type string, value string")

    assert pipeline.enrich(d, answers) == 1
    w = d.read("works").where("celex_id = '32000R0001'").first()
    assert (w.author, w.is_in_force) == ("A; B", True) and w.full_text == "Body of it. It ends. Done at Town, 1 May 1999."
    assert S.missing_categories(d.read("works"), d.read("enrichment_checkpoint")).count() == 1


def test_landing_stream(spark, tmp_path):
    d = S.Dataset(spark, str(tmp_path / "d"))
    folder = tmp_path / "in"
    folder.mkdir()
    row = {"celex_id": "32000R0001", "content_type": "html", "language": "eng", "body": PAGE, "metadata": [{"data_type": k, "value": v} for k, v in META], "arrived_at": "2024-01-01T00:00:00Z"}
    (folder / "a.json").write_text(json.dumps(row) + "\n" + json.dumps(row) + "\n")
    for _ in range(2):
        landing.start(d, CFG, str(folder), str(tmp_path / "cp")).awaitTermination()
    assert d.read("text_units").count() == 2 and d.read("work_checkpoint").count() == 1
    time.sleep(0.01)


def test_data_sources_from_recorded_answers(spark, tmp_path):
    catalogue.register(spark)
    empty = spark.read.format("lex_rest").options(endpoint="http://localhost/x", ids='["A","B"]', recorded=str(tmp_path), partitions="2").load()
    assert {r.status for r in empty.collect()} == {404} and empty.count() == 24
    cut = spark.read.format("lex_sparql").options(endpoint="http://localhost/s", ids='["A"]', recorded=str(tmp_path), on_failure="row").load()
    assert [(r.celex_id, r.data_type, r.value) for r in cut.collect()] == [("A", catalogue.FAILURE, "status 404")]


def test_remote_catalogue_from_recorded_answers(spark, tmp_path):
    import hashlib
    import urllib.parse

    def record(url, body, headers=None, status=200):
        name = hashlib.sha256((url + json.dumps(headers or {}, sort_keys=True)).encode()).hexdigest()[:24]
        (tmp_path / f"{name}.json").write_text(json.dumps({"status": status, "body": body}))

    def answer(query, *rows):
        url = "http://x/s?" + urllib.parse.urlencode({"query": query, "format": "application/sparql-results+json"})
        record(url, json.dumps({"results": {"bindings": [{k: {"value": v} for k, v in r.items()} for r in rows]}}))

    source = catalogue.RemoteCatalogue(spark, "sch", endpoint="http://x/s", rest="http://x/r", recorded=str(tmp_path), predicates=json.dumps({"title": "t"}), interval="0")
    answer(catalogue.concept_query(["air"], "sch"), {"concept": "u/2", "label": "b"}, {"concept": "u/1", "label": "a"})
    answer(catalogue.discovery_query([("R", "3")], "2000-01-01", "2000-12-31", ["u/1", "u/2"], False, False), {"c": "32000R0001"}, {"c": "32000R0002"})
    answer(catalogue.procedure_query(["2000/1"]), {"procedure": "2000/1", "proposal": "52000PC0001"})
    for i in ("32000R0001", "32000R0002"):
        answer(catalogue.metadata_query(i, {"title": "t"}), {"data_type": "title", "value": "An act"})
    record("http://x/r/32000R0001", PAGE, {"Accept": "application/xhtml+xml, text/html", "Accept-Language": "eng"})
    cfg = Config.of({"data": {"mode": "descriptive", "document_types": ["regulation"], "start_date": "2000-01-01", "end_date": "2000-12-31", "keywords": ["air"]}})
    d = S.Dataset(spark, str(tmp_path / "d"))
    assert pipeline.run(d, cfg, source=source) == "complete"
    assert {r.celex_id: (r.title, r.content_source) for r in d.read("works").collect()} == {"32000R0001": ("An act", "cellar_html_eng"), "32000R0002": ("An act", None)} and d.read("text_units").count() == 2
    assert [r.celex_id for r in pipeline.selected(Config.of({"data": {"mode": "fixed", "procedure_numbers": ["2000/1"]}}), source).collect()] == ["52000PC0001"]
    assert source.enrichment(spark.createDataFrame([("32000R0001",)], "celex_id string"), ("eurovoc",)).first().data_type == catalogue.FAILURE


def test_ids_and_text(spark):
    d = spark.createDataFrame([("32016R0679",), ("02016R0679-20160504",), ("32016R0679R(02)",), ("52020DC0001",), ("x",)], "c string")
    c = F.col("c")
    got = [tuple(r) for r in d.select(ids.is_valid_id(c), ids.original_id(c), ids.is_corrigendum(c), ids.document_type(c), ids.route(ids.document_type(c))).collect()]
    assert got[0] == (True, "32016R0679", False, "regulation", "structural") and got[1][1] == "32016R0679" and got[2][2] and got[3][3:] == ("communication", "com") and got[4][0] is False
    one = lambda e, v: spark.createDataFrame([(v,)], "c string").select(e).first()[0]
    assert one(T.normalise(c), " a  ﬁ b­c ") == "a fi bc"
    assert one(T.low_information(c), "12 - 3") and not one(T.low_information(c), "word")
    assert one(T.strip_boilerplate(c), "Text. Done at Town, 1 May") == "Text."
    assert one(T.heading_kind(c), "CHAPTER II") == "chapter"
    q = spark.createDataFrame([("a b c", "")], "s string, o string").select(quality.translation_issue(F.col("s"), F.col("o")))
    assert q.first()[0] == "empty_output"


def test_joins_both_ways(spark):
    k = spark.createDataFrame([("Air",), ("xyz",), ("qu",)], "keyword string")
    l = spark.createDataFrame([("clean air",), ("quota",), ("air quota",), ("",)], "label string")
    one = {tuple(r) for r in R.substring_join(k, l).select("keyword", "label").collect()}
    assert one == {("Air", "clean air"), ("Air", "air quota"), ("qu", "quota"), ("qu", "air quota")}
    long = k.where("length(keyword) > 2")
    assert {tuple(r) for r in R.substring_join(long, l, max_keywords=0).select("keyword", "label").collect()} == {x for x in one if x[0] == "Air"}
    p = spark.createDataFrame([("p", None, "52000PC0001"), ("p", "32000R0001", "52000PC0001"), ("q", None, "52000PC0001(01)")], "procedure string, work string, proposal string")
    assert {r.celex_id for r in R.procedures_to_ids(p).collect()} == {"52000PC0001", "32000R0001"}


def test_failed_requests_remain(spark, tmp_path):
    tries = [("32000R0001", "eng", "html", 200, PAGE.encode()), ("52000DC0001", "eng", "html", 503, None), ("32000R0002", "eng", "html", 404, None), ("32000R0003", "eng", "pdf", 200, b"%PDF-1"), ("32000R0004", "eng", "pdf", 200, b"%PDF-2")]
    attempts = spark.createDataFrame(tries, "celex_id string, lang string, fmt string, status int, body binary")
    layer = lambda: (None, lambda c: "# Article 1\n\nText of it." if c == b"%PDF-2" else None)
    rows = spark.createDataFrame([(x[0], *m) for x in tries for m in META], "celex_id string, data_type string, value string")
    ids = [x[0] for x in tries]
    d = S.Dataset(spark, str(tmp_path))
    assert pipeline.run(d, Config.of({"data": {"mode": "fixed", "celex_ids": ids}}), lambda todo: (rows, pipeline.negotiated(attempts, layer))) == "complete_with_failures"
    cp = {r.celex_id: (r.status, r.error) for r in d.read("work_checkpoint").collect()}
    assert cp.pop("52000DC0001") == ("failed", "request failed: eng html 503") and cp.pop("32000R0003") == ("failed", "PDF not converted: startup")
    assert cp == {x: ("processed", None) for x in ("32000R0001", "32000R0002", "32000R0004")}
    todo = S.remaining(spark.createDataFrame([(i,) for i in ids], "celex_id string"), d.read("work_checkpoint"))
    assert [r.celex_id for r in todo.collect()] == ["32000R0003", "52000DC0001"]
    assert {r.celex_id: r.full_text for r in d.read("works").collect()} == {"32000R0001": "Body of it. It ends. Done at Town, 1 May 1999.", "32000R0002": None, "32000R0004": "# Article 1\n\nText of it."}


def test_ids_are_unique_and_stay(spark):
    old = spark.createDataFrame([], S.SCHEMAS["relations"])
    rows = spark.range(150_000).selectExpr("concat('s', id) as source_celex", "concat('t', id % 977) as target_celex", "'cites' as relation_type")
    one = pipeline._with_ids(rows, old, pipeline.TRIPLE).select(*old.columns)
    assert one.select("id").distinct().count() == 150_000 and one.agg(F.min("id"), F.max("id")).first() == (1, 150_000)
    more = rows.limit(0).unionByName(one.where("id <= 100").select(*pipeline.TRIPLE)).unionByName(rows.selectExpr("source_celex", "target_celex", "'amends'").limit(50).toDF(*pipeline.TRIPLE))
    two = pipeline._with_ids(more, one, pipeline.TRIPLE).select(*old.columns)
    assert two.join(one, old.columns).count() == 100 and two.where("id > 150000").select("id").distinct().count() == 50
    clash = spark.createDataFrame([(2**31 - 1, "a", "b", "cites"), (2**31 - 1, "c", "d", "cites")], S.SCHEMAS["relations"])
    assert sorted(r.id for r in pipeline._with_ids(clash, clash, pipeline.TRIPLE).collect()) == [1, 2]


def test_refresh_spares_relations_of_other_documents_with_the_same_id(spark):
    old = spark.createDataFrame([(7, "A", "B", "cites"), (7, "C", "B", "cites")], S.SCHEMAS["relations"])
    ids = spark.createDataFrame([("A",)], "celex_id string")
    assert [tuple(r) for r in S.save_relations(old, old.limit(0), ids, ids).collect()] == [("C", "B", "cites")]


def test_old_arrivals_of_later_batches_are_processed(spark, tmp_path):
    d = S.Dataset(spark, str(tmp_path / "d"))
    folder = tmp_path / "in"
    folder.mkdir()
    came = [("32000R0001", "2024-06-01", PAGE), ("32000R0002", "2024-06-02", PAGE), ("32000R0003", "2020-01-01", PAGE), ("32000R0001", "2020-01-01", "<p>Old.</p>"), ("32000R0004", "2020-01-02", PAGE)]
    for n, (i, at, body) in enumerate(came):
        row = {"celex_id": i, "content_type": "html", "language": "eng", "body": body, "metadata": [{"data_type": k, "value": v} for k, v in META], "arrived_at": at + "T00:00:00Z"}
        (folder / f"{n}.json").write_text(json.dumps(row))
        os.utime(folder / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    landing.start(d, CFG, str(folder), str(tmp_path / "cp"), max_files=1).awaitTermination()
    assert {r.celex_id for r in d.read("work_checkpoint").collect()} == {"32000R0001", "32000R0002", "32000R0003", "32000R0004"}
    assert d.read("works").where("celex_id = '32000R0001'").first().full_text.startswith("Body of it.")


def test_substring_join_of_short_keywords_and_repeats(spark):
    k = spark.createDataFrame([("Air",), ("qu",), ("qu",), ("Q",), ("",), ("xyz",), (None,), ("zz",)], "keyword string")
    l = spark.createDataFrame([("clean air", 1), ("quota", 2), ("quota", 2), ("q", 3), ("", 4), (None, 5)], "label string, n int")
    one, two = (sorted(map(tuple, R.substring_join(k, l, max_keywords=m).collect())) for m in (100, 0))
    assert one == two and two.count(("quota", 2, "qu")) == 4 and ("q", 3, "Q") in two


def local(spark, pages):
    acts = spark.createDataFrame([("32000R0001", "2000-01-02"), ("32001R0002", "2001-01-02"), ("32000L0003", "2000-05-02"), ("52000PC0001", "2000-01-01")], "celex_id string, d string").selectExpr("celex_id", "cast(d as date) as date_adopted")
    labels = spark.createDataFrame([("32000R0001", "u/1", "clean air"), ("32001R0002", "u/2", "noise")], "celex_id string, eurovoc_uri string, eurovoc_label string")
    procedures = spark.createDataFrame([("2000/1", "32000L0003", "52000PC0001"), ("2000/2", None, "52000PC0001")], "procedure string, work string, proposal string")
    facts = spark.createDataFrame([(r[0], *m) for r in acts.select("celex_id").collect() for m in META], "celex_id string, data_type string, value string")
    return LocalCatalogue(acts, labels, procedures, facts, spark.createDataFrame(pages, "celex_id string, content_type string, language string, body string, outcome string, error string"))


def test_descriptive_and_procedure_runs(spark, tmp_path):
    source = local(spark, [(i, "html", "eng", PAGE, "ok", None) for i in ("32000R0001", "32001R0002", "32000L0003")])
    asked = {"mode": "descriptive", "document_types": ["regulation", "directive"], "start_date": "2000-01-01", "end_date": "2001-12-31"}
    d = S.Dataset(spark, str(tmp_path / "a"))
    one = Config.of({"data": asked, "processing": {"limit": 2}})
    assert pipeline.run(d, one, source=source) == "complete" and d.read("works").count() == 2
    assert pipeline.run(d, one, source=source) == "complete" and d.read("works").count() == 3
    d = S.Dataset(spark, str(tmp_path / "b"))
    assert pipeline.run(d, Config.of({"data": asked | {"keywords": ["AIR"]}}), source=source) == "complete"
    assert [r.celex_id for r in d.read("work_checkpoint").collect()] == ["32000R0001"]
    d = S.Dataset(spark, str(tmp_path / "c"))
    assert pipeline.run(d, Config.of({"data": {"mode": "fixed", "procedure_numbers": ["2000/1", "2000/2"]}}), source=source) == "complete"
    assert sorted(r.celex_id for r in d.read("work_checkpoint").collect()) == ["32000L0003", "52000PC0001"]
    with pytest.raises(ValueError):
        pipeline.run(d, one)
    assert [r.status for r in d.read("dataset_runs").orderBy("started_at").collect()] == ["complete", "failed"]


def test_a_page_that_no_reader_can_read_fails_alone(spark, tmp_path):
    deep = '<div id="art_1">' + "<div>" * 5000 + "x"
    source = local(spark, [("32000R0001", "html", "eng", deep, "ok", None), ("32001R0002", "html", "eng", PAGE, "ok", None)])
    d = S.Dataset(spark, str(tmp_path))
    cfg = Config.of({"data": {"mode": "fixed", "celex_ids": ["32000R0001", "32001R0002"]}})
    assert pipeline.run(d, cfg, source=source) == "complete_with_failures"
    got = {r.celex_id: (r.status, (r.error or "")[:14]) for r in d.read("work_checkpoint").collect()}
    assert got == {"32000R0001": ("failed", "RecursionError"), "32001R0002": ("processed", "")} and d.read("works").count() == 1


def test_fallback_chain(spark):
    cols = "celex_id string, document_type string, content_type string, language string, body string"
    art = lambda *ns: "".join(f'<div id="art_{n}"><p>Rule {n} holds.</p></div>' for n in ns)
    first = spark.createDataFrame([("A", "regulation", "html", "eng", "<p>nothing</p>"), ("B", "regulation", "html", "eng", art(1, 2)), ("C", "regulation", "html", "eng", '<div id="rct_1"><p>(1) A ground of some length.</p></div>' + art(1)), ("02000R0004-2010", "regulation", "html", "eng", '<div id="rct_1"><p>(1) Short.</p></div>' + art(1))], cols)
    pdf = "Whereas:\n(1) A ground of some length.\nHAS ADOPTED THIS REGULATION:\nArticle 1\nRule 1 read.\nArticle 2\nRule 2 read.\nArticle 3\nRule 3 read."
    other = spark.createDataFrame([(k, "regulation", "pdf", "eng", pdf) for k in "ABC"], cols)
    old = spark.createDataFrame([("02000R0004-2010", "regulation", "html", "eng", '<div id="rct_1"><p>(1) The ground as it was at first.</p></div>')], cols)
    how = ("article", True, True, True)
    out = pipeline.with_fallbacks(pipeline.parse_units(first, *how), first, other, old, *how)
    got = {}
    for r in out.orderBy("celex_id", "pos").collect():
        got.setdefault(r.celex_id, []).append((r.type, r.number, r.text))
    assert [x[:2] for x in got["A"]] == [("recital", "1"), ("article", "1"), ("article", "2"), ("article", "3")] and got["B"][1:] == [("article", "1", "Rule 1 read."), ("article", "2", "Rule 2 read."), ("article", "3", "Rule 3 read.")]
    assert got["C"][1:] == [("article", "1", "Rule 1 holds.")] and ("recital", "1", "(1) The ground as it was at first.") in got["02000R0004-2010"]


def test_translation_passes_and_ledger(spark, tmp_path):
    d = S.Dataset(spark, str(tmp_path))
    works = [("F1", "fra", "le texte entier"), ("F2", "fra", "mauvais"), ("E1", "eng", "the text")]
    d.write("works", spark.createDataFrame(works, "celex_id string, language string, full_text string").select(*[F.col(c) if c in ("celex_id", "language", "full_text") else F.lit(None).cast(S.SCHEMAS["works"][c].dataType).alias(c) for c in S.SCHEMAS["works"].names]))
    units = [(1, "F1", "F1:1", "un mot"), (2, "F2", "F2:1", "mauvais"), (3, "E1", "E1:1", "a word")]
    d.write("text_units", spark.createDataFrame(units, "id int, celex_id string, unit_key string, text string").select(*[F.col(c) if c in ("id", "celex_id", "unit_key", "text") else F.lit(None).cast(S.SCHEMAS["text_units"][c].dataType).alias(c) for c in S.SCHEMAS["text_units"].names]))
    load = lambda: (str.split, lambda ts, strict: ["" if t == "mauvais" else t.upper() for t in ts])
    want = {"full_text_translated": 1, "full_text_refused": 1, "unit_translated": 1, "unit_refused": 1}
    assert pipeline.translate(d, load) == want
    assert {r.celex_id: (r.full_text, r.full_text_original) for r in d.read("works").collect()} == {"F1": ("LE TEXTE ENTIER", "le texte entier"), "F2": ("mauvais", None), "E1": ("the text", None)}
    assert {r.id: r.text_translated for r in d.read("text_units").collect()} == {1: "UN MOT", 2: None, 3: None}
    assert {(r.scope, r.record_id, r.reason) for r in d.read("translation_failures").collect()} == {("full_text", "F2", "empty_output"), ("unit", "F2:1", "empty_output")}
    assert pipeline.translate(d, load) == {}  # what was refused is held back
    assert pipeline.translate(d, load, policy=2)["unit_refused"] == 1


def test_commands(spark, tmp_path, monkeypatch, capsys):
    from lexforge import cli

    (tmp_path / "c.json").write_text(json.dumps({"data": {"mode": "fixed", "celex_ids": ["32000R0001", "32001R0002"]}}))
    source = local(spark, [(i, "html", "eng", PAGE, "ok", None) for i in ("32000R0001", "32001R0002")])
    monkeypatch.setattr(cli, "factory", lambda name: lambda s: source)
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    d = str(tmp_path / "d")
    assert cli.main(["run", d, str(tmp_path / "c.json"), "--source", "x:y", "--limit", "1"]) == 0
    assert S.Dataset(spark, d).read("works").count() == 1
    assert cli.main(["enrich", d, "--source", "x:y"]) == 0 and capsys.readouterr().out.split()[-1] == "0"  # no sentinel, so nothing is complete
    assert cli.main(["status", d]) == 0 and cli.main(["validate", d]) in (0, 1)
    with pytest.raises(SystemExit):
        cli.main(["run", d, str(tmp_path / "c.json"), "--source", "x:y", "--limit", "1", "--fresh"])


def test_catalogue_queries_and_pdfs():
    q = catalogue.concept_query(['Air "x"'], "s")
    assert "prefLabel" in q and "altLabel" in q and '\\"x\\"' in q
    assert all(k in catalogue.concept_info_query("c") for k in catalogue.CONCEPT_PATHS)
    assert "VALUES ?procedure" in catalogue.procedure_query(["1"]) and "pdf" in catalogue.manifest_query("A")
    at = catalogue.manifest([{"data_type": "x/FRA", "value": "u/f"}, {"data_type": "ENG", "value": "u/e"}, {"data_type": "ENG", "value": "u/e2"}, {"data_type": None, "value": "z"}])
    assert at == {"fra": "u/f", "eng": "u/e"}

    class Fake:
        def get(self, url, *_, **__):
            return {"u/e/DOC_1": (404, b""), "u/e/DOC_2": (403, b""), "u/f/DOC_1": (200, b"<html>"), "u/f/DOC_2": (200, b"%PDF-1")}.get(url, (404, b""))

    assert catalogue.fetch_pdf(Fake(), at, ("eng", "fra")) == (b"%PDF-1", "fra") and catalogue.fetch_pdf(Fake(), at, ("eng",)) is None


def test_concept_info(spark):
    rows = [("c", "definition", "d2"), ("c", "definition", "d1"), ("c", "broader", "b"), ("c", "related", "z"), ("c", "related", "a"), ("e", "narrower", "n")]
    got = {r.concept: (r.definition, r.broader, r.narrower, r.related) for r in R.concept_info(spark.createDataFrame(rows, "concept string, data_type string, value string")).collect()}
    assert got == {"c": ("d1", ["b"], [], ["a", "z"]), "e": (None, [], ["n"], [])}
