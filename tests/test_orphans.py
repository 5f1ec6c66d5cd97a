from lexforge.operators.orphans import orphan_reasons, orphan_references, orphans_by_period
from pyspark.sql import functions as F

SIDES = {"source": "s", "target": "t"}
SCHEMA = "id int, s string, t string, ref string, side string"


def found(spark, rel, works):
    r = spark.createDataFrame(rel, SCHEMA)
    w = spark.createDataFrame([(x,) for x in works], "celex_id string")
    return {(x.id, x.side) for x in orphan_references(r, "id", SIDES, w, "celex_id").select("id", "side").distinct().collect()}


def test_blanks_case_and_clashing_columns(spark):
    rel = [(1, " a1\t", "A2", "x", "y"), (2, None, "", None, None), (3, " a1", " b ", "", ""), (3, "a1", "b", "", ""), (None, "zz", "A1", "", "")]
    assert found(spark, rel, ["A1", "A2", None]) == {(3, "target"), (None, "source")}


def test_empty_tables(spark):
    assert found(spark, [], ["A"]) == set()
    assert found(spark, [(1, "a", None, "", "")], []) == {(1, "source")}


def test_saturated_filter_is_still_exact(spark):
    works = [f"K{i}" for i in range(3000)]
    rel = [(i, f"k{i}", f"k{i + 1500}", "", "") for i in range(3000)]
    r, w = spark.createDataFrame(rel, SCHEMA), spark.createDataFrame([(x,) for x in works], "celex_id string")
    out = orphan_references(r, "id", SIDES, w, "celex_id", max_blocks=64).select("id", "side")
    assert {(x.id, x.side) for x in out.collect()} == {(i, "target") for i in range(1500, 3000)}


def test_hot_key_and_report(spark):
    rel = spark.range(30_000).select(F.col("id").cast("int").alias("id"), F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("N"), F.col("id"))).alias("s"), F.lit(None).cast("string").alias("t"))
    w = spark.createDataFrame([("HOT",)], "celex_id string")
    o = orphan_references(rel, "id", SIDES, w, "celex_id", F.lit(1999))
    r = orphans_by_period(o).collect()
    assert [(x.side, x.period, x.orphan_refs, x.missing_keys) for x in r] == [("source", 1999, 20_000, 20_000)]


def test_reasons(spark):
    o = spark.createDataFrame([(i, "target", r) for i, r in enumerate(["32000R0001", "32000R0002", "32000R0003", "?", "32000R0001"])], "id int, side string, ref string")
    cp = spark.createDataFrame([(" 32000r0001 ", "processed"), ("32000R0001", "failed"), ("32000R0002", "failed"), (None, "processed"), ("32000R0009", None)], "celex_id string, status string")
    assert sorted((r.ref, r.reason) for r in orphan_reasons(o, cp).collect()) == [("32000R0001", "dropped"), ("32000R0001", "dropped"), ("32000R0002", "failed"), ("32000R0003", "unknown"), ("?", "malformed")]
