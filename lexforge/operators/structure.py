"""Order, identity and profile of text units; carried headings; sequence completeness; extraction statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def part(c: str | Column) -> Column:
    """Key part: '-' for null and ''."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("-"))


class Spread:
    """Running values over a group in order, where one group may hold a large share of all rows.

    The group is cut into stretches of the leading order column (`major`, a number that rows are ordered by first),
    each stretch is worked in a window of its own, and what the stretches before it amount to is added from a table
    with one row a stretch. Rows with a null `major` come last. Equal to a window over the whole group, in tasks of
    about `step` rows.
    """

    def __init__(self, doc: str, major: Column, order: list, step: int = 65_536):
        self.doc, self.order = doc, order
        self.chunk = F.coalesce(F.floor(major / step), F.lit(1 << 40))
        self.here = Window.partitionBy(doc, "_chunk").orderBy(*order)
        self.before = Window.partitionBy(doc).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)

    def _with(self, df: DataFrame, local: Column, total: Column, carry, join) -> DataFrame:
        d = df.withColumn("_chunk", self.chunk)
        sums = d.groupBy(self.doc, "_chunk").agg(total.alias("_t"))
        sums = sums.select(F.col(self.doc).alias("_d"), F.col("_chunk").alias("_c"), carry(F.col("_t")).over(self.before).alias("_before"))
        d = d.withColumn("_local", local)
        d = d.join(sums, d[self.doc].eqNullSafe(F.col("_d")) & (F.col("_chunk") == F.col("_c")), "left").drop("_d", "_c", "_chunk")
        return d.withColumn("_value", join(F.col("_local"), F.col("_before"))).drop("_local", "_before")

    def row_number(self, df: DataFrame, name: str) -> DataFrame:
        out = self._with(df, F.row_number().over(self.here).cast("long"), F.count(F.lit(1)), F.sum, lambda a, b: a + F.coalesce(b, F.lit(0)))
        return out.withColumnRenamed("_value", name)

    def running_count(self, df: DataFrame, cond: Column, name: str) -> DataFrame:
        w = self.here.rowsBetween(Window.unboundedPreceding, 0)
        out = self._with(df, F.count_if(cond).over(w), F.count_if(cond), F.sum, lambda a, b: a + F.coalesce(b, F.lit(0)))
        return out.withColumnRenamed("_value", name)

    def running_last(self, df: DataFrame, value: Column, name: str) -> DataFrame:
        """The last non-null value so far."""
        w = self.here.rowsBetween(Window.unboundedPreceding, 0)
        last = F.max_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), F.struct(*self.order)))
        out = self._with(df, F.last(value, ignorenulls=True).over(w), last, lambda t: F.last(t, ignorenulls=True), F.coalesce)
        return out.withColumnRenamed("_value", name)


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, line) of the non-blank lines, pos from 0 over all lines."""
    return docs.select(key, F.posexplode(F.split(F.col(text), "\r?\n")).alias("pos", "line")).where(F.length(F.trim("line")) > 0)


def number_units(units: DataFrame, doc: str = "celex_id", pos: str = "pos", ties: tuple[str, ...] = ()) -> DataFrame:
    """unit_order 1..n in each document by pos (a number) and ties, and unit_key; the k-th repeat of a key gets the
    suffix :k."""
    base = F.concat_ws(":", F.col(doc), F.col("type"), part("number"), part("paragraph_num"), part("subparagraph_num"), part("point_letter"))
    order = [F.col(pos)] + [F.col(c) for c in ties]
    d = Spread(doc, F.col(pos), order).row_number(units, "unit_order").withColumn("_base", base)
    d = Spread("_base", F.col("unit_order"), [F.col("unit_order")]).row_number(d, "_k")
    key = F.when(F.col("_k") > 1, F.concat_ws(":", "_base", F.col("_k").cast("string"))).otherwise(F.col("_base"))
    return d.withColumn("unit_key", key).withColumn("unit_order", F.col("unit_order").cast("int")).drop("_base", "_k")


def profile(units: DataFrame, doc: str = "celex_id") -> DataFrame:
    """Per document: recitals, different articles, different annexes, bodies, units."""
    named = F.coalesce("number", F.lit("unnumbered"))
    return units.groupBy(doc).agg(
        F.count_if(F.col("type") == "recital").alias("recitals"),
        F.countDistinct(F.when(F.col("type") == "article", named)).alias("articles"),
        F.countDistinct(F.when(F.col("type") == "annex", named)).alias("annexes"),
        F.count_if(F.col("type") == "body").alias("bodies"),
        F.count(F.lit(1)).alias("units"),
    )


def carried(df: DataFrame, doc: str, order: list[str], value: Column, name: str) -> DataFrame:
    """The last non-null value at or before each row, as a heading holds for what follows it. order: columns, the first a number."""
    return Spread(doc, F.col(order[0]), [F.col(c) for c in order]).running_last(df, value, name)


def sequence_complete(units: DataFrame, doc: str = "celex_id", order: str = "unit_order") -> DataFrame:
    """Per document with articles: whether their numbers, each at its first place, run 1..last without a gap
    (['sole'] alone counts as complete)."""
    a = units.where("type = 'article'").withColumn("base", F.regexp_replace(F.lower(F.col("number")), "[a-z]+$", ""))
    a = a.withColumn("base", F.when(F.lower(F.col("number")) == "sole", "sole").otherwise(F.col("base")))
    firsts = a.groupBy(doc, "base").agg(F.min(order).alias("at"))
    n = F.row_number().over(Window.partitionBy(doc).orderBy(F.col("at").asc_nulls_first(), F.col("base").asc_nulls_first()))  # ties by number, so reruns agree
    r = firsts.withColumn("rank", n).groupBy(doc).agg(
        F.bool_and(F.coalesce(F.col("base").try_cast("int") == F.col("rank"), F.lit(False))).alias("runs"),
        F.count(F.lit(1)).alias("n"), F.min("base").alias("one"),
    )
    return r.select(doc, F.col("n").alias("articles"), (F.col("runs") | F.coalesce((F.col("n") == 1) & (F.col("one") == "sole"), F.lit(False))).alias("complete"))


def last_of_type(units: DataFrame, kind: str, doc: str = "celex_id", order: str = "unit_order") -> DataFrame:
    """is_last: whether a unit is the last of its type in the document. The greatest place of each document is joined to
    its units (one row a document), so that a document with a large share of all rows is not one task."""
    top = units.where(F.col("type") == kind).groupBy(F.col(doc).alias("_d")).agg(F.max(order).alias("_top"))
    u = units.join(top, units[doc].eqNullSafe(F.col("_d")), "left")
    return u.withColumn("is_last", (F.col("type") == kind) & (F.col(order) == F.col("_top"))).drop("_d", "_top")


def extraction_stats(works: DataFrame, units: DataFrame) -> DataFrame:
    """One row: works with structured units, with a body only, with text and no units, without text; most frequent source."""
    per = units.groupBy("celex_id").agg(F.count_if(F.col("type") != "body").alias("s"), F.count_if(F.col("type") == "body").alias("b"))
    w = works.select("celex_id", "content_source", (F.length("full_text") > 0).alias("has_text")).join(per, "celex_id", "left")
    has = F.coalesce("has_text", F.lit(False))
    totals = w.agg(
        F.count_if(F.col("s") > 0).alias("structured"), F.count_if((F.col("s") == 0) & (F.col("b") > 0)).alias("body_only"),
        F.count_if(has & F.col("s").isNull()).alias("text_without_units"), F.count_if(~has).alias("without_text"),
    )
    top = w.where("content_source is not null").groupBy("content_source").count().orderBy(F.desc("count"), "content_source").limit(1)
    return totals.crossJoin(F.broadcast(top.select(F.col("content_source").alias("top_source"), F.col("count").alias("top_count"))))


def remove_restarts(numbers: Column) -> Column:
    """Drops a run 1..k inside a number sequence if the number expected before it is the next one behind it.

    A fold over (kept, held, last): held is a run 1..k that may turn out to be a restart behind `last`."""
    none = F.array().cast("array<int>")

    def state(kept, held, last):
        return F.struct(kept.alias("kept"), held.alias("held"), last.alias("last"))

    def step(s, x):
        one, k = F.array(x), F.size(s["held"])
        opens = (k == 0) & (x == 1) & (F.size(s["kept"]) > 0)
        flushed = F.concat(s["kept"], s["held"])
        return (
            F.when(opens, state(s["kept"], one, s["last"]))
            .when((k == 0) | (x == s["last"] + 1), state(F.concat(s["kept"], one), none, x))  # a held run is dropped here
            .when(x == k + 1, state(s["kept"], F.concat(s["held"], one), s["last"]))
            .when(x == 1, state(flushed, one, k))
            .otherwise(state(F.concat(flushed, one), none, x))
        )

    end = F.aggregate(numbers, state(none, none, F.lit(0)), step)
    return F.concat(end["kept"], end["held"])


def rotate_to_one(numbers: Column) -> Column:
    """A sequence that is 1..n turned once, turned back."""
    at = F.array_position(numbers, F.lit(1)).cast("int")
    turned = F.concat(F.slice(numbers, at, F.size(numbers)), F.slice(numbers, F.lit(1), at - 1))
    return F.when((at > 1) & (turned == F.sequence(F.lit(1), F.size(numbers))), turned).otherwise(numbers)


def merge_units(base: DataFrame, other: DataFrame, keys: tuple[str, ...] = ("celex_id", "type")) -> DataFrame:
    """Fills groups (type, number in small letters) that only the other source has; kept text is the base's.

    A document and type is merged only if the base's numbers are among the other's, the other has strictly
    more, and the new groups hold at least 3 letters or digits.
    """
    num = lambda d: d.withColumn("_n", F.lower(F.coalesce("number", F.lit(""))))
    b, o = num(base), num(other)
    bs = b.groupBy(*keys).agg(F.collect_set("_n").alias("bn"))
    os_ = o.groupBy(*keys).agg(F.collect_set("_n").alias("on"))
    ok = os_.join(bs, list(keys), "left").withColumn("bn", F.coalesce("bn", F.array().cast("array<string>")))
    ok = ok.where((F.size(F.array_except("bn", "on")) == 0) & (F.size("on") > F.size("bn"))).select(*keys)
    solid = o.groupBy(*keys, "_n").agg(F.sum(F.length(F.regexp_replace(F.concat_ws("", "title", "text"), "[^\\p{L}\\p{N}]", ""))).alias("l")).where("l >= 3")
    new = o.join(ok, list(keys), "left_semi").join(solid, [*keys, "_n"], "left_semi").join(b.select(*keys, "_n").distinct(), [*keys, "_n"], "left_anti")
    return b.drop("_n").unionByName(new.drop("_n").select(*base.columns))
