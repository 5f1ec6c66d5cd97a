"""Connected components by alternating minimum propagation, without collecting links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import durable


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) of each node that has a link; component is the smallest node of its group.

    Large-star / small-star rounds: each round is two shuffles with map-side minimum, the number of
    rounds grows with the logarithm of the longest path; a chain that needs more than max_rounds is an error and no
    result. The joins have one row a node on one side, so adaptive execution splits a node with a large share of all links. Null ends are dropped; self-links give a group
    of one; an empty input gives no rows.
    """
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    e = durable(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(m, "u").where(F.col("v") >= F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        m2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m2, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")
        )
        new = durable(small.select("x.u", "x.v").where("u >= v").distinct())
        same = new.exceptAll(e).isEmpty() and e.exceptAll(new).isEmpty()
        e = new
        if same:
            break
    else:
        raise RuntimeError(f"components: no end after {max_rounds} rounds; allow more")
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).select("node", F.least("node", "component").alias("component"))
