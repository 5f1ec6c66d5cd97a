"""Session settings, table reading and the few distributed helpers that all operators share."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Static and runtime settings for a session of one's own; a cluster's session keeps its own values.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",  # whole texts go to Python in batches of bounded size
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "lexforge", **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    for k, v in (SETTINGS | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers find this package where it is not installed but its folder is shared or local."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (home, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the input has fewer splits than there are cores, as a single small file has; inputs with
    more splits stay as they are read."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir as the session names it; only where none is set and the
    master is local (tests, one machine) a temporary folder is made."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(?:\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lexforge-"))
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the folder that all executors share."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_broadcast(small: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """Marks a side for broadcast only if its counted size is within the bound, else leaves the plan to AQE."""
    return F.broadcast(small) if rows <= max_rows else small


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner", salts: int = 16) -> DataFrame:
    """Equi-join where one key may hold a large share of `big`.

    Keys with more than 1/64 of the rows of `big` (at most 63 of them, so the list is bounded) are hot:
    their rows are spread over `salts` and the matching rows of `small` repeated once per salt. All other
    rows keep salt 0. The salt is a hash of the row, so a task that runs again makes the same rows. `small` should hold
    few rows per key. how: inner, left_semi, left_anti or left. The plan is the same whatever the size.
    """
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_t"))
    hot = counts.join(F.broadcast(total), F.col("_n") * 64 > F.col("_t")).select(F.col(key).alias("_hot"))
    b = big.join(F.broadcast(hot), big[key] == F.col("_hot"), "left")
    b = b.withColumn("_salt", F.when(F.col("_hot").isNull(), 0).otherwise(F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int"))).drop("_hot")
    s = small.join(F.broadcast(hot), small[key] == F.col("_hot"), "left")
    s = s.withColumn(
        "_salt",
        F.explode(F.when(F.col("_hot").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(salts - 1)))),
    ).drop("_hot")
    return b.join(s, [key, "_salt"], how).drop("_salt")


def blank_trim(c: Column) -> Column:
    """Without spaces, tabs and no-break spaces at both ends."""
    return F.regexp_replace(c, "^[ \\t\\u00a0]+|[ \\t\\u00a0]+$", "")
