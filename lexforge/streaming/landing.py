"""Incremental intake: a landing folder of content files is read as a stream, each micro-batch goes through the batch
plan. The stream's own checkpoint says which files were read; the dataset's checkpoint table says which documents are
done, so a batch that runs twice changes nothing. No arrival is dropped for its age: the table `arrivals` holds the time of
the newest content of each document, and only what is older than that is superseded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import store as S
from ..plans import pipeline
from ..sources.config import Config

LANDING = "celex_id string, content_type string, language string, body string, outcome string, error string, metadata array<struct<data_type:string,value:string>>, arrived_at timestamp"


def intake(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """The stream of arrivals, however late they are; repeats are left to the keyed store."""
    return spark.readStream.schema(LANDING).option("maxFilesPerTrigger", max_files).json(folder)


def process_batch(data: S.Dataset, config: Config):
    def run(batch: DataFrame, _: int) -> None:
        known = data.read("arrivals").withColumnRenamed("arrived_at", "_known")
        batch = batch.join(known, "celex_id", "left").where("_known is null or arrived_at is null or arrived_at >= _known").drop("_known")
        newest = S.latest(batch, ["celex_id"], [(F.coalesce("outcome", F.lit("ok")) == "retry").asc(), F.col("arrived_at").desc_nulls_last(), F.xxhash64("body").desc()]).persist()
        try:
            if not newest.isEmpty():
                rows = newest.select("celex_id", F.explode_outer("metadata").alias("m")).select("celex_id", "m.data_type", "m.value")
                pipeline.process(data, config, rows, newest.select("celex_id", "content_type", "language", "body", "outcome", "error"))
                came = newest.where("arrived_at is not null and coalesce(outcome, 'ok') <> 'retry'").select("celex_id", "arrived_at")
                data.write("arrivals", S.upsert(data.read("arrivals"), came, ["celex_id"], "arrived_at"))
        finally:
            newest.unpersist()

    return run


def start(data: S.Dataset, config: Config, folder: str, checkpoint: str, available_now: bool = True, max_files: int = 1000) -> StreamingQuery:
    w = intake(data.spark, folder, max_files).writeStream.option("checkpointLocation", checkpoint).foreachBatch(process_batch(data, config))
    return w.trigger(availableNow=True).start() if available_now else w.start()


def counted(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """The counts of arrivals_per_window kept up to date at `out`: each micro-batch writes the whole of them as a new
    version, named by the batch, so a batch that runs again writes the same."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/v{number:012d}")

    w = stream.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(write)
    return w.trigger(availableNow=True).start()


def latest_counts(spark: SparkSession, out: str) -> DataFrame:
    """The last version that counted() wrote."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(out)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    done = sorted(x.getPath().toString() for x in fs.listStatus(at) if fs.exists(jvm.org.apache.hadoop.fs.Path(x.getPath(), "_SUCCESS")))
    return spark.read.parquet(done[-1])


def arrivals_per_window(stream: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Arrivals and different documents per window of event time; late rows beyond the watermark do not count."""
    return stream.withWatermark("arrived_at", late).groupBy(F.window("arrived_at", window)).agg(F.count(F.lit(1)).alias("arrivals"), F.approx_count_distinct("celex_id").alias("documents"))
