"""Continuous import: new JSONL records and answers go into their tables as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENT = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def read_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """JSONL files of a folder as a stream, in the order they appear."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """(start, event_type, n, total) by window of event time; events later than `late` are dropped by the watermark."""
    by = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return by.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def latest(rows: DataFrame, key: str, version: str) -> DataFrame:
    """One row a key: that of the greatest version; ties by the whole row."""
    others = [c for c in rows.columns if c not in (key, version)]
    return rows.groupBy(key).agg(F.max(F.struct(version, *others)).alias("r")).select(key, "r.*").select(*rows.columns)


def upsert_into(folder: str, key: str, version: str):
    """A foreachBatch function that lays each batch upon the table in `folder`: the latest version of a key stays.

    The new state is written beside the old one under the batch's number and then named in CURRENT, so a batch that is
    run again after a failure gives the same state.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        fs = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(conf)
        before = [s.getPath().getName() for s in (fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder)) if fs.exists(jvm.org.apache.hadoop.fs.Path(folder)) else [])]
        done = sorted(int(n[6:]) for n in before if n.startswith("epoch=") and int(n[6:]) < epoch and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS")))
        rows = batch if not done else spark.read.parquet(f"{folder}/epoch={done[-1]}").unionByName(batch, allowMissingColumns=True)
        latest(rows, key, version).write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")

    return apply


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The table after the last finished batch."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    names = [s.getPath().getName() for s in path.getFileSystem(conf).listStatus(path)]
    done = [int(n[6:]) for n in names if n.startswith("epoch=") and path.getFileSystem(conf).exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))]
    return spark.read.parquet(f"{folder}/epoch={max(done)}")


def start(stream: DataFrame, folder: str, key: str, version: str, checkpoint: str) -> StreamingQuery:
    """Run over what is there and stop; run again for what has come since."""
    return stream.writeStream.foreachBatch(upsert_into(folder, key, version)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
