"""Reading and materialising tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table `name` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset a local session gets a temporary one; a cluster is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or "file://" + tempfile.mkdtemp(prefix="cropmill-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    This cuts the lineage with files that outlive a lost executor, stores the rows compressed by column, and fixes
    values that a second evaluation could change (partition ids). The files go when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cropmill-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)
