"""Views of the tables that the queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropmill.functions import notation
from cropmill.sources.tables import table


def arrival() -> list[Column]:
    """The order of samples: as they arrived, then by id."""
    return [F.col("ingested_at"), F.col("batch_no"), F.col("id")]


def clean_samples(spark: SparkSession, d: str) -> DataFrame:
    """Different samples, as first delivered, in one notation; NaN signals are null; target and score_gt are the gt."""
    s = table(spark, d, "samples")
    signals = F.struct(*[notation.measured(F.col(f"signals.{f}")).alias(f) for f in s.schema["signals"].dataType.fieldNames()])
    s = s.withColumns({
        "id": notation.record_id(F.col("id")), "document_id": notation.document_id(F.col("document_id")), "split": notation.split(F.col("split")), "signals": signals,
        **{c: notation.label(F.col(c)) for c in ("task", "domain", "source", "mining_bucket", "language", "gt_format")},
        **{c: notation.content_hash(F.col(c)) for c in ("pixel_hash", "parent_image_hash")},
    })
    first = F.row_number().over(W.partitionBy("id").orderBy("ingested_at", "batch_no"))
    return s.withColumn("__rn", first).filter(F.col("__rn") == 1).drop("__rn").withColumn("target", F.col("gt")).withColumn("score_gt", F.col("gt"))


def tensors(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as tensors of four models: a vector is the tensor vec_id div 4 of model vec_id mod 4."""
    e = table(spark, d, "embeddings")
    return e.select(F.concat(F.lit("m"), (F.col("vec_id") % 4).cast("string")).alias("model"), F.lpad(F.expr("vec_id div 4").cast("string"), 9, "0").alias("key"), F.array(F.size("embedding")).alias("shape"), F.lit("F32").alias("dtype"), F.col("embedding").alias("values"), "label")
