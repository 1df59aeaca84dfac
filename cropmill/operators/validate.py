"""Checks of exported pairs before training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropmill.functions import text
from cropmill.operators.importing import first_error
from cropmill.operators.pairs import pair_digest


def validate_pairs(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with pair_hash and `problem`, null for a valid pair; of equal pairs the first by `order` is valid.

    Null messages, images and answers are problems of their own.
    """
    m = lambda i: F.get(F.col("messages"), F.lit(i))
    content = F.coalesce(m(0)["content"], F.lit(""))
    marks = (F.char_length(content) - F.char_length(F.replace(content, F.lit("<image>")))) / len("<image>")
    blank = lambda c: F.coalesce(text.strip(c), F.lit("")) == ""
    chosen = m(1)["content"]
    rows = rows.withColumn("pair_hash", pair_digest(F.struct("messages", "images", "rejected_response")))
    seen = F.row_number().over(W.partitionBy("pair_hash").orderBy(*order)) > 1
    problem = first_error(
        (~F.coalesce((F.size("messages") == 2) & (m(0)["role"] == "user") & (m(1)["role"] == "assistant"), F.lit(False)), "two messages, user and assistant, required"),
        (F.coalesce(marks, F.lit(0)) != 1, "one <image> mark required"),
        (F.coalesce(F.size("images"), F.lit(0)) != 1, "one image required"),
        (blank(chosen) | blank(F.col("rejected_response")), "blank answer"),
        (chosen == F.col("rejected_response"), "chosen equals rejected"),
        (seen, "duplicate pair"),
    )
    return rows.withColumn("problem", problem)


def preflight(rows: DataFrame, chosen: str, rejected: str, config: dict, ignored: int = -100) -> DataFrame:
    """`verdict` of encoded pairs, arrays of label ids: overlength, or a side without a trainable token; null when fit. Null arrays have none."""
    size = F.greatest(F.coalesce(F.size(chosen), F.lit(0)), F.coalesce(F.size(rejected), F.lit(0)))
    trains = lambda c: F.coalesce(F.exists(c, lambda x: x != ignored), F.lit(False))
    verdict = (
        F.when(size > config["training"]["max_length"], F.concat(F.lit("overlength: "), size.cast("string")))
        .when(~trains(chosen), "no trainable chosen response tokens")
        .when(~trains(rejected), "no trainable rejected response tokens")
    )
    return rows.withColumn("length", size).withColumn("verdict", verdict)


def align(pairs: DataFrame, audit: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, problem) where pairs and their audit don't go together: one side missing, or digests that differ."""
    a, b = pairs.select(F.col(key).alias("__a"), F.col(digest).alias("__da")), audit.select(F.col(key).alias("__b"), F.col(digest).alias("__db"))
    both = a.join(b, F.col("__a") == F.col("__b"), "full")
    problem = F.when(F.col("__b").isNull(), "no audit").when(F.col("__a").isNull(), "no pair").when(~F.col("__da").eqNullSafe(F.col("__db")), "digest differs")
    return both.select(F.coalesce("__a", "__b").alias(key), problem.alias("problem")).filter("problem IS NOT NULL")


def overlapping_ids(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows that repeat a key, with the number of the repeat; nulls don't repeat."""
    return df.filter(F.col(key).isNotNull()).withColumn("repeat", F.row_number().over(W.partitionBy(key).orderBy(*order)) - 1).filter("repeat > 0")
