"""One order of items from scores on different scales.

Each score becomes its percentile: the part of the measured items it is strictly higher than. An item's own percentiles
are sorted ascending, and items are ordered by these arrays lexicographically, highest first (leximin). The weakest
score decides first, so neither a large range nor a single huge value can carry an item up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropmill.functions import notation
from cropmill.operators.ranking import ROWS_PER_BUCKET, global_rank, ranges
from cropmill.sources.tables import materialize

SCORES = ("regression", "disagreement", "candidate_gap", "priority")


def measured_scores(samples: DataFrame, scores: tuple[str, ...] = SCORES) -> DataFrame:
    """One row a different sample: id and its scores, null where null or NaN. Deliveries of a sample count once."""
    cols = [notation.measured(F.col(f"signals.{s}")).alias(s) for s in scores]
    return samples.select(notation.record_id(F.col("id")).alias("id"), *cols).filter(F.col("id").isNotNull()).groupBy("id").agg(*[F.max(s).alias(s) for s in scores])


def percentiles(items: DataFrame, scores: tuple[str, ...] = SCORES, rows_per_task: int = ROWS_PER_BUCKET) -> DataFrame:
    """(id, score, value, less, n): for each measured value how many of the n measured values of that score are lower.

    Values are ranged by (score, value, id), so a value that a third of the items share is spread over many tasks. A
    table with one row a range and score says at which position the run of its first value began; all other runs begin
    inside their range.
    """
    long = items.select("id", F.explode(F.array(*[F.struct(F.lit(s).alias("score"), F.col(s).alias("value")) for s in scores])).alias("__s")).select("id", "__s.*").filter(F.col("value").isNotNull())
    order = [F.col("score"), F.col("value"), F.col("id")]
    ranged = materialize(long.repartitionByRange(ranges(long.count(), rows_per_task), *order).withColumn("__part", F.spark_partition_id()))
    runs = ranged.groupBy("score", "__part").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    last = ranged.join(F.broadcast(runs), ["score", "__part"]).filter(F.col("value") == F.col("high")).groupBy("score", "__part").agg(F.count("*").alias("at_high"))
    table, starts, totals = {}, [], {}
    for r in runs.join(last, ["score", "__part"]).collect():  # at most MOST_RANGES ranges
        table[r["score"], r["__part"]] = r
    before: dict[str, tuple[int, float | None, int]] = {}  # score: rows so far, last value, position where its run began
    for score, part in sorted(table):
        r = table[score, part]
        done, value, began = before.get(score, (0, None, 0))
        first = began if value == r["low"] else done
        starts.append((score, part, r["low"], first, done))
        run = first if r["low"] == r["high"] else done + r["n"] - r["at_high"]
        before[score] = (done + r["n"], r["high"], run)
        totals[score] = totals.get(score, 0) + r["n"]
    spark = items.sparkSession
    side = spark.createDataFrame([(*s, totals[s[0]]) for s in starts], "score string, __part int, __low double, __first bigint, __done bigint, n bigint")
    local = ranged.withColumn("__rank", F.rank().over(W.partitionBy("score", "__part").orderBy("value")) - 1)
    less = F.when(F.col("value") == F.col("__low"), F.col("__first")).otherwise(F.col("__done") + F.col("__rank"))
    return local.join(F.broadcast(side), ["score", "__part"]).select("id", "score", "value", less.alias("less"), "n")


def standings(items: DataFrame, scores: tuple[str, ...] = SCORES) -> DataFrame:
    """(id, measured, standing): the number of measured scores and their percentiles in ascending order."""
    shares = percentiles(items, scores).groupBy("id").agg(F.sort_array(F.collect_list(F.col("less") / F.col("n"))).alias("standing"))
    return shares.select("id", F.size("standing").alias("measured"), "standing")


def leximin_order(items: DataFrame, scores: tuple[str, ...] = SCORES) -> DataFrame:
    """(id, measured, standing, rank): every item with its position in the one order, 1 first.

    Arrays are compared from the weakest score up; where one is the beginning of the other, the item with more measured
    scores comes first; items of equal arrays follow by id. Items with no measured score come last, with an empty
    array. Infinite values are values. Items must have an `id`, each once.
    """
    all_ = items.select("id").join(standings(items, scores), "id", "left").select("id", F.coalesce("measured", F.lit(0)).alias("measured"), F.coalesce("standing", F.array().cast("array<double>")).alias("standing"))
    return global_rank(materialize(all_), [F.col("standing").desc(), F.col("id").asc()], materialize)


def high_in_all(items: DataFrame, at_least: int = 3, share: float = 0.95, scores: tuple[str, ...] = SCORES) -> DataFrame:
    """(id): items with `at_least` measured scores of which the weakest stands strictly above `share` of the measured items."""
    return standings(items, scores).filter((F.col("measured") >= at_least) & (F.col("standing")[0] >= share)).select("id")
