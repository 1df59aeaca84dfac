"""Quotas: apportionment, stratified selection with backfill, exact quantiles."""

from __future__ import annotations

import math
import random
from array import array
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropmill.functions.ordering import hash_order
from cropmill.operators.ranking import global_rank
from cropmill.sources.tables import materialize


def apportion(total: int, ratios: dict[str, float]) -> dict[str, int]:
    """Integers that sum to `total` in the given ratios: floors, then one more by largest remainder, ties by name."""
    whole = sum(ratios.values())
    exact = {k: total * v / whole for k, v in ratios.items()}
    out = {k: math.floor(v) for k, v in exact.items()}
    by_remainder = sorted(exact, key=lambda k: (out[k] - exact[k], str(k)))
    for k in by_remainder[: total - sum(out.values())]:
        out[k] += 1
    return out


def apportion_table(shares: DataFrame, total: Column | int, share: str, name: Column, quota: str = "quota") -> DataFrame:
    """`apportion` as a plan: append the quota of each row of a small table of shares."""
    whole = F.sum(share).over(W.partitionBy(F.lit(1)))
    exact = F.lit(total) * F.col(share) / whole if isinstance(total, int) else total * F.col(share) / whole
    t = shares.withColumn("__exact", exact).withColumn("__floor", F.floor("__exact"))
    left = (F.lit(total) if isinstance(total, int) else total) - F.sum("__floor").over(W.partitionBy(F.lit(1)))
    t = t.withColumn("__left", left).withColumn("__rn", F.row_number().over(W.orderBy((F.col("__exact") - F.col("__floor")).desc(), name)))
    return t.withColumn(quota, F.col("__floor") + (F.col("__rn") <= F.col("__left")).cast("bigint")).drop("__exact", "__floor", "__left", "__rn")


def desired_quotas(budget: int, config: dict, bucketed: bool = False) -> dict[str, int]:
    """{domain/task[/bucket]: quota}; an axis without a mixture is `*`."""
    axes = [config["mixture"].get("domain") or {"*": 1}, config["mixture"].get("task") or {"*": 1}]
    if bucketed:
        axes.append(config["mining"]["buckets"])
    return apportion(budget, {"/".join(k for k, _ in p): math.prod(v for _, v in p) for p in product(*(a.items() for a in axes))})


def category(config: dict, bucketed: bool = False) -> Column:
    parts = [F.col("domain") if config["mixture"].get("domain") else F.lit("*"), F.col("task") if config["mixture"].get("task") else F.lit("*")]
    return F.concat_ws("/", *parts, *([F.col("mining_bucket")] if bucketed else []))


def priority_order(config: dict, bucketed: bool = False) -> list[Column]:
    """Highest priority first, then by id; coverage rows of a bucketed selection by their hash instead."""
    rank = -F.coalesce(F.col("signals.priority"), F.lit(0.0))
    if bucketed:
        rank = F.when(F.col("mining_bucket") == "coverage", -hash_order(config["seed"], F.col("id").cast("string"))).otherwise(rank)
    return [rank.alias("__a"), F.col("id").cast("string").alias("__b")]


def shuffled_order(rows: DataFrame, order: list[Column], seed: int) -> DataFrame:
    """Append `__place`: where the Mersenne Twister shuffle of Python puts the row, given its position in `order`.

    The permutation depends on the number of rows only. It is computed on the driver, at 8 bytes a row and as much again
    for the table, for the rows of one bucket of a mining run, of which at most 50 million are taken on.
    """
    at = global_rank(rows, order, materialize, name="__at")
    n = at.count()
    if n > 50_000_000:
        raise ValueError("too many rows to shuffle in the order of a sequential generator; use the hash order")
    places = array("q", range(n))
    random.Random(seed).shuffle(places)
    moved = rows.sparkSession.createDataFrame(pa.table({"__at": np.frombuffer(places, np.int64) + 1 if n else np.empty(0, np.int64), "__place": np.arange(n)}))
    return at.join(moved, "__at").drop("__at")


def stratify(rows: DataFrame, budget: int, config: dict, order: list[Column], bucketed: bool = False) -> tuple[DataFrame, DataFrame]:
    """(selected rows with `__position`, report by category): `stratify_each` for one budget."""
    chosen, report = stratify_each(rows, {"": budget}, F.lit(""), config, order, bucketed)
    return chosen.drop("__bucket"), report.drop("bucket")


def stratify_each(rows: DataFrame, budgets: dict[str, int], bucket: Column, config: dict, order: list[Column], bucketed: bool = False) -> tuple[DataFrame, DataFrame]:
    """(selected rows with `__bucket` and `__position`, report by bucket and category): every bucket has a budget of its own.

    Each category takes its quota in `order`, then the rows left over fill up to the budget in that order. `order` must
    be total. Only the order and the category of a row are ranked: by a window over each category that keeps no more
    than the budget of it (a top-k the window prunes before the shuffle), then by a top-k of each bucket. The rows
    chosen, at most the budgets, are joined to the rest of their columns. A budget of 0 selects nothing; empty tables and
    rows of a bucket without a budget select nothing.
    """
    spark = rows.sparkSession
    quotas = [(b, c, q) for b, n in budgets.items() for c, q in desired_quotas(n, config, bucketed).items()]
    wanted = spark.createDataFrame(quotas, "__bucket string, __cat string, __desired bigint")
    allowed = F.lit(0)
    for b, n in budgets.items():
        allowed = F.when(F.col("__bucket") == b, n).otherwise(allowed)
    most = max(budgets.values())
    names = [f"__o{i}" for i in range(len(order))]
    keyed = rows.withColumn("__bucket", bucket).withColumn("__cat", category(config, bucketed)).withColumns({n: o for n, o in zip(names, order)})
    keyed = keyed.withColumn("__row", F.struct(F.xxhash64(*names).alias("a"), F.xxhash64(F.lit(1), *names).alias("b")))
    slim = keyed.filter(F.col("__bucket").isin(*budgets)).select("__row", "__bucket", "__cat", *names)
    within = slim.withColumn("__rn", F.row_number().over(W.partitionBy("__bucket", "__cat").orderBy(*names))).filter(F.col("__rn") <= most)
    placed = within.join(F.broadcast(wanted), ["__bucket", "__cat"], "left").withColumn("__in", F.col("__rn") <= F.coalesce("__desired", F.lit(0)))
    placed = materialize(placed)
    top = placed.withColumn("__position", F.row_number().over(W.partitionBy("__bucket").orderBy(F.col("__in").desc(), *names))).filter(F.col("__position") <= most)
    top = materialize(top.filter(F.col("__position") <= allowed).select("__row", "__bucket", "__cat", "__position"))
    chosen = keyed.drop("__cat", "__bucket").join(top.drop("__cat"), "__row")
    counts = placed.filter("__in").groupBy("__bucket", "__cat").agg(F.count("*").alias("in_quota"))
    actual = top.groupBy("__bucket", "__cat").agg(F.count("*").alias("actual"))
    report = wanted.join(counts, ["__bucket", "__cat"], "left").join(actual, ["__bucket", "__cat"], "full")
    report = report.select(F.col("__bucket").alias("bucket"), F.col("__cat").alias("category"), *[F.coalesce(c, F.lit(0)).alias(n) for n, c in (("desired", "__desired"), ("in_quota", "in_quota"), ("actual", "actual"))])
    report = report.withColumn("shortfall", F.greatest(F.col("desired") - F.col("in_quota"), F.lit(0)))
    return chosen.drop("__row", *names), report


def quantiles(rows: DataFrame, groups: list[str], value: str, qs: list[float], tie: str) -> DataFrame:
    """(groups, q, threshold): exact quantiles by linear interpolation, bit for bit as a[lo] + (a[hi] - a[lo]) * (p - lo).

    Values are ranked by a global order over (group, value), so no group is gathered; two order statistics a quantile
    are then picked. Groups without a value have no row. Nulls don't count.
    """
    have = rows.filter(F.col(value).isNotNull()).select(*groups, F.col(value).alias("__v"), F.col(tie).alias("__t"))
    ranked = global_rank(have, [*map(F.col, groups), F.col("__v"), F.col("__t")], materialize, name="__at")
    ends = ranked.groupBy(*groups).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    each = ends.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs]))).withColumn("__p", (F.col("__n") - 1) * F.col("q"))
    each = F.broadcast(each.withColumn("__lo", F.floor("__p")).withColumn("__hi", F.ceil("__p")))
    at = ranked.select(*groups, "__v", "__at").join(each, groups).filter((F.col("__at") == F.col("__first") + F.col("__lo")) | (F.col("__at") == F.col("__first") + F.col("__hi")))
    low = F.max(F.when(F.col("__at") == F.col("__first") + F.col("__lo"), F.col("__v")))
    high = F.max(F.when(F.col("__at") == F.col("__first") + F.col("__hi"), F.col("__v")))
    part = F.first(F.col("__p") - F.col("__lo"))
    return at.groupBy(*groups, "q").agg((low + (high - low) * part).alias("threshold"))
