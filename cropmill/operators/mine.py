"""Mining: thresholds, buckets, selection by quota, and why the rest was left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropmill.config import TASKS
from cropmill.operators import quota
from cropmill.operators.isolate import is_train, isolate, kept, rejected
from cropmill.sources.tables import materialize


def trusted() -> Column:
    """A missing trust mark means trusted."""
    return F.coalesce(F.col("gt_trusted"), F.lit(True))


def eligible(rows: DataFrame) -> DataFrame:
    return rows.filter(is_train(rows) & F.col("score_gt").isNotNull() & trusted())


def task_thresholds(rows: DataFrame, config: dict) -> DataFrame:
    """(task, low, high) of the gt error of eligible rows, for each of the three tasks; 0 without values."""
    qs = config["mining"]["middle_quantiles"]
    errors = rows.select("task", "id", F.col("signals.gt_error").alias("e"))
    found = quota.quantiles(errors, ["task"], "e", sorted(set(qs)), "id")
    pick = lambda q: F.max(F.when(F.col("q") == float(q), F.col("threshold")))
    wide = found.groupBy("task").agg(pick(qs[0]).alias("low"), pick(qs[1]).alias("high"))
    tasks = rows.sparkSession.createDataFrame([(t,) for t in TASKS], "task string")
    return tasks.join(wide, "task", "left").select("task", F.coalesce("low", F.lit(0.0)).alias("low"), F.coalesce("high", F.lit(0.0)).alias("high"))


def bucket(config: dict) -> Column:
    """regression, learnable or coverage, for rows that carry `low` and `high` of their task."""
    s = lambda k: F.col(f"signals.{k}")
    worse = F.coalesce(s("regression"), F.lit(0.0)) >= config["mining"]["regression_threshold"]
    middle = s("gt_error").between(F.col("low"), F.col("high")) & (F.coalesce(s("candidate_gap"), F.lit(0.0)) >= config["pairs"]["margin"])
    return F.when(worse, "regression").when(middle, "learnable").otherwise("coverage")


def assign_buckets(rows: DataFrame, config: dict) -> DataFrame:
    """Eligible rows with an sft score, with `mining_bucket`; other rows don't come out."""
    able = eligible(rows)
    scored = able.filter(F.col("signals.sft_score").isNotNull())
    marked = scored.drop("mining_bucket").join(F.broadcast(task_thresholds(able, config)), "task")
    return marked.withColumn("mining_bucket", bucket(config)).drop("low", "high")


def mine_rows(rows: DataFrame, config: dict, order: list[Column]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(chosen, excluded with reason, report by bucket and category).

    chosen has mining_bucket, mining_backfill and `position`, the place in the output. Coverage rows are drawn in the
    seeded shuffle of their order of arrival (`order`), the other buckets by priority; what a bucket can't fill is
    filled from all rows left. Rows are excluded once, with the first reason that holds.
    """
    isolated = materialize(isolate(rows, order))
    clean = kept(isolated)
    marked = materialize(assign_buckets(clean, config))
    budgets = quota.apportion(config["mining"]["budget"], config["mining"]["buckets"])
    stages = {name: i for i, name in enumerate(budgets)}
    coverage = marked.filter("mining_bucket = 'coverage'").select("id", F.struct(*order).alias("__arrived"))
    places = quota.shuffled_order(coverage, [F.col("__arrived")], config["seed"]).select("id", "__place")
    rank = F.coalesce(F.col("__place").cast("double"), -F.coalesce(F.col("signals.priority"), F.lit(0.0)))
    chosen, reports = quota.stratify_each(marked.join(places, "id", "left"), budgets, F.col("mining_bucket"), config, [rank, F.col("id").cast("string")])
    stage = F.lit(None).cast("int")
    for name, i in stages.items():
        stage = F.when(F.col("__bucket") == name, i).otherwise(stage)
    chosen = materialize(chosen.drop("__place").withColumn("__stage", stage).drop("__bucket"))
    deficit = max(0, config["mining"]["budget"] - chosen.count())
    rest = marked.join(chosen.select("id"), "id", "left_anti")
    filled, report = quota.stratify(rest, deficit, config, quota.priority_order(config))
    reports = reports.withColumnRenamed("bucket", "stage").unionByName(report.withColumn("stage", F.lit("backfill")))
    every = materialize(chosen.withColumn("mining_backfill", F.lit(False)).unionByName(filled.withColumn("__stage", F.lit(len(budgets))).withColumn("mining_backfill", F.lit(True))))
    out = every.withColumn("position", F.struct("__stage", "__position")).drop("__stage", "__position")
    unscored = is_train(clean) & F.col("score_gt").isNotNull() & trusted() & F.col("signals.sft_score").isNull()
    reason = (
        F.when(unscored, "missing_or_failed_sft_score")
        .when(~is_train(clean), "held_out")
        .when(F.col("score_gt").isNull(), "missing_gt_disagreement_only")
        .when(~trusted(), "untrusted_gt")
        .otherwise("not_selected_budget")
    )
    left = clean.join(every.select("id"), "id", "left_anti").withColumn("reason", reason).withColumn("duplicate_of", F.lit(None).cast("string"))
    return out, rejected(isolated).unionByName(left), reports
