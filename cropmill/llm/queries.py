"""Queries of this subpackage and their SQL. pN_found gives the cases of problem N."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropmill.llm import canonical, grouped_splits, leximin, mixing, overlap, packing, proportions, stuffing
from cropmill.sources.tables import materialize, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    _, report = proportions.sample_to_proportions(table(spark, d, "samples"), table(spark, d, "mix_targets"))
    return report.filter("short").select(*proportions.CELL)


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return proportions.sample_to_proportions(table(spark, d, "samples"), table(spark, d, "mix_targets"))[1]


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    return proportions.sample_to_proportions(table(spark, d, "samples"), table(spark, d, "mix_targets"))[0]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.equal_answers(table(spark, d, "samples"))


def p2_canonical(spark: SparkSession, d: str) -> DataFrame:
    return canonical.canonical_texts(table(spark, d, "samples"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return grouped_splits.broken_groups(table(spark, d, "samples"), table(spark, d, "source_docs"))


def p3_splits(spark: SparkSession, d: str) -> DataFrame:
    return grouped_splits.split_groups(table(spark, d, "samples"), table(spark, d, "source_docs"), table(spark, d, "split_targets"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return leximin.high_in_all(leximin.measured_scores(table(spark, d, "samples")))


def p4_order(spark: SparkSession, d: str) -> DataFrame:
    return leximin.leximin_order(leximin.measured_scores(table(spark, d, "samples")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.ordered(overlap.overlaps(table(spark, d, "samples")))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap.report(table(spark, d, "samples"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return packing.oversized_of(packing.pack(packing.pieces(table(spark, d, "documents")))[0])


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, d, "documents")))[0]


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.report(*packing.pack(packing.pieces(table(spark, d, "documents"))))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(table(spark, d, "documents"), table(spark, d, "source_weights"))[1].filter("short").select("source")


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(table(spark, d, "documents"), table(spark, d, "source_weights"))[0]


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(table(spark, d, "documents"), table(spark, d, "source_weights"))[1]


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.spam_pages(table(spark, d, "documents"))


def p8_replicated(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.replicated_share(table(spark, d, "documents"))


def p8_evidence(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.evidence(table(spark, d, "documents"))


def _one_row(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two rows of different columns as one."""
    return a.unionByName(b, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in (*a.columns, *b.columns)])


def p1_check(spark: SparkSession, d: str) -> DataFrame:
    """One row on the sample: rows, ids that come twice, rows of another cell than their sample has, cells with fewer than the least and with more than the available rows."""
    sample, report = proportions.sample_to_proportions(table(spark, d, "samples"), table(spark, d, "mix_targets"))
    cell = proportions.labelled(table(spark, d, "samples")).select(F.col("id").alias("__id"), F.struct(*proportions.CELL).alias("__cell"))
    rows = sample.join(cell, F.col("id") == F.col("__id"), "left").agg(
        F.count("*").alias("selected"), (F.count("*") - F.countDistinct("id")).alias("repeated"), F.count_if(~F.struct(*proportions.CELL).eqNullSafe(F.col("__cell"))).alias("misplaced")
    )
    per = report.select(*proportions.CELL, "min_rows", "available").join(sample.groupBy(*proportions.CELL).agg(F.count("*").alias("n")), proportions.CELL, "left").na.fill(0, ["n"])
    bounds = per.agg(F.count_if(F.col("n") < F.least("min_rows", "available")).alias("under"), F.count_if(F.col("n") > F.col("available")).alias("over"))
    return _one_row(rows, bounds)


def p3_check(spark: SparkSession, d: str) -> DataFrame:
    """One row on the splits: samples, groups on more than one side, samples in broken groups, and whether each share is within the largest group of its target."""
    splits = grouped_splits.split_groups(table(spark, d, "samples"), table(spark, d, "source_docs"), table(spark, d, "split_targets"))
    groups = splits.groupBy("group").agg(F.count("*").alias("n"), F.countDistinct("new_split").alias("sides"), F.min("new_split").alias("new_split"), F.count_if("broken").alias("broken"))
    shares = groups.groupBy("new_split").agg(F.sum("n").alias("n"), F.max("n").alias("largest"), F.count_if(F.col("sides") > 1).alias("torn"), F.sum("broken").alias("broken"))
    aimed = table(spark, d, "split_targets").select(F.col("split").alias("new_split"), "target_share").join(shares, "new_split", "full").na.fill(0)
    whole = aimed.agg(F.sum("n").alias("samples"), F.max("largest").alias("most"), F.sum("torn").cast("bigint").alias("torn"), F.sum("broken").cast("bigint").alias("broken_samples"), F.collect_list(F.struct("n", "target_share")).alias("each"))
    near = F.forall("each", lambda x: F.abs(x["n"] - x["target_share"] * F.col("samples")) <= F.col("most"))
    return whole.select("samples", "torn", "broken_samples", near.alias("near"))


def p6_check(spark: SparkSession, d: str) -> DataFrame:
    """One row on the containers: documents, containers over capacity, documents whose pieces leave a gap or overlap, documents split that would fit, and whether as few containers are used as a 50th more than the prices allow."""
    packed, made = packing.pack(packing.pieces(table(spark, d, "documents")))
    per = packed.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("length").alias("tokens"), F.max(F.col("start") + F.col("length")).alias("end"), F.sum(F.col("start")).alias("starts"))
    full = packed.groupBy("container").agg(F.sum("length").alias("used"))
    docs = per.agg(F.count("*").alias("documents"), F.count_if((F.col("tokens") != F.col("end")) | (F.col("starts") != packing.CAPACITY * F.col("n") * (F.col("n") - 1) / 2)).alias("gaps"), F.count_if((F.col("n") > 1) & (F.col("tokens") <= packing.CAPACITY)).alias("split_small"))
    boxes = full.agg(F.count_if(F.col("used") > packing.CAPACITY).alias("overfull"), (F.count("*") <= made.bound * 1.02 + 2).alias("few"))
    return _one_row(docs, boxes)


def p7_check(spark: SparkSession, d: str) -> DataFrame:
    """One row on the mix: texts that come twice, used too often or of a source without a weight, sources beyond their budget, sources whose report differs from what was chosen, and sources that are short."""
    mix, report = mixing.mix_sources(table(spark, d, "documents"), table(spark, d, "source_weights"))
    mix, report = materialize(mix), materialize(report)
    per = mix.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("used"), F.max("copies").alias("most"), (F.count("*") - F.countDistinct("doc_id")).alias("twice"))
    both = per.join(report.select("source", "max_repeats", "budget", "used_tokens", "short"), "source", "full")
    return both.agg(
        F.coalesce(F.sum("twice"), F.lit(0)).alias("twice"), F.count_if(F.col("most") > F.col("max_repeats")).alias("too_often"), F.count_if(F.col("budget").isNull()).alias("unlisted"), F.count_if(F.col("used") > F.col("budget")).alias("beyond"),
        F.count_if(F.coalesce("used", F.lit(0)) != F.col("used_tokens")).alias("differs"), F.count("*").alias("sources"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_report, p1_sample, p1_check, p2_found, p2_canonical, p3_found, p3_splits, p3_check, p4_found, p4_order, p5_found, p5_report, p6_found, p6_containers, p6_report, p6_check, p7_found, p7_mix, p7_report, p7_check, p8_found, p8_replicated, p8_evidence)}
