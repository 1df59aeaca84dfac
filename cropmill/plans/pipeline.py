"""The whole run: import, ask, score, shortlist, sample, score again, mine, pair, export, report."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropmill.operators import importing, inference, isolate, mine, pairs, report, score
from cropmill.sources import files
from cropmill.sources.tables import materialize

#: The shortlist that is sampled is this many times the budget.
SHORTLIST = 3
ORDER = ["_ord"]


def _image(rows: DataFrame) -> Column:
    return F.nullif(F.col("image"), F.lit("")) if "image" in rows.columns else F.lit(None).cast("string")


def _listed(rows: DataFrame) -> Column:
    """The image_url of every entry of image_info."""
    kind = rows.schema["image_info"].dataType if "image_info" in rows.columns else None
    there = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and "image_url" in kind.elementType.names
    return F.coalesce(F.col("image_info.image_url") if there else F.array().cast("array<string>"), F.array().cast("array<string>"))


def _hashes(paths: DataFrame, base: str, config: dict) -> DataFrame:
    """(paths) -> image_hash, pixel_hash and image_error of each."""
    each = paths.select(F.explode_outer(F.array_distinct(F.array_compact("paths"))).alias("image")).filter("image != ''").distinct()
    return materialize(files.with_image_hashes(each, base, data=config["data"]))


def guards(rows: DataFrame, config: dict, base: str) -> DataFrame:
    """Identities that train rows may not share, beside those of the samples: every image of the held-out records, valid or not, and the rows of data.exclude_manifests.

    Images of a manifest start from its folder and are hashed where no pixel_hash is given; one that can't be read is an error, as it would guard nothing.
    """
    held = rows.filter(~isolate.is_train(rows))
    out = _hashes(held.select(F.concat(F.array(_image(held)), _listed(held)).alias("paths")), base, config).select("image_hash", "pixel_hash")
    for path in config["data"]["exclude_manifests"]:
        manifest = files.read_rows(rows.sparkSession, str(path))
        image = _image(manifest)
        known = F.coalesce(F.col("pixel_hash").cast("string"), F.lit("")) != "" if "pixel_hash" in manifest.columns else F.lit(False)
        paths = F.when(image.isNull(), _listed(manifest)).when(~known, F.array(image))
        hashed = _hashes(manifest.select(paths.alias("paths")), str(Path(path).expanduser().resolve().parent), {"data": {**config["data"], "image_root": None}})
        if lost := hashed.filter("pixel_hash IS NULL").select("image", "image_error").take(1):
            raise ValueError(f"{path}: {lost[0].image}: {lost[0].image_error}")
        out = out.unionByName(hashed.select("image_hash", "pixel_hash"), allowMissingColumns=True).unionByName(isolate.identities(manifest), allowMissingColumns=True)
    return out


def convert(raw: DataFrame, config: dict, base: str, excluded: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(samples, rejected with reason) from raw records, SFT records included; no train sample shares a document or image with held-out or excluded data.

    Rejected records that could not be imported carry input_index, their place, and raw, the record as it came.
    """
    raw = materialize(raw)
    more = guards(importing.map_fields(raw, config["fields"]), config, base)
    excluded = more if excluded is None else more.unionByName(isolate.identities(excluded), allowMissingColumns=True)
    rows = importing.adapt_sft(raw) if {"image_info", "text_info"} <= set(raw.columns) else raw
    rows = files.with_image_hashes(importing.map_fields(rows, config["fields"]), base, data=config["data"])
    out = materialize(importing.import_rows(rows, config, ORDER, excluded))
    came = raw.select(F.col("_ord").alias("input_index"), F.to_json(F.struct(*[c for c in raw.columns if c != "_ord"])).alias("raw"))
    bad = out.filter("reason IS NOT NULL")
    failed = bad.filter(F.col("reason").startswith("import_error: ")).join(came, F.col("_ord") == F.col("input_index"))
    bad = failed.unionByName(bad.filter(~F.col("reason").startswith("import_error: ")), allowMissingColumns=True)
    return out.filter("reason IS NULL").drop("reason", "duplicate_of", "image_error", "sft_error"), bad


def infer(rows: DataFrame, config: dict, endpoints: dict, provider: inference.Provider, cache: str | None = None, sampling: bool = False) -> DataFrame:
    """The rows with candidates; answers in the cache folder are used again, new ones are added to it."""
    if sampling and (changed := inference.changed_provenance(rows, config, endpoints).take(1)):
        raise ValueError(f"prompt, image or model of {changed[0].id} changed since its greedy answers; ask again")
    wanted = materialize(inference.requests(rows, config, endpoints, sampling))
    spark = rows.sparkSession
    known = spark.read.schema(inference.ANSWER).parquet(cache) if cache and Path(cache).exists() else spark.createDataFrame([], inference.ANSWER)
    known = materialize(known)
    fresh = materialize(inference.ask(inference.misses(wanted, known), provider, config))
    if cache:
        fresh.write.mode("append").parquet(cache)
    good = known.filter("status = 'ok'").dropDuplicates(["id"]).unionByName(fresh)
    return materialize(inference.attach(rows, wanted, good, sampling))


def export_pairs(selected: DataFrame, pending: DataFrame, quota_report: DataFrame, out: str) -> dict:
    """Five artifacts beside `out`: pairs, audit, selected rows, pending rows, statistics."""
    order = [F.col("position")]
    files.write_jsonl(selected.select("pair.*", "position"), f"{out}.pairs", order, one_file=True)
    files.write_jsonl(selected.select("pair_audit.*", "position"), f"{out}.audit", order, one_file=True)
    files.write_jsonl(selected.drop("pair", "pair_audit"), f"{out}.selected", order)
    files.write_jsonl(pending, f"{out}.pending")
    stats = {"selected": selected.count(), "pending": pending.count(), "quota": [r.asDict() for r in quota_report.collect()]}
    files.write_json(stats, f"{out}.stats.json")
    return stats


def run(raw: DataFrame, config: dict, endpoints: dict, provider: inference.Provider, base: str, out: str, cache: str | None = None) -> dict:
    """All stages; returns the statistics that are written."""
    rows, errors = convert(raw, config, base)
    rows = infer(rows, config, endpoints, provider, cache)
    dead = [r.role for r in inference.role_liveness(rows).filter("NOT alive").collect()]
    if dead:
        raise RuntimeError(f"no answer of {', '.join(dead)}")
    scored = materialize(score.score_rows(rows, config))
    wide = {**config, "mining": {**config["mining"], "budget": config["mining"]["budget"] * SHORTLIST}}
    short, _, _ = mine.mine_rows(scored, wide, ORDER)
    short = short.drop("mining_bucket", "mining_backfill", "position", "signals")
    sampled = materialize(score.score_rows(infer(short, config, endpoints, provider, cache, True), config))
    chosen, skipped, _ = mine.mine_rows(sampled, config, ORDER)
    chosen = materialize(chosen.drop("position"))
    selected, pending, quota_report = pairs.build_pairs(chosen, config, ORDER)
    slim = lambda df: df.select(F.col("id").cast("string").alias("id"), "reason")
    left = slim(pending).unionByName(slim(skipped)).unionByName(slim(errors))
    stats = export_pairs(selected, left, quota_report, f"{out}/dpo")
    report.write_report(selected, left, f"{out}/report", ["position"], config["report"]["page_size"], before=scored)
    return stats
