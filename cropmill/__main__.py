"""python -m cropmill COMMAND: the stages on JSON and JSONL files."""

from __future__ import annotations

import argparse
import importlib
import json
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cropmill import config as configuration
from cropmill.operators import mine, pages, pairs, report, score, synthesis, tensors, validate
from cropmill.plans import pipeline
from cropmill.plans.runtime import ship
from cropmill.sources import files
from cropmill.sources.tables import materialize


def load(path: str | None) -> dict:
    """A configuration file: JSON, or YAML where its library is there."""
    if not path:
        return configuration.load()
    text = Path(path).read_text()
    try:
        return configuration.load(json.loads(text))
    except json.JSONDecodeError:
        import yaml

        return configuration.load(yaml.safe_load(text) or {})


def named(spec: str):
    """module:function"""
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="cropmill")
    p.add_argument("command", choices=["convert", "infer", "score", "mine", "build-dpo", "report", "run", "train", "parse-pages", "average", "synth-template", "synth-variants", "synth-check", "synth-agent", "synth-render"])
    p.add_argument("-i", "--input")
    p.add_argument("-o", "--output", required=True)
    p.add_argument("-c", "--config")
    p.add_argument("--provider", help="module:function that answers a request, a page or a proposal")
    p.add_argument("--review", help="module:function that reviews a proposal")
    p.add_argument("--renderer", help="module:function that renders a page as a PNG")
    p.add_argument("--max-seeds", type=int, default=3)
    p.add_argument("--cache")
    p.add_argument("--sampling", action="store_true")
    p.add_argument("--mode", choices=["model_pair", "gt_pair", "hybrid"])
    p.add_argument("--pending")
    p.add_argument("--revision", default="1")
    p.add_argument("--models", nargs="*", default=[])
    p.add_argument("--weights", nargs="*", type=float)
    p.add_argument("--dtype", default="BF16")
    p.add_argument("--shard-mb", type=int, default=2000)
    p.add_argument("--variants", type=int, default=2)
    a = p.parse_args(argv)
    if a.input and Path(a.input).resolve() == Path(a.output).resolve():
        p.error("output must not be the input")
    c = load(a.config)
    if a.mode:
        c["pairs"]["mode"] = a.mode
    spark = SparkSession.builder.appName("cropmill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    rows = files.read_rows(spark, a.input) if a.input and a.command not in ("average",) else None
    order = [F.col("_ord")]
    endpoints = c.get("models", {})
    if a.command == "convert":
        good, bad = pipeline.convert(rows, c, str(Path(a.input).resolve().parent))
        files.write_jsonl(good, a.output, order)
        files.write_jsonl(bad, f"{a.output}.errors", order)
    elif a.command == "infer":
        files.write_jsonl(pipeline.infer(rows, c, endpoints, named(a.provider), a.cache, a.sampling), a.output, order)
    elif a.command == "score":
        files.write_jsonl(score.score_rows(rows, c), a.output, order)
    elif a.command == "mine":
        chosen, left, stats = mine.mine_rows(rows, c, ["_ord"])
        files.write_jsonl(chosen, a.output, [F.col("position")])
        files.write_jsonl(left, f"{a.output}.pending", order)
        files.write_json([r.asDict() for r in stats.collect()], f"{a.output}.stats.json")
    elif a.command == "build-dpo":
        pipeline.export_pairs(*pairs.build_pairs(rows, c, ["_ord"]), a.output)
    elif a.command == "report":
        pending = files.read_rows(spark, a.pending) if a.pending else spark.createDataFrame([], "id string, reason string")
        report.write_report(rows, pending, a.output, ["_ord"], c["report"]["page_size"])
    elif a.command == "run":
        files.write_json(configuration.redact(c), f"{a.output}/config.resolved.json")
        pipeline.run(rows, c, endpoints, named(a.provider), str(Path(a.input).resolve().parent), a.output, a.cache)
    elif a.command == "train":
        files.write_jsonl(validate.validate_pairs(rows, order).select("_ord", "pair_hash", "problem"), a.output, order)
    elif a.command == "parse-pages":
        inputs = pages.check_inputs(files.with_image_hashes(rows, str(Path(a.input).resolve().parent), data=c["data"]))
        todo = inputs.filter("problem IS NULL AND image_hash IS NOT NULL").withColumn("key", pages.page_key(a.revision, F.col("image_hash"))).select("stem", "key", "image")
        done = spark.read.schema(pages.STATUS).parquet(a.output) if Path(a.output).exists() else spark.createDataFrame([], pages.STATUS)
        pages.export(pages.open_pages(todo, done), named(a.provider)).write.mode("append").parquet(a.output)
        latest = spark.read.schema(pages.STATUS).parquet(a.output).join(inputs.withColumn("key", pages.page_key(a.revision, F.col("image_hash"))).select("stem", "key"), ["stem", "key"], "left_semi")
        pages.write_pages(latest, f"{a.output}.pages")
    elif a.command == "average":
        weights = dict(zip(a.models, a.weights or [1.0] * len(a.models)))
        configs, beside = zip(*map(files.beside_weights, a.models))
        if problems := tensors.config_problems(dict(zip(a.models, configs))) + tensors.side_problems(dict(zip(a.models, beside))):
            raise SystemExit(f"checkpoints don't fit: {problems[:5]}")
        table = files.read_checkpoints(spark, {m: m for m in a.models})
        tied = [("lm_head.weight", "model.embed_tokens.weight")] if configs[0].get("tie_word_embeddings") else []
        if problems := tensors.key_problems(table).take(5) + tensors.tied_problems(table, tied).take(5):
            raise SystemExit(f"checkpoints don't fit: {problems}")
        mean = tensors.weighted_mean(table, weights)
        if problems := mean.filter("problem IS NOT NULL").select("key", "problem").take(5):
            raise SystemExit(f"checkpoints don't fit: {problems}")
        kept = F.when(F.col("dtype").isin(*tensors.AVERAGED), F.lit(a.dtype)).otherwise(F.col("dtype"))
        files.write_checkpoint(mean.select("key", "shape", kept.alias("dtype"), "values"), a.output, a.shard_mb * 1_000_000, {"weights": weights})
    elif a.command == "synth-template":
        made, bad = synthesis.make_templates(rows, ["_ord"]) if a.input else (spark.createDataFrame(synthesis.builtin_templates(), synthesis.TEMPLATE), spark.createDataFrame([], "id string, reason string"))
        files.write_jsonl(made, a.output)
        files.write_jsonl(bad, f"{a.output}.rejected")
    elif a.command == "synth-variants":
        templates = spark.read.schema(synthesis.TEMPLATE).json(a.input)
        files.write_jsonl(synthesis.variants(templates, a.variants, c["seed"]), a.output)
    elif a.command == "synth-check":
        checked = files.with_image_hashes(rows.withColumnRenamed("image_hash", "__claimed"), str(Path(a.input).resolve().parent), data=c["data"]).withColumnsRenamed({"image_hash": "actual_hash", "__claimed": "image_hash"})
        judged = synthesis.check_records(checked, ["_ord"])
        files.write_jsonl(judged.filter("reason IS NULL"), a.output, order)
        files.write_jsonl(judged.filter("reason IS NOT NULL").select("id", "reason"), f"{a.output}.errors")
    elif a.command == "synth-agent":
        seeds, left = synthesis.choose_seeds(rows, order, a.max_seeds)
        seeds = materialize(seeds.withColumn("html", F.col("gt")))
        audit = materialize(synthesis.run_agent(seeds, named(a.provider), named(a.review), a.variants, renderer=named(a.renderer) if a.renderer else None))
        files.write_jsonl(audit, a.output)
        files.write_jsonl(left, f"{a.output}.excluded")
        files.write_json(synthesis.agent_manifest(audit, a.variants, seeds.count()), f"{a.output}.manifest.json")
    elif a.command == "synth-render":
        templates = spark.read.schema(synthesis.TEMPLATE).json(a.input)
        made = materialize(synthesis.render_variants(synthesis.variants(templates, a.variants, c["seed"]), named(a.renderer)))
        files.write_jsonl(made, a.output)
        files.write_json(synthesis.render_manifest(made), f"{a.output}.manifest.json")
        Path(f"{a.output}.html").write_text(synthesis.gallery(made), encoding="utf-8")


if __name__ == "__main__":
    main()
