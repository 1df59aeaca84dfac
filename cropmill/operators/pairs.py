"""Preference pairs: a chosen and a rejected answer of one sample, and why a sample has none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropmill.functions import grid, text
from cropmill.operators import quota
from cropmill.operators.isolate import is_train, isolate, kept, rejected
from cropmill.operators.mine import trusted
from cropmill.sources.tables import materialize

#: Slack of the margin, so that a gap equal to it in decimal counts.
SLACK = 1e-10


def _has(df: DataFrame, field: str) -> bool:
    return field in df.schema["candidates"].dataType.elementType.fieldNames()


def usable(c: Column) -> Column:
    """A finished, scored answer."""
    ok = (c["status"] == "ok") & c["finish_reason"].isin("stop", "eos") & c["quality"]["score"].isNotNull() & c["quality"]["status"].isin("ok", "invalid_prediction")
    return F.coalesce(ok, F.lit(False))


def _by_task(config: dict, what: dict) -> Column:
    out = F.lit(None)
    for task, value in what.items():
        out = F.when(F.col("task") == task, F.lit(value)).otherwise(out)
    return out


def with_forms(rows: DataFrame) -> DataFrame:
    """Append the comparable form of the target and of each candidate: canonical table, or normalised text; raw where a table has none.

    Python runs on arrays of one column, once for tables and once for text beyond Latin-1; nothing is shuffled.
    """
    texts = F.transform(F.coalesce("candidates", F.array()), lambda c: F.coalesce(c["text"], F.lit("")))
    texts = F.concat(F.array(F.coalesce("target", F.lit(""))), texts)
    table = F.col("task") == "table"
    described = grid.describe_array(F.when(table, texts))
    plain = F.transform(text.nfc_array(F.when(~table, texts)), lambda t: text.strip(F.replace(t, F.lit("\r\n"), F.lit("\n"))))
    formula = F.transform(plain, text.strip_delimiters)
    rows = rows.withColumn("__texts", texts).withColumn("__tables", described).withColumn("__plain", F.when(F.col("task") == "formula", formula).otherwise(plain))
    # Zipped, so that each array is computed once a row and not once an element.
    empty = lambda c: F.coalesce(F.col(c), F.array())
    zipped = F.arrays_zip(F.col("__texts").alias("text"), empty("__tables").alias("t"), empty("__plain").alias("plain"))
    form = lambda x: F.struct(F.when(table, F.coalesce(x["t"]["canonical"], x["text"])).otherwise(x["plain"]).alias("form"), F.coalesce(x["t"]["is_otsl"], F.lit(False)).alias("is_otsl"))
    return rows.withColumn("__forms", F.transform(zipped, form)).drop("__texts", "__tables", "__plain")


def make_pairs(rows: DataFrame, config: dict) -> DataFrame:
    """All rows with pair, pair_audit and pair_reason; one of pair and pair_reason is null.

    Positive: the best usable answer above the task's quality (of tables, native OTSL only), else, by mode, the gt with
    score 1. Negative: among usable answers at least the margin below it and not equal in form, those of sft first,
    then the best. Ties go to the least candidate id. Null lists are empty lists. A column `training_image`, of rows
    or candidates, and a candidate's `prompt` are checked where present.
    """
    prompt = _by_task(config, config["prompts"])
    rows = with_forms(rows.drop(*[c for c in ("pair", "pair_audit", "pair_reason") if c in rows.columns]))
    image = F.coalesce(F.col("training_image"), F.col("image")) if "training_image" in rows.columns else F.col("image")
    fields = ["id", "role", "text"]
    flat = F.transform(
        F.coalesce("candidates", F.array()),
        lambda c, i: F.struct(
            *[c[f].alias(f) for f in fields], c["quality"]["score"].alias("score"), c["quality"]["status"].alias("q"), usable(c).alias("usable"),
            (c["prompt"] if _has(rows, "prompt") else F.lit(None).cast("string")).alias("prompt"), (c["training_image"] if _has(rows, "training_image") else F.lit(None).cast("string")).alias("training_image"),
            F.get(F.col("__forms"), i + 1)["form"].alias("form"), F.get(F.col("__forms"), i + 1)["is_otsl"].alias("is_otsl"),
        ),
    )
    rows = rows.withColumn("__flat", F.filter(flat, lambda c: c["usable"])).withColumn("__prompt", prompt).withColumn("__image", image).withColumn("__floor", _by_task(config, config["pairs"]["min_quality"]))
    other_role = lambda c: F.coalesce((c["role"] != "sft").cast("int"), F.lit(1))
    strip = lambda c: [c[k].alias(k) for k in ("role", "text", "score", "form")]
    valid = F.filter("__flat", lambda c: (c["q"] == "ok") & (c["score"] >= F.col("__floor")) & ((F.col("task") != "table") | c["is_otsl"]))
    best = F.array_min(F.transform(valid, lambda c: F.struct((-c["score"]).alias("a"), other_role(c).alias("b"), c["id"].alias("id"), *strip(c))))
    kind = "struct<id:string,role:string,text:string,score:double,form:string>"
    named = lambda c: F.struct(c["id"].alias("id"), *strip(c)).cast(kind)
    mode = config["pairs"]["mode"]
    model = F.when(best.isNotNull(), named(best)) if mode != "gt_pair" else F.lit(None).cast(kind)
    truth = F.struct(F.lit("gt").alias("id"), F.lit("gt").alias("role"), F.col("target").alias("text"), F.lit(1.0).alias("score"), F.get(F.col("__forms"), F.lit(0))["form"].alias("form")).cast(kind)
    rows = rows.withColumn("__pos", F.coalesce(model, truth) if mode in ("hybrid", "gt_pair") else model)
    worse = F.filter("__flat", lambda c: (F.col("__pos.score") - c["score"] >= config["pairs"]["margin"] - SLACK) & (c["form"] != F.col("__pos.form")))
    rows = rows.withColumn("__neg", F.array_min(F.transform(worse, lambda c: F.struct(other_role(c).alias("a"), (-c["score"]).alias("b"), c["id"].alias("id"), *strip(c)))))
    reason = (
        F.when(~is_train(rows), "held_out")
        .when(F.col("target").isNull(), "missing_gt")
        .when(~trusted(), "untrusted_gt")
        .when(F.size("__flat") == 0, "no_scored_candidates")
        .when(F.exists("__flat", lambda c: F.coalesce(c["prompt"] != F.col("__prompt"), F.lit(False))), "prompt_mismatch")
        .when(F.exists("__flat", lambda c: F.coalesce(c["training_image"] != F.col("__image"), F.lit(False))), "image_mismatch")
        .when(F.col("__pos").isNull(), "no_reliable_model_positive")
        .when(F.col("__neg").isNull(), "no_meaningful_preference_gap")
    )
    rows = rows.withColumn("pair_reason", reason)
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    pair = F.struct(F.array(message("user", F.concat(F.lit("<image>"), F.col("__prompt"))), message("assistant", F.col("__pos.text"))).alias("messages"), F.array("__image").alias("images"), F.col("__neg.text").alias("rejected_response"))
    rows = rows.withColumn("pair", F.when(F.col("pair_reason").isNull(), pair))
    column = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    audit = F.struct(
        F.col("id").alias("sample_id"), F.col("__pos.id").alias("chosen_id"), F.col("__neg.id").alias("rejected_id"), F.col("__pos.role").alias("chosen_source"), F.col("__neg.role").alias("rejected_source"),
        F.col("__pos.score").alias("chosen_score"), F.col("__neg.score").alias("rejected_score"), (F.col("__pos.score") - F.col("__neg.score")).alias("gap"), F.lit(mode).alias("mode"), pair_digest(F.col("pair")).alias("pair_hash"),
        *[column(c).alias(c) for c in ("source", "document_id", "task", "domain", "mining_bucket")],
    )
    rows = rows.withColumn("pair_audit", F.when(F.col("pair_reason").isNull(), audit))
    return rows.drop("__forms", "__flat", "__prompt", "__image", "__floor", "__pos", "__neg")


def pair_digest(pair: Column) -> Column:
    """The digest of a pair: SHA-256 of its canonical JSON."""
    messages = F.transform(pair["messages"], lambda m: F.concat(F.lit('{"content": '), text.json_string(m["content"]), F.lit(', "role": '), text.json_string(m["role"]), F.lit("}")))
    images = F.transform(pair["images"], text.json_string)
    whole = F.concat(F.lit('{"images": ['), F.array_join(images, ", "), F.lit('], "messages": ['), F.array_join(messages, ", "), F.lit('], "rejected_response": '), text.json_string(pair["rejected_response"]), F.lit("}"))
    return F.sha2(whole, 256)


def build_pairs(rows: DataFrame, config: dict, order: list[Column]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(selected with `position`, pending with reason, report by category): isolate, pair, select by quota.

    Buckets take part in the quotas when every pair has one.
    """
    isolated = isolate(rows, order)
    made = materialize(make_pairs(kept(isolated), config))
    available = made.filter(F.col("pair_reason").isNull())
    bucketed = "mining_bucket" in rows.columns and bool(available.agg(F.coalesce(F.bool_and(F.col("mining_bucket").isNotNull()), F.lit(False))).first()[0])
    selected, report = quota.stratify(available, config["mining"]["budget"], config, quota.priority_order(config, bucketed), bucketed)
    selected = materialize(selected.withColumnRenamed("__position", "position").drop("pair_reason"))
    slim = lambda df, reason: df.withColumn("reason", reason).drop("pair", "pair_audit", "pair_reason").withColumn("duplicate_of", F.lit(None).cast("string"))
    failed = slim(made.filter(F.col("pair_reason").isNotNull()), F.col("pair_reason"))
    over = slim(available.join(selected.select("id"), "id", "left_anti"), F.lit("pair_quota_budget"))
    return selected, rejected(isolated).unionByName(failed).unionByName(over), report
