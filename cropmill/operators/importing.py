"""Import: mapping raw records to samples, with every rejection told."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropmill.config import SPLITS, TASKS
from cropmill.functions import grid, text
from cropmill.functions.ordering import hash_split
from cropmill.operators import skew
from cropmill.operators.isolate import identities, isolate
from cropmill.sources.tables import materialize

#: The prompts of SFT records and the task each stands for.
PROMPT_TASK = {"OCR:": "text", "Table Recognition:": "table", "Formula Recognition:": "formula"}
#: Columns whose content as it came is kept in raw_annotation.
RAW = ("gt", "gt_format", "html", "otsl", "text", "latex")
#: Columns that may hold a truth, by task, in order of precedence after `gt`.
ANNOTATIONS = {"table": ("otsl", "html"), "text": ("text",), "formula": ("latex",)}


def first_error(*checks: tuple[Column, str]) -> Column:
    """The message of the first check that holds; a null check doesn't."""
    out = F.lit(None).cast("string")
    for check, message in reversed(checks):
        out = F.when(F.coalesce(check, F.lit(False)), F.lit(message)).otherwise(out)
    return out


def map_fields(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """{target: source}: copy columns under the names the importer knows, null values included; absent sources change nothing."""
    return rows.withColumns({target: F.col(source) for target, source in fields.items() if source in rows.columns})


def sft_task(prompt: Column) -> Column:
    out = F.lit(None).cast("string")
    for words, task in PROMPT_TASK.items():
        out = F.when(text.strip(prompt) == words, task).otherwise(out)
    return out


def adapt_sft(rows: DataFrame) -> DataFrame:
    """SFT records (image_info, text_info) as samples: task, image, gt, gt_format, and sft_error where a record isn't one crop with one question and answer.

    A null list, a null entry and a blank answer are errors, told by the first that holds. Explicit task, image, gt or
    gt_format columns must agree where they are not null.
    """
    images, texts = F.col("image_info"), F.col("text_info")
    query, answer = F.get(texts, F.lit(0)), F.get(texts, F.lit(1))
    image = F.get(images, F.lit(0))
    task = sft_task(query["text"])
    html = F.ltrim(answer["text"], F.lit(" \t\n\r\x0b\x0c")).startswith("<table")
    fmt = F.when(task == "table", F.when(html, "html").otherwise("otsl")).when(task == "formula", "latex").when(task == "text", "text")
    new = {"task": task, "image": image["image_url"], "gt": answer["text"], "gt_format": fmt}
    clash = F.lit(False)
    for name, value in new.items():
        if name in rows.columns:
            clash = clash | F.coalesce(F.col(name) != value, F.lit(False))
    error = first_error(
        (images.isNull() | texts.isNull() | (F.size(images) != 1) | (F.size(texts) != 2), "one image and one question with its answer required"),
        (image.isNull() | query.isNull() | answer.isNull(), "invalid entries"),
        (~F.coalesce((query["tag"] == "mask") & (answer["tag"] == "no_mask"), F.lit(False)), "mask question, then no_mask answer required"),
        (F.coalesce(image["matched_text_index"], F.lit(0)) != 0, "image must belong to the question"),
        (task.isNull(), "unsupported prompt"),
        (F.coalesce(text.strip(answer["text"]), F.lit("")) == "", "blank answer"),
        (F.coalesce(image["image_url"], F.lit("")) == "", "no image"),
        (clash, "conflict with explicit annotation"),
    )
    return rows.withColumns({name: F.when(error.isNull(), value) for name, value in new.items()} | {"sft_prompt": query["text"], "sft_error": error})


def truth(rows: DataFrame) -> tuple[Column, Column]:
    """(gt, gt_format) by precedence: gt, else the first annotation of the task that is there."""
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    gt, fmt = have("gt"), have("gt_format")
    for task, names in ANNOTATIONS.items():
        other, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
        for name in reversed(names):
            there = have(name).isNotNull()
            other, kind = F.when(there, have(name)).otherwise(other), F.when(there, F.lit(name)).otherwise(kind)
        use = have("gt").isNull() & (F.col("task") == task) & other.isNotNull()
        gt, fmt = F.when(use, other).otherwise(gt), F.when(use, kind).otherwise(fmt)
    return gt, fmt


def normalize(rows: DataFrame, config: dict) -> DataFrame:
    """Samples with defaults, target, score_gt, conversion_status, raw_annotation (JSON of the annotations as they came), table features and import_error.

    Defaults fill columns that are absent; a null in a column that is there stays, but for ids, whose null becomes the
    digest of [pixel_hash, task], and splits, whose null means train. Where no split column is there, eval_fraction > 0
    draws one by document. A null gt is missing_gt, a blank one an error; tables must parse, and agree with `html` and
    `otsl` where given. Rows are only projected; the table codec runs on the column of tables.
    """
    given = set(rows.columns)
    rows = map_fields(rows, config["fields"])
    default = lambda c, v: F.col(c) if c in rows.columns else v
    ident = F.substring(text.digest_list(F.col("pixel_hash"), F.col("task")), 1, 20) if "pixel_hash" in rows.columns else F.substring(text.digest_list(F.col("image"), F.col("task")), 1, 20)
    rows = rows.withColumn("id", F.coalesce(F.col("id").cast("string"), ident) if "id" in rows.columns else ident)
    rows = rows.withColumn("source", default("source", F.lit("user"))).withColumn("domain", default("domain", F.lit("private")))
    parent = F.col("parent_document_id") if "parent_document_id" in rows.columns else F.lit(None).cast("string")
    rows = rows.withColumn("document_id", default("document_id", F.coalesce(parent, F.col("id"))).cast("string"))
    fraction = config["data"]["eval_fraction"]
    if fraction and "split" not in given:
        rows = rows.withColumn("split", hash_split(config["seed"], F.col("source"), F.col("document_id"), fraction))
    rows = rows.withColumn("split", F.coalesce(F.col("split"), F.lit("train")) if "split" in rows.columns else F.lit("train"))
    raw = [c for c in RAW if c in rows.columns]
    rows = rows.withColumn("raw_annotation", F.to_json(F.struct(*raw)) if raw else F.lit("{}"))
    gt, fmt = truth(rows)
    rows = rows.withColumns({"gt": gt, "gt_format": fmt, "gt_trusted": F.coalesce(default("gt_trusted", F.lit(True)), F.lit(False))})
    table = F.col("task") == "table"
    rows = rows.withColumn("__grid", grid.describe_column(F.when(table, F.col("gt"))))
    conflict = F.lit(False)
    for name in ("html", "otsl"):
        if name in rows.columns:
            other = grid.describe_column(F.when(table & F.col("gt").isNotNull(), F.col(name)))
            rows = rows.withColumn(f"__{name}", other)
            conflict = conflict | (table & F.col(name).isNotNull() & ~F.col(f"__{name}.canonical").eqNullSafe(F.col("__grid.canonical")))
    expected = F.when(F.col("task") == "formula", "latex").otherwise("text")
    domains = config["mixture"].get("domain")
    error = first_error(
        (~F.coalesce(F.col("task").isin(*TASKS), F.lit(False)), "task must be table, text or formula"),
        (~F.col("domain").isin(*domains) if domains else F.lit(False), "domain outside the mixture"),
        (~F.col("split").isin(*SPLITS), "unsupported split"),
        (F.col("gt").isNotNull() & (text.strip(F.col("gt")) == ""), "blank gt"),
        (F.col("gt").isNotNull() & table & ~F.coalesce(F.col("gt_format").isin("otsl", "html"), F.lit(False)), "a table's gt_format must be html or otsl"),
        (table & F.col("__grid.error").isNotNull(), "table has no grid"),
        (conflict, "annotations conflict"),
        (F.col("gt").isNotNull() & ~table & (F.col("gt_format") != expected), "gt_format doesn't fit the task"),
    )
    ok = error.isNull() & F.col("gt").isNotNull()
    rows = rows.withColumns({
        "import_error": error,
        "conversion_status": F.when(error.isNull(), F.when(F.col("gt").isNull(), "missing_gt").otherwise("ok")),
        "target": F.when(ok, F.when(table, F.col("__grid.otsl")).otherwise(F.col("gt"))),
        "score_gt": F.when(ok, F.when(table, F.col("__grid.canonical")).otherwise(F.col("gt"))),
        "gt_format": F.when(ok & ~table, expected).otherwise(F.col("gt_format")),
        "table_features": F.when(ok & table, F.struct(*[F.col(f"__grid.{k}").alias(k) for k in ("rows", "columns", "cells", "merged_cells")])),
    })
    return rows.drop("__grid", "__html", "__otsl")


def import_rows(rows: DataFrame, config: dict, order: list[Column], excluded: DataFrame | None = None) -> DataFrame:
    """All rows, normalised, with `reason` where they don't come into the data: import_error: ..., or as isolate says.

    Of rows with one id the first that could be normalised has it; a row with an sft_error or image_error couldn't. Held-out
    rows protect the evaluation even where their own annotation is invalid, as do the rows of `excluded` (every row of
    them). Ids are aggregated to their first row; only those that repeat are joined back.
    """
    made = normalize(rows, config)
    unread = [F.col(c) for c in ("sft_error", "image_error") if c in made.columns]
    made = materialize(made.withColumn("import_error", F.coalesce(*unread, F.col("import_error"))))  # tables are parsed once
    place = F.struct(F.xxhash64(*order).alias("a"), F.xxhash64(F.lit(1), *order).alias("b"))
    slim = made.filter("import_error IS NULL").select(F.col("id").alias("__id"), F.struct(*order).alias("__order"), place.alias("__at"))
    repeated = materialize(slim.groupBy("__id").agg(F.min(F.struct("__order", "__at"))["__at"].alias("__first"), F.count("*").alias("n")).filter("n > 1"))
    if not repeated.isEmpty():
        again = skew.spread(slim, repeated.select("__id", "__first"), "__id", skew.hot_keys(repeated), ["__at"]).filter(F.col("__at") != F.col("__first")).select("__at", F.lit("duplicate id").alias("__again"))
        made = made.withColumn("__at", place).join(again, "__at", "left").withColumn("import_error", F.coalesce("import_error", "__again")).drop("__at", "__again")
    held = made.filter(F.col("split") != "train")
    guards = held if excluded is None else identities(held).unionByName(identities(excluded), allowMissingColumns=True)
    good = isolate(made.filter(F.col("import_error").isNull()).drop("import_error"), order, guards)
    bad = made.filter(F.col("import_error").isNotNull()).withColumn("reason", F.concat(F.lit("import_error: "), "import_error")).withColumn("duplicate_of", F.lit(None).cast("string")).drop("import_error")
    return good.unionByName(bad)
