"""Scoring answers against the truth, and the signals of a sample."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropmill.functions import grid, text

QUALITY = f"struct<{','.join(x.replace(' ', ':', 1) for x in grid.QUALITY.split(', '))}>"
_FIELDS = [x.split() for x in grid.QUALITY.split(", ")]


def _quality(**values: Column) -> Column:
    return F.struct(*[(values[k] if k in values else F.lit(None)).cast(t).alias(k) for k, t in _FIELDS])


def _failure(status: str, error: Column | None = None) -> Column:
    return _quality(status=F.lit(status), **({"error": error} if error is not None else {}))


def finished(c: Column) -> Column:
    return F.coalesce((c["status"] == "ok") & c["finish_reason"].isin("stop", "eos"), F.lit(False))


def compare_text(x: Column, formula: bool) -> Column:
    """Quality of a comparison (p, g, d, w): normalised text, normalised truth, their edit distance and word error rate."""
    p, g, d = x["p"], x["g"], x["d"]
    ned = d / F.greatest(F.char_length(p), F.char_length(g), F.lit(1))
    values = {"score": 1 - ned, "ned": ned, "exact": p == g, "status": F.lit("ok")}
    values |= {"metric": F.lit("formula_edit_proxy"), "render_status": F.lit("not_checked")} if formula else {"metric": F.lit("text_ned"), "cer": d / F.char_length(g), "wer": x["w"]}
    return F.when(g == "", _quality(status=F.lit("invalid_gt"), error=F.lit("empty GT"))).otherwise(_quality(**values))


def _weighted(config: dict, parts: list[Column]) -> Column:
    """Weighted mean of the parts that are there, in a fixed order of summation; 0 without any."""
    total = weight = F.lit(0.0)
    for w, v in zip(config["mining"]["weights"], parts):
        total = total + F.when(v.isNotNull(), v * F.lit(float(w))).otherwise(F.lit(0.0))
        weight = weight + F.when(v.isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0))
    return F.when(weight != 0, total / weight).otherwise(F.lit(0.0))


def signals(candidates: str, config: dict, disagreement: Column) -> Column:
    """The signals of a row whose candidates carry their quality: scores of the first greedy answer of each model, and what follows."""
    greedy = lambda role: F.get(F.filter(candidates, lambda c: F.coalesce((c["role"] == role) & (c["kind"] == "greedy"), F.lit(False))), F.lit(0))["quality"]["score"]
    b, s = greedy("base"), greedy("sft")
    error, regression = 1 - s, F.when(b.isNotNull() & s.isNotNull(), F.greatest(b - s, F.lit(0.0)))
    scores = F.filter(F.transform(candidates, lambda c: c["quality"]["score"]), lambda x: x.isNotNull())
    gap = F.when(F.size(scores) > 0, F.array_max(scores) - F.array_min(scores)).otherwise(F.lit(0.0))
    return F.struct(b.alias("base_score"), s.alias("sft_score"), error.alias("gt_error"), regression.alias("regression"), disagreement.alias("disagreement"), gap.alias("candidate_gap"), _weighted(config, [error, regression, disagreement]).alias("priority"))


def _external(scorer: Callable[[str, str], float]):
    """An Arrow function (predictions, truths) -> scores by a metric outside; a failure is -1, equal comparisons of a batch are made once."""

    def run(preds: pd.Series, truths: pd.Series) -> pd.Series:
        known: dict = {}

        def one(p, g):
            if not g:
                return None
            if (p, g) not in known:
                try:
                    known[p, g] = float(scorer(p, g)) if p else 0.0
                except Exception:  # told as metric_error
                    known[p, g] = -1.0
            return known[p, g]

        return pd.Series([None if ps is None else [one(p, g) for p, g in zip(ps, gs)] for ps, gs in zip(preds, truths)])

    return F.pandas_udf(run, "array<double>")


def score_rows(rows: DataFrame, config: dict, formula_scorer: Callable[[str, str], float] | None = None) -> DataFrame:
    """The rows with a quality for every candidate, with signals, and with the metric_config they were made by.

    Answers that failed or were cut off are generation_error, answers without a truth missing_gt; both score null.
    Two finished greedy answers are also compared with each other, both ways, for the disagreement; the qualities of
    both ways are signals.disagreement_forward (sft against base) and disagreement_backward. Everything is
    computed within the row: text and formulas as expressions, tables in an Arrow UDF over the arrays of a row. With
    metrics.formula "cdm" formulas are scored by `formula_scorer` (prediction, truth) -> score, which is tried on a
    formula first; its failures are metric_error, empty predictions 0. Null
    candidate lists count as empty. Needs task, score_gt and candidates; any other column is kept.
    """
    external = config["metrics"]["formula"] == "cdm"
    if external and (formula_scorer is None or not formula_scorer("x+1", "x+1") >= 0.99):
        raise ValueError("metrics.formula cdm needs a formula_scorer that knows a formula from itself; fast is the edit proxy")
    fields = rows.schema["candidates"].dataType.elementType.fieldNames()
    rows = rows.withColumn("candidates", F.coalesce("candidates", F.array()))
    pick = lambda role: F.get(F.filter("candidates", lambda c: F.coalesce((c["role"] == role) & (c["kind"] == "greedy"), F.lit(False))), F.lit(0))
    rows = rows.withColumn("__base", pick("base")).withColumn("__sft", pick("sft"))
    both = finished(F.col("__base")) & finished(F.col("__sft"))
    table = F.col("task") == "table"
    body = lambda c: F.coalesce(c, F.lit(""))
    # Comparisons of a row: each candidate with the truth, then the two greedy answers with each other.
    preds = F.concat(F.transform("candidates", lambda c: body(c["text"])), F.array(body(F.col("__sft.text")), body(F.col("__base.text"))))
    truths = F.concat(F.transform("candidates", lambda _: body(F.col("score_gt"))), F.array(body(F.col("__base.text")), body(F.col("__sft.text"))))
    rows = rows.withColumn("__preds", preds).withColumn("__truths", truths)
    tables = grid.compare_table_arrays(F.when(table, F.col("__preds")), F.when(table, F.col("__truths")))
    # One pass of the normalising UDF over all strings of the row; the first half are predictions.
    every = text.nfc_array(F.when(~table, F.concat("__preds", "__truths")))
    plain = F.transform(every, lambda t: text.strip(F.replace(t, F.lit("\r\n"), F.lit("\n"))))
    rows = rows.withColumn("__tables", tables).withColumn("__plain", plain)
    rows = rows.withColumn("__plain", F.when(F.col("task") == "formula", F.transform("__plain", text.strip_delimiters)).otherwise(F.col("__plain")))
    n = F.size("__preds")
    words = [F.when(F.col("task") == "text", F.slice("__plain", *at)) for at in ((F.lit(1), n), (n + 1, n))]
    rows = rows.withColumn("__words", text.wer_array(*words))
    zipped = F.arrays_zip(F.slice("__plain", 1, n).alias("p"), F.slice("__plain", n + 1, n).alias("g"), F.coalesce("__words", F.array_repeat(F.lit(None).cast("double"), n)).alias("w"))
    pairs = F.transform(zipped, lambda x: F.struct(x["p"].alias("p"), x["g"].alias("g"), F.levenshtein(x["p"], x["g"]).alias("d"), x["w"].alias("w")))
    # Arrays are handed on whole, each used once: inside a lambda an array would be computed again for every element.
    texts = F.transform(pairs, lambda x: F.when(F.col("task") == "formula", compare_text(x, True)).otherwise(compare_text(x, False)))
    if external:
        formula = F.col("task") == "formula"
        halves = [F.when(formula, F.slice("__plain", 1, n)), F.when(formula, F.slice("__plain", n + 1, n))]
        rows = rows.withColumn("__outside", _external(formula_scorer)(*halves))
        judged = lambda q, x: F.when(q["status"] != "ok", q).when(x < 0, _failure("metric_error")).otherwise(q.withField("score", x).withField("metric", F.lit("cdm")).withField("render_status", F.lit("ok")))
        texts = F.when(formula, F.zip_with(texts, F.col("__outside"), judged)).otherwise(texts)
    rows = rows.withColumn("__scored", F.when(table, F.col("__tables").cast(f"array<{QUALITY}>")).otherwise(texts))
    own = [f for f in fields if f != "quality"]
    judge = lambda c, q: F.when(~finished(c), _failure("generation_error", F.coalesce(c["error"], c["finish_reason"]) if "error" in fields else c["finish_reason"])).when(F.col("score_gt").isNull(), _failure("missing_gt")).otherwise(q)
    rows = rows.withColumn("__forward", F.when(both, F.get(F.col("__scored"), n - 2))).withColumn("__backward", F.when(both, F.get(F.col("__scored"), n - 1)))
    rows = rows.withColumn("candidates", F.zip_with("candidates", F.slice("__scored", F.lit(1), F.size("candidates")), lambda c, q: F.struct(*[c[f].alias(f) for f in own], judge(c, q).alias("quality"))))
    apart = 1 - (F.col("__forward.score") + F.col("__backward.score")) / 2
    made = signals("candidates", config, apart).withField("disagreement_forward", F.col("__forward")).withField("disagreement_backward", F.col("__backward"))
    rows = rows.withColumn("signals", made).withColumn("metric_config", F.struct(*[F.lit(v).alias(k) for k, v in config["metrics"].items()]))
    return rows.drop("__base", "__sft", "__preds", "__truths", "__tables", "__plain", "__words", "__outside", "__scored", "__forward", "__backward")
