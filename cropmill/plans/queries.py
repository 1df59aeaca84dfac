"""Queries of the core engine. Each runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropmill import config
from cropmill.functions import grid, notation, ordering, text
from cropmill.operators import importing, inference, isolate, mine, pages, pairs, quota, report, score, synthesis, tensors, validate
from cropmill.plans import sql
from cropmill.plans.views import arrival, clean_samples
from cropmill.plans.views import tensors as tensor_table
from cropmill.sources.tables import materialize, table
from cropmill.streaming import ingest

Spark = SparkSession
CONFIG = config.load({"mixture": {"domain": {"private": 0.6, "general": 0.4}, "task": {"table": 0.4, "text": 0.35, "formula": 0.25}}})
ENDPOINTS = {r: {"base_url": "http://localhost/v1", "model": f"{r}-model", "revision": f"{r}-v1"} for r in ("base", "sft")}
WEIGHTS = {"m0": 1.0, "m1": 2.0, "m2": 3.0, "m3": 2.0}


def clean_labels(s: Spark, d: str) -> DataFrame:
    return clean_samples(s, d).select("id", "task", "domain", "source", "document_id", "split", "language", "pixel_hash", "parent_image_hash", "mining_bucket", "gt_trusted")


def normalize_samples(s: Spark, d: str) -> DataFrame:
    made = importing.normalize(clean_samples(s, d).drop("target", "score_gt"), CONFIG)
    return made.select("id", "task", "gt_format", "split", "conversion_status", "import_error", "target", "score_gt", "table_features")


def import_samples(s: Spark, d: str) -> DataFrame:
    return importing.import_rows(clean_samples(s, d).drop("target", "score_gt"), CONFIG, arrival()).select("id", "reason", "duplicate_of")


def field_mapping_defaults(s: Spark, d: str) -> DataFrame:
    rows = importing.map_fields(table(s, d, "source_docs"), {"id": "document_id", "document_id": "parent_document_id", "gt": "absent"})
    return rows.select("id", "document_id", F.coalesce("language", F.lit("unknown")).alias("language"))


def sft_adapter(s: Spark, d: str) -> DataFrame:
    return importing.adapt_sft(table(s, d, "sft_records")).select("raw_no", "task", "image", "gt", "gt_format", "sft_error")


def hash_split(s: Spark, d: str) -> DataFrame:
    return clean_samples(s, d).select("id", ordering.hash_split(42, F.col("source"), F.col("document_id"), 0.1).alias("new_split"))


def derived_ids(s: Spark, d: str) -> DataFrame:
    return clean_samples(s, d).select("id", F.substring(text.digest_list(F.col("pixel_hash"), F.col("task")), 1, 20).alias("derived"))


def forbidden_keys(s: Spark, d: str) -> DataFrame:
    return isolate.forbidden_keys(clean_samples(s, d))


def isolate_reasons(s: Spark, d: str) -> DataFrame:
    return isolate.isolate(clean_samples(s, d), arrival()).select("id", "reason", "duplicate_of")


def leak_filter(s: Spark, d: str) -> DataFrame:
    return isolate.isolate(clean_samples(s, d), arrival()).filter("reason = 'evaluation_overlap'").select("id")


def excluded_documents(s: Spark, d: str) -> DataFrame:
    """Leaks against an extra manifest: documents of the web harvest, each row held out."""
    manifest = table(s, d, "documents").filter(notation.label(F.col("source")) == "web_harvest").select(notation.document_id(F.col("document_id")).alias("document_id"))
    return isolate.isolate(clean_samples(s, d), arrival(), manifest).filter("reason = 'evaluation_overlap'").select("id")


def duplicate_ids(s: Spark, d: str) -> DataFrame:
    return validate.overlapping_ids(table(s, d, "samples"), "id", [F.col("ingested_at"), F.col("batch_no")]).select("id", "batch_no", "repeat")


def formula_forms(s: Spark, d: str) -> DataFrame:
    return clean_samples(s, d).filter("task = 'formula' AND gt IS NOT NULL").select("id", text.normalize_formula(F.col("gt")).alias("form"))


def text_forms(s: Spark, d: str) -> DataFrame:
    return clean_samples(s, d).filter("task = 'text' AND gt IS NOT NULL").select("id", text.normalize_text(F.col("gt")).alias("form"))


def score_samples(s: Spark, d: str) -> DataFrame:
    scored = score.score_rows(clean_samples(s, d), CONFIG)
    return scored.select("id", F.posexplode_outer("candidates").alias("at", "c")).filter("at IS NOT NULL").select("id", "at", F.col("c.id").alias("candidate_id"), "c.quality.score", "c.quality.status", "c.quality.metric", F.col("c.quality.exact").alias("exact"), "c.quality.cer", "c.quality.wer", "c.quality.teds_s")


def _plain(s: Spark, d: str) -> DataFrame:
    """Samples whose truth is text or a formula, which need no table codec."""
    return clean_samples(s, d).filter(F.col("task").isin("text", "formula"))


def score_ascii(s: Spark, d: str) -> DataFrame:
    """Qualities of text and formulas in ASCII, of which a byte is a character."""
    ascii_ = lambda c: c.rlike(r"^[\x00-\x7f]*\z")
    rows = _plain(s, d).filter(ascii_(F.col("gt"))).withColumn("candidates", F.filter(F.coalesce("candidates", F.array()), lambda c: F.coalesce(ascii_(c["text"]), F.lit(False))))
    scored = score.score_rows(rows, CONFIG).select("id", F.explode("candidates").alias("c"))
    return scored.select("id", F.col("c.id").alias("candidate_id"), "c.quality.score", "c.quality.status", "c.quality.exact", "c.quality.cer", "c.quality.wer")


def import_plain(s: Spark, d: str) -> DataFrame:
    """Import of text and formulas by themselves: errors, leaks, duplicates."""
    return importing.import_rows(_plain(s, d).drop("target", "score_gt"), CONFIG, arrival()).select("id", "reason", "duplicate_of")


def pairs_plain(s: Spark, d: str) -> DataFrame:
    """Pairs of text and formulas by themselves, and why there is none."""
    return pairs.make_pairs(_plain(s, d), CONFIG).select("id", "pair_reason", "pair_audit.chosen_id", "pair_audit.rejected_id", F.round("pair_audit.gap", 9).alias("gap"))


def mine_reasons(s: Spark, d: str) -> DataFrame:
    """How many samples mining chose, and how many it left for each reason."""
    chosen, left, _ = mine.mine_rows(clean_samples(s, d).drop("mining_bucket"), CONFIG, arrival())
    return chosen.select(F.lit("chosen").alias("reason")).unionByName(left.select("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def scored_signals(s: Spark, d: str) -> DataFrame:
    scored = score.score_rows(clean_samples(s, d), CONFIG).select("id", "signals.*")
    return scored.withColumns({c: F.col(f"{c}.score") for c in ("disagreement_forward", "disagreement_backward")})


def word_errors(s: Spark, d: str) -> DataFrame:
    rows = clean_samples(s, d).filter("task = 'text' AND gt IS NOT NULL").select("id", "gt", F.explode("candidates").alias("c")).filter("c.text IS NOT NULL")
    return rows.select("id", F.col("c.id").alias("candidate_id"), text.wer(text.normalize_text(F.col("c.text")), text.normalize_text(F.col("gt"))).alias("wer"))


def signals(s: Spark, d: str) -> DataFrame:
    rows = clean_samples(s, d).withColumn("candidates", F.coalesce("candidates", F.array()))
    return rows.select("id", score.signals("candidates", CONFIG, F.col("signals.disagreement")).alias("s")).select("id", "s.*")


def usable_candidates(s: Spark, d: str) -> DataFrame:
    return clean_samples(s, d).select("id", F.explode(F.filter("candidates", pairs.usable)).alias("c")).select("id", F.col("c.id").alias("candidate_id"))


def role_liveness(s: Spark, d: str) -> DataFrame:
    return inference.role_liveness(clean_samples(s, d))


def task_thresholds(s: Spark, d: str) -> DataFrame:
    return mine.task_thresholds(mine.eligible(clean_samples(s, d)), CONFIG)


def bucket_assign(s: Spark, d: str) -> DataFrame:
    return mine.assign_buckets(clean_samples(s, d), CONFIG).select("id", "mining_bucket")


def bucket_counts(s: Spark, d: str) -> DataFrame:
    return mine.assign_buckets(clean_samples(s, d), CONFIG).groupBy("mining_bucket").agg(F.count("*").alias("n"))


def apportion_budget(s: Spark, d: str) -> DataFrame:
    t = table(s, d, "mix_targets")
    return quota.apportion_table(t, 1000, "target_share", F.concat_ws("/", "domain", "task", "mining_bucket")).select("task", "domain", "mining_bucket", "quota")


def _stratified(s: Spark, d: str) -> tuple[DataFrame, DataFrame]:
    return quota.stratify(clean_samples(s, d).select("id", "task", "domain", "signals"), CONFIG["mining"]["budget"], CONFIG, quota.priority_order(CONFIG))


def stratify_quota(s: Spark, d: str) -> DataFrame:
    return _stratified(s, d)[0].select("id", F.col("__position").alias("position"))


def quota_report(s: Spark, d: str) -> DataFrame:
    return _stratified(s, d)[1]


def coverage_hash_order(s: Spark, d: str) -> DataFrame:
    return clean_samples(s, d).filter("mining_bucket = 'coverage'").select("id", ordering.hash_order(42, F.col("id")).alias("place"))


def mine_rows(s: Spark, d: str) -> DataFrame:
    return mine.mine_rows(clean_samples(s, d).drop("mining_bucket"), CONFIG, arrival())[0].select("id", "task", "domain", "mining_bucket", "mining_backfill", F.col("position.__stage").alias("stage"), F.col("position.__position").alias("position"), "signals.priority")


def mine_exclusions(s: Spark, d: str) -> DataFrame:
    return mine.mine_rows(clean_samples(s, d).drop("mining_bucket"), CONFIG, arrival())[1].select("id", "reason", "duplicate_of")


def make_pairs(s: Spark, d: str) -> DataFrame:
    return pairs.make_pairs(clean_samples(s, d), CONFIG).select("id", "pair_reason", "pair_audit.chosen_id", "pair_audit.rejected_id", "pair_audit.chosen_source", "pair_audit.gap", "pair_audit.pair_hash")


def build_pairs(s: Spark, d: str) -> DataFrame:
    return pairs.build_pairs(clean_samples(s, d), CONFIG, arrival())[0].select("position", "id", "pair.messages", "pair.images", "pair.rejected_response", "pair_audit.gap")


def pending_union(s: Spark, d: str) -> DataFrame:
    """Everything left aside, each reason once a stage: pairs not made or not selected, and SFT records that could not be read."""
    left = pairs.build_pairs(clean_samples(s, d), CONFIG, arrival())[1].select("id", "reason")
    broken = importing.adapt_sft(table(s, d, "sft_records")).filter("sft_error IS NOT NULL").select(F.col("raw_no").cast("string").alias("id"), F.concat(F.lit("import_error: "), "sft_error").alias("reason"))
    return left.unionByName(broken)


def dpo_validate(s: Spark, d: str) -> DataFrame:
    return validate.validate_pairs(table(s, d, "dpo_pairs"), [F.col("pair_no")]).select("pair_no", "problem")


def preflight_lengths(s: Spark, d: str) -> DataFrame:
    labels = lambda c: F.array_repeat(F.lit(1), F.coalesce(F.char_length(c), F.lit(0)))
    rows = table(s, d, "dpo_pairs").select("pair_no", labels(F.get("messages", F.lit(1))["content"]).alias("chosen"), labels(F.col("rejected_response")).alias("rejected"))
    return validate.preflight(rows, "chosen", "rejected", config.merge(CONFIG, {"training": {"max_length": 200}})).select("pair_no", "length", "verdict")


def audit_alignment(s: Spark, d: str) -> DataFrame:
    of_pairs = table(s, d, "dpo_pairs").select(F.col("sample_id").alias("id"), F.get("images", F.lit(0)).alias("image")).distinct()
    return validate.align(of_pairs, clean_samples(s, d).select("id", "image"), "id", "image")


def _requests(s: Spark, d: str) -> DataFrame:
    return inference.requests(clean_samples(s, d).withColumn("image_hash", F.col("pixel_hash")), CONFIG, ENDPOINTS)


def request_keys(s: Spark, d: str) -> DataFrame:
    return _requests(s, d).select("sample_id", "role", "kind", "index", "prompt", "seed", "id")


def cache_misses(s: Spark, d: str) -> DataFrame:
    """Requests that the answers already in the samples don't serve."""
    wanted = materialize(_requests(s, d))
    had = clean_samples(s, d).select(F.col("id").alias("sample_id"), F.explode("candidates").alias("c")).filter("c.kind = 'greedy'").select("sample_id", "c.role", "c.index", "c.status")
    cache = wanted.join(had, ["sample_id", "role", "index"]).select("id", "status")
    return inference.misses(wanted, cache).select("id", "role")


def otsl_tokens(s: Spark, d: str) -> DataFrame:
    rows = clean_samples(s, d).filter("task = 'table' AND gt IS NOT NULL")
    n = lambda t: F.regexp_count("gt", F.lit(t)).alias(t.strip("<>"))
    return rows.select("id", *map(n, (grid.FULL, grid.EMPTY, grid.LEFT, grid.UP, grid.CROSS, grid.NEWLINE)))


def grid_features(s: Spark, d: str) -> DataFrame:
    rows = clean_samples(s, d).filter("task = 'table' AND gt IS NOT NULL")
    return rows.select("id", grid.describe_column(F.col("gt")).alias("g")).select("id", "g.*")


def report_counts(s: Spark, d: str) -> DataFrame:
    return report.counts(clean_samples(s, d))


def report_bars(s: Spark, d: str) -> DataFrame:
    return report.top_bars(clean_samples(s, d), "document_id", F.struct(*arrival()))


def report_histogram(s: Spark, d: str) -> DataFrame:
    fields = ("base_score", "sft_score", "gt_error", "regression", "disagreement", "candidate_gap", "priority")
    return report.histogram(clean_samples(s, d), {**{f: F.col(f"signals.{f}") for f in fields}, "gt_length": F.coalesce(F.char_length("gt"), F.lit(0))})


def report_scatter(s: Spark, d: str) -> DataFrame:
    return report.scatter(clean_samples(s, d))


def report_pages(s: Spark, d: str) -> DataFrame:
    return report.pages(clean_samples(s, d).select("id", "ingested_at", "batch_no"), arrival(), CONFIG["report"]["page_size"]).select("id", "page")


def exclusion_reasons(s: Spark, d: str) -> DataFrame:
    return report.exclusion_reasons(isolate.rejected(isolate.isolate(clean_samples(s, d), arrival())))


def tensor_average(s: Spark, d: str) -> DataFrame:
    return tensors.weighted_mean(tensor_table(s, d), WEIGHTS).select("key", "values", "problem")


def tensor_keys(s: Spark, d: str) -> DataFrame:
    t = tensor_table(s, d).withColumn("dtype", F.when(F.col("label") % 7 == 0, "F16").otherwise(F.col("dtype")))
    return tensors.key_problems(t)


def buffers_equal(s: Spark, d: str) -> DataFrame:
    t = tensor_table(s, d).select("model", "key", F.array(F.lit(1)).alias("shape"), F.lit("I64").alias("dtype"), F.array(F.col("label").cast("float")).alias("values"))
    return tensors.weighted_mean(t, WEIGHTS).select("key", "problem")


def finite_check(s: Spark, d: str) -> DataFrame:
    return tensor_table(s, d).select("model", "key", tensors.finite(F.col("values")).alias("finite"))


def shard_packing(s: Spark, d: str) -> DataFrame:
    return tensors.shards(table(s, d, "supplier").select(F.col("s_name").alias("key"), F.floor(F.abs("s_acctbal")).alias("bytes")), 50_000)


def template_check(s: Spark, d: str) -> DataFrame:
    return synthesis.check_templates(s.createDataFrame(synthesis.builtin_templates(), synthesis.TEMPLATE))


def template_variants(s: Spark, d: str) -> DataFrame:
    return synthesis.variants(s.createDataFrame(synthesis.builtin_templates(), synthesis.TEMPLATE), 4)


def template_seeds(s: Spark, d: str) -> DataFrame:
    return synthesis.make_templates(clean_samples(s, d), arrival())[0].select("template_family_id", "seed_sample_id", "rows", "columns", "seed_html")


def seed_reasons(s: Spark, d: str) -> DataFrame:
    rows = clean_samples(s, d)
    return rows.select("id", synthesis.seed_reason(rows).alias("reason"))


def _page_inputs(s: Spark, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(s, d, "documents").select(F.col("doc_id").cast("string").alias("stem"), "text", "page_no")
    inputs = docs.filter("page_no IS NOT NULL").select("stem", pages.page_key("v1", F.sha2(F.coalesce("text", F.lit("")), 256)).alias("key"))
    done = docs.select("stem", pages.page_key("v1", F.sha2("text", 256)).alias("key"), F.lit("ok").alias("status"), F.col("text").alias("markdown"), F.sha2("text", 256).alias("markdown_hash"))
    return inputs, done


def page_resume(s: Spark, d: str) -> DataFrame:
    return pages.open_pages(*_page_inputs(s, d))


def stale_pages(s: Spark, d: str) -> DataFrame:
    return pages.stale_pages(*_page_inputs(s, d))


def latest_events(s: Spark, d: str) -> DataFrame:
    return ingest.latest(table(s, d, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


def windowed_events(s: Spark, d: str) -> DataFrame:
    return ingest.windowed_counts(table(s, d, "events")).withColumn("total", F.round("total", 4))


FLAGSHIP = mine_rows

_ALL = (
    clean_labels, normalize_samples, import_samples, field_mapping_defaults, sft_adapter, hash_split, derived_ids, forbidden_keys, isolate_reasons, leak_filter, excluded_documents,
    duplicate_ids, formula_forms, text_forms, score_samples, score_ascii, import_plain, pairs_plain, mine_reasons, scored_signals, word_errors, signals, usable_candidates, role_liveness, task_thresholds, bucket_assign, bucket_counts,
    apportion_budget, stratify_quota, quota_report, coverage_hash_order, mine_rows, mine_exclusions, make_pairs, build_pairs, pending_union, dpo_validate, preflight_lengths,
    audit_alignment, request_keys, cache_misses, otsl_tokens, grid_features, report_counts, report_bars, report_histogram, report_scatter, report_pages, exclusion_reasons,
    tensor_average, tensor_keys, buffers_equal, finite_check, shard_packing, template_check, template_variants, template_seeds, seed_reasons, page_resume, stale_pages,
    latest_events, windowed_events,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
