"""DuckDB SQL for the core queries that SQL can express on whole tables."""

from __future__ import annotations

from cropmill.functions.notation import PLACEHOLDERS

_NONE = "(" + ", ".join(f"'{p}'" for p in PLACEHOLDERS) + ")"


def _plain(c: str) -> str:
    return rf"lower(trim({c}, e' \t\n\r'))"


def _known(x: str) -> str:
    return f"CASE WHEN {x} NOT IN {_NONE} THEN {x} END"


def _label(c: str) -> str:
    return _known(f"translate({_plain(c)}, '- ', '__')")


def _doc(c: str) -> str:
    return _known(f"translate({_plain(c)}, '_ ', '--')")


def _hash(c: str) -> str:
    """The digest is the 64 hex digits, whatever stands around them."""
    return f"nullif(nullif(regexp_extract(lower({c}), '[0-9a-f]{{64}}'), ''), repeat('0', 64))"


_SIGNALS = ("base_score", "sft_score", "gt_error", "regression", "disagreement", "candidate_gap", "priority")
_MEASURED = ", ".join(f"{s} := CASE WHEN NOT isnan(signals.{s}) THEN signals.{s} END" for s in _SIGNALS)
#: The view clean_samples, as S.
S = f"""
WITH RECURSIVE R AS (
  SELECT {_plain("id")} AS id, image, {_label("task")} AS task, {_label("domain")} AS domain, {_label("source")} AS source, {_doc("document_id")} AS document_id,
    coalesce(CASE WHEN {_label("split")} = 'validation' THEN 'val' ELSE {_label("split")} END, 'train') AS split, {_label("language")} AS language, gt, {_label("gt_format")} AS gt_format, gt_trusted,
    {_hash("pixel_hash")} AS pixel_hash, {_hash("parent_image_hash")} AS parent_image_hash, {_label("mining_bucket")} AS mining_bucket, struct_pack({_MEASURED}) AS sig, candidates, ingested_at, batch_no
  FROM samples),
S AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at, batch_no) AS rn FROM R) WHERE rn = 1)"""

_KEYS = """
K AS (
  SELECT id, 'document' AS kind, document_id AS value FROM S WHERE document_id <> ''
  UNION SELECT id, 'hash', pixel_hash FROM S WHERE pixel_hash <> ''
  UNION SELECT id, 'hash', parent_image_hash FROM S WHERE parent_image_hash <> ''),
F AS (SELECT DISTINCT kind, value FROM K JOIN S USING (id) WHERE split <> 'train'),
L AS (SELECT DISTINCT id FROM K JOIN S USING (id) WHERE split = 'train' AND (kind, value) IN (SELECT (kind, value) FROM F))"""

_ISOLATED = f"""{_KEYS},
G AS (
  SELECT *, row_number() OVER w AS rn, first_value(id) OVER w AS fid, first_value(gt) OVER w AS fgt, first_value(task) OVER w AS ftask
  FROM S WHERE id NOT IN (SELECT id FROM L) WINDOW w AS (PARTITION BY pixel_hash ORDER BY ingested_at, batch_no, id)),
H AS (SELECT *, gt IS DISTINCT FROM fgt OR task IS DISTINCT FROM ftask AS differs FROM G),
I AS (
  SELECT id, CASE WHEN rn > 1 AND differs THEN 'duplicate_conflicting_gt' WHEN rn > 1 THEN 'duplicate_image' WHEN bool_or(differs) OVER (PARTITION BY pixel_hash) THEN 'duplicate_conflicting_gt' END AS reason,
    CASE WHEN rn > 1 THEN fid END AS duplicate_of FROM H
  UNION ALL SELECT id, 'evaluation_overlap', NULL FROM L)"""

_TRUSTED = "coalesce(gt_trusted, true)"
_ELIGIBLE = f"E AS (SELECT * FROM S WHERE split = 'train' AND gt IS NOT NULL AND {_TRUSTED})"
_THRESHOLDS = f"""{_ELIGIBLE},
V AS (SELECT task, sig.gt_error AS e, row_number() OVER (PARTITION BY task ORDER BY sig.gt_error) - 1 AS i, count(*) OVER (PARTITION BY task) AS n FROM E WHERE sig.gt_error IS NOT NULL),
Q AS (SELECT task, q, (n - 1) * q AS p, min(e) FILTER (i = floor((n - 1) * q)) AS lo, min(e) FILTER (i = ceil((n - 1) * q)) AS hi FROM V CROSS JOIN (VALUES (0.2::DOUBLE), (0.8::DOUBLE)) AS x(q) GROUP BY task, q, n),
T AS (SELECT t.task, coalesce(max(lo + (hi - lo) * (p - floor(p))) FILTER (q = 0.2::DOUBLE), 0.0::DOUBLE) AS low, coalesce(max(lo + (hi - lo) * (p - floor(p))) FILTER (q = 0.8::DOUBLE), 0.0::DOUBLE) AS high
  FROM (VALUES ('table'), ('text'), ('formula')) AS t(task) LEFT JOIN Q ON Q.task = t.task GROUP BY t.task)"""
_BUCKETS = f"""{_THRESHOLDS},
B AS (SELECT E.id, CASE WHEN coalesce(sig.regression, 0) >= 0.05 THEN 'regression' WHEN sig.gt_error BETWEEN low AND high AND coalesce(sig.candidate_gap, 0) >= 0.05 THEN 'learnable' ELSE 'coverage' END AS mining_bucket
  FROM E JOIN T USING (task) WHERE sig.sft_score IS NOT NULL)"""

_QUOTAS = """
D AS (SELECT d || '/' || t AS category, dv * tv AS share FROM (VALUES ('private', 0.6::DOUBLE), ('general', 0.4::DOUBLE)) AS a(d, dv) CROSS JOIN (VALUES ('table', 0.4::DOUBLE), ('text', 0.35::DOUBLE), ('formula', 0.25::DOUBLE)) AS b(t, tv)),
X AS (SELECT category, 1000 * share / sum(share) OVER () AS exact FROM D),
Y AS (SELECT category, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, category) <= 1000 - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS desired FROM X),
N AS (SELECT id, concat_ws('/', domain, task) AS category, -coalesce(sig.priority, 0) AS a FROM S),
P AS (SELECT id, N.category, a, desired, row_number() OVER (PARTITION BY N.category ORDER BY a, id) AS rn FROM N LEFT JOIN Y USING (category)),
Z AS (SELECT id, category, rn <= coalesce(desired, 0) AS inside, row_number() OVER (ORDER BY (rn <= coalesce(desired, 0)) DESC, a, id) AS position FROM P)"""

_STRIP = "'" + "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "'"


def _strip(x: str) -> str:
    return f"trim({x}, {_STRIP})"


_TEXT = _strip(r"replace(nfc_normalize(gt), e'\r\n', e'\n')")
_FORMULA = f"""CASE WHEN starts_with(t, '$$') AND ends_with(t, '$$') THEN {_strip("substring(t, 3, greatest(length(t) - 4, 0))")}
  WHEN starts_with(t, '\\[') AND ends_with(t, '\\]') THEN {_strip("substring(t, 3, greatest(length(t) - 4, 0))")}
  WHEN starts_with(t, '\\(') AND ends_with(t, '\\)') THEN {_strip("substring(t, 3, greatest(length(t) - 4, 0))")}
  WHEN starts_with(t, '$') AND ends_with(t, '$') THEN {_strip("substring(t, 2, greatest(length(t) - 2, 0))")} ELSE t END"""



def _form(x: str) -> str:
    """The comparable form of a text or formula of the row."""
    text = _strip(rf"replace(nfc_normalize({x}), e'\r\n', e'\n')")
    formula = f"list_transform([{text}], lambda t: {_FORMULA})[1]"
    return f"CASE WHEN task = 'formula' THEN {formula} ELSE {text} END"


_SPACE = f"[{''.join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))}]+"


def _wer(p: str, g: str) -> str:
    """Word error rate: words become single bytes, by their place among the words of both texts."""
    p, g = (f"list_filter(string_split_regex({x}, '{_SPACE}'), lambda x: x <> '')" for x in (p, g))
    code = lambda w: f"coalesce(array_to_string(list_transform({w}, lambda x: chr(list_position(list_distinct(list_concat({p}, {g})), x)::INT)), ''), '')"
    return f"levenshtein({code(p)}, {code(g)}) / len({g})"


_GREEDY = "list_filter(coalesce(candidates, []), lambda c: coalesce(c.role = '{}' AND c.kind = 'greedy', false))[1].quality.score"
_USABLE = "coalesce(c.status = 'ok' AND c.finish_reason IN ('stop', 'eos') AND c.quality.score IS NOT NULL AND c.quality.status IN ('ok', 'invalid_prediction'), false)"
_PROMPT = "CASE task WHEN 'table' THEN 'Table Recognition:' WHEN 'text' THEN 'OCR:' WHEN 'formula' THEN 'Formula Recognition:' END"
_REQUESTS = f"""
J AS (SELECT S.id AS sample_id, role, 'greedy' AS kind, 0 AS index, {_PROMPT} AS prompt, 42 AS seed, pixel_hash FROM S CROSS JOIN (VALUES ('base'), ('sft')) AS r(role)),
M AS (SELECT *, sha256('{{"endpoint": "http://localhost/v1", "extra_body": {{}}, "image": ' || coalesce('"' || pixel_hash || '"', 'null') || ', "index": 0, "kind": "greedy", "model": "' || role || '-model", "params": {{"max_tokens": 4096, "seed": 42, "temperature": 0, "top_p": 1.0}}, "preprocess": {{"max_side": null, "mode": "rgb"}}, "prompt": ' || coalesce('"' || prompt || '"', 'null') || ', "revision": "' || role || '-v1"}}') AS id FROM J)"""
_ERROR = f"""CASE WHEN domain NOT IN ('private', 'general') THEN 'domain outside the mixture' WHEN split NOT IN ('train', 'eval', 'val', 'test') THEN 'unsupported split'
  WHEN gt IS NOT NULL AND {_strip("gt")} = '' THEN 'blank gt' WHEN gt IS NOT NULL AND gt_format <> CASE task WHEN 'formula' THEN 'latex' ELSE 'text' END THEN 'gt_format doesn''t fit the task' END"""
_IMPORT = f"""
P AS (SELECT *, {_ERROR} AS error FROM S WHERE task IN ('text', 'formula')),
K AS (
  SELECT id, split, error, 'document' AS kind, coalesce(document_id, '') AS value FROM P WHERE document_id <> ''
  UNION SELECT id, split, error, 'hash', pixel_hash FROM P WHERE pixel_hash <> ''
  UNION SELECT id, split, error, 'hash', parent_image_hash FROM P WHERE parent_image_hash <> ''),
F AS (SELECT DISTINCT kind, value FROM K WHERE split <> 'train'),
L AS (SELECT DISTINCT id FROM K WHERE split = 'train' AND error IS NULL AND (kind, value) IN (SELECT (kind, value) FROM F)),
G AS (
  SELECT *, row_number() OVER w AS rn, first_value(id) OVER w AS fid, first_value(gt) OVER w AS fgt, first_value(task) OVER w AS ftask
  FROM P WHERE error IS NULL AND id NOT IN (SELECT id FROM L) WINDOW w AS (PARTITION BY pixel_hash ORDER BY ingested_at, batch_no, id)),
H AS (SELECT *, gt IS DISTINCT FROM fgt OR task IS DISTINCT FROM ftask AS differs FROM G)
SELECT id, CASE WHEN rn > 1 AND differs THEN 'duplicate_conflicting_gt' WHEN rn > 1 THEN 'duplicate_image' WHEN bool_or(differs) OVER (PARTITION BY pixel_hash) THEN 'duplicate_conflicting_gt' END AS reason,
  CASE WHEN rn > 1 THEN fid END AS duplicate_of FROM H
UNION ALL SELECT id, 'evaluation_overlap', NULL FROM L UNION ALL SELECT id, 'import_error: ' || error, NULL FROM P WHERE error IS NOT NULL"""
_PAIRS = f"""
P AS (SELECT * FROM S WHERE task IN ('text', 'formula')),
U AS (SELECT id, task, gt, unnest(candidates) AS c FROM P),
V AS (SELECT id, task, c.id AS cid, c.quality.score AS score, (coalesce(c.role, '') <> 'sft')::INT AS other, {_form("c.text")} AS form, c.quality.status = 'ok' AND c.quality.score >= CASE task WHEN 'text' THEN 0.95 ELSE 0.9 END AS good FROM U WHERE {_USABLE}),
B AS (SELECT id, cid, score, form FROM V WHERE good QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, other, cid) = 1),
C AS (SELECT P.id, coalesce(cid, 'gt') AS cid, coalesce(score, 1.0::DOUBLE) AS score, CASE WHEN cid IS NULL THEN {_form("gt")} ELSE form END AS form FROM P LEFT JOIN B USING (id)),
N AS (SELECT V.id, V.cid, V.score, C.score - V.score AS gap FROM V JOIN C USING (id) WHERE C.score - V.score >= 0.05 - 1e-10 AND V.form <> C.form QUALIFY row_number() OVER (PARTITION BY V.id ORDER BY other, V.score DESC, V.cid) = 1),
Z AS (SELECT P.id, CASE WHEN split <> 'train' THEN 'held_out' WHEN gt IS NULL THEN 'missing_gt' WHEN NOT {_TRUSTED} THEN 'untrusted_gt' WHEN P.id NOT IN (SELECT id FROM V) THEN 'no_scored_candidates' WHEN N.id IS NULL THEN 'no_meaningful_preference_gap' END AS pair_reason,
  C.cid AS chosen, N.cid AS rejected, gap FROM P LEFT JOIN C USING (id) LEFT JOIN N USING (id))
SELECT id, pair_reason, CASE WHEN pair_reason IS NULL THEN chosen END AS chosen_id, CASE WHEN pair_reason IS NULL THEN rejected END AS rejected_id, CASE WHEN pair_reason IS NULL THEN round(gap, 9) END AS gap FROM Z"""
_TENSORS = "WITH T AS (SELECT 'm' || (vec_id % 4) AS model, lpad((vec_id // 4)::VARCHAR, 9, '0') AS key, embedding AS v, label FROM embeddings)"
_WIDE = f"{_TENSORS}, G AS (SELECT key, count(*) AS n, {', '.join(f'any_value(v) FILTER (model = {chr(39)}m{i}{chr(39)}) AS v{i}' for i in range(4))} FROM T GROUP BY key)"
_MEAN = "CASE WHEN n = 4 THEN list_transform(range(1, len(v0) + 1), lambda i: (((0.0::FLOAT + v0[i] * 0.125::FLOAT)::FLOAT + v1[i] * 0.25::FLOAT)::FLOAT + v2[i] * 0.375::FLOAT)::FLOAT + v3[i] * 0.25::FLOAT) END"


def _one(items: str) -> str:
    return f"coalesce('\"' || {items} || '\"', 'null')"


def _histogram() -> str:
    each = " UNION ALL ".join([f"SELECT '{s}' AS field, sig.{s} AS v FROM S" for s in _SIGNALS] + ["SELECT 'gt_length', coalesce(length(gt), 0) FROM S"])
    return f"""{S},
A AS (SELECT field, v::DOUBLE AS v FROM ({each}) WHERE v IS NOT NULL AND isfinite(v::DOUBLE)),
M AS (SELECT field, CASE WHEN max(v) = 0 THEN 1.0::DOUBLE ELSE max(v) END AS hi FROM A GROUP BY field),
C AS (SELECT field, least(9, greatest(0, trunc(v / hi * 10)::INT)) AS bin, count(*) AS n FROM A JOIN M USING (field) GROUP BY ALL)
SELECT m.field, r.b::INT AS bin, coalesce(c.n, 0) AS n FROM M m CROSS JOIN range(10) AS r(b) LEFT JOIN C c ON c.field = m.field AND c.bin = r.b"""


def oracle_sql() -> dict[str, str]:
    q = "text_info[1]"
    a = "text_info[2]"
    prompt = f"CASE {_strip(q + '.text')} WHEN 'OCR:' THEN 'text' WHEN 'Table Recognition:' THEN 'table' WHEN 'Formula Recognition:' THEN 'formula' END"
    answers = f"{S}, A AS (SELECT id, unnest(candidates) AS c FROM S)"
    return {
        "clean_labels": f"{S} SELECT id, task, domain, source, document_id, split, language, pixel_hash, parent_image_hash, mining_bucket, gt_trusted FROM S",
        "field_mapping_defaults": "SELECT document_id AS id, parent_document_id AS document_id, coalesce(language, 'unknown') AS language FROM source_docs",
        "sft_adapter": rf"""
WITH A AS (SELECT *, {prompt} AS t, CASE
    WHEN image_info IS NULL OR text_info IS NULL OR len(image_info) <> 1 OR len(text_info) <> 2 THEN 'one image and one question with its answer required'
    WHEN image_info[1] IS NULL OR {q} IS NULL OR {a} IS NULL THEN 'invalid entries'
    WHEN NOT coalesce({q}.tag = 'mask' AND {a}.tag = 'no_mask', false) THEN 'mask question, then no_mask answer required'
    WHEN coalesce(image_info[1].matched_text_index, 0) <> 0 THEN 'image must belong to the question'
    WHEN {prompt} IS NULL THEN 'unsupported prompt'
    WHEN coalesce({_strip(a + ".text")}, '') = '' THEN 'blank answer'
    WHEN coalesce(image_info[1].image_url, '') = '' THEN 'no image' END AS sft_error FROM sft_records)
SELECT raw_no, CASE WHEN sft_error IS NULL THEN t END AS task, CASE WHEN sft_error IS NULL THEN image_info[1].image_url END AS image, CASE WHEN sft_error IS NULL THEN {a}.text END AS gt,
  CASE WHEN sft_error IS NULL THEN CASE WHEN t = 'table' AND starts_with(ltrim({a}.text, {_STRIP}), '<table') THEN 'html' WHEN t = 'table' THEN 'otsl' WHEN t = 'formula' THEN 'latex' ELSE 'text' END END AS gt_format, sft_error
FROM A""",
        "hash_split": f"""{S} SELECT id, CASE WHEN ('0x' || substr(sha256('[42, ' || {_one("source")} || ', ' || {_one("document_id")} || ']'), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.1 THEN 'eval' ELSE 'train' END AS new_split FROM S""",
        "derived_ids": f"""{S} SELECT id, substr(sha256('[' || {_one("pixel_hash")} || ', ' || {_one("task")} || ']'), 1, 20) AS derived FROM S""",
        "forbidden_keys": f"{S}, {_KEYS} SELECT kind, value FROM F",
        "isolate_reasons": f"{S}, {_ISOLATED} SELECT id, reason, duplicate_of FROM I",
        "leak_filter": f"{S}, {_KEYS} SELECT id FROM L",
        "excluded_documents": f"""{S}, {_KEYS},
M AS (SELECT DISTINCT {_doc("document_id")} AS document_id FROM documents WHERE {_label("source")} = 'web_harvest')
SELECT id FROM S WHERE split = 'train' AND (id IN (SELECT id FROM L) OR document_id IN (SELECT document_id FROM M WHERE document_id IS NOT NULL))""",
        "duplicate_ids": "SELECT id, batch_no, (rn - 1)::INT AS repeat FROM (SELECT id, batch_no, row_number() OVER (PARTITION BY id ORDER BY ingested_at, batch_no) AS rn FROM samples WHERE id IS NOT NULL) WHERE rn > 1",
        "formula_forms": f"{S}, A AS (SELECT id, {_TEXT} AS t FROM S WHERE task = 'formula' AND gt IS NOT NULL) SELECT id, {_FORMULA} AS form FROM A",
        "text_forms": f"{S} SELECT id, {_TEXT} AS form FROM S WHERE task = 'text' AND gt IS NOT NULL",
        "score_ascii": rf"""{S}, P AS (SELECT * FROM S WHERE task IN ('text', 'formula') AND regexp_full_match(gt, '[\x00-\x7f]*', 's')),
A AS (SELECT id, task, gt, unnest(candidates) AS c FROM P), B AS (SELECT id, task, c, {_form("c.text")} AS p, {_form("gt")} AS g FROM A WHERE regexp_full_match(c.text, '[\x00-\x7f]*', 's')),
D AS (SELECT *, coalesce(c.status = 'ok' AND c.finish_reason IN ('stop', 'eos'), false) AS done FROM B)
SELECT id, c.id AS candidate_id, CASE WHEN done AND g <> '' THEN 1 - levenshtein(p, g) / greatest(length(p), length(g), 1) END AS score,
  CASE WHEN NOT done THEN 'generation_error' WHEN g = '' THEN 'invalid_gt' ELSE 'ok' END AS status, CASE WHEN done AND g <> '' THEN p = g END AS exact,
  CASE WHEN done AND g <> '' AND task = 'text' THEN levenshtein(p, g) / length(g) END AS cer, CASE WHEN done AND g <> '' AND task = 'text' AND contains(g, ' ') THEN {_wer("p", "g")} END AS wer FROM D""",
        "import_plain": f"{S}, {_IMPORT}",
        "pairs_plain": f"{S}, {_PAIRS}",
        "mine_reasons": f"""{S}, {_ISOLATED}, {_ELIGIBLE},
J AS (SELECT S.*, reason FROM S JOIN I USING (id)),
W AS (SELECT CASE WHEN reason IS NOT NULL THEN reason WHEN split <> 'train' THEN 'held_out' WHEN gt IS NULL THEN 'missing_gt_disagreement_only' WHEN NOT {_TRUSTED} THEN 'untrusted_gt' WHEN sig.sft_score IS NULL THEN 'missing_or_failed_sft_score' ELSE 'scored' END AS reason FROM J),
X AS (SELECT reason, count(*) AS n FROM W GROUP BY 1)
SELECT reason, n FROM X WHERE reason <> 'scored' UNION ALL SELECT 'chosen', least(n, 1000) FROM X WHERE reason = 'scored' UNION ALL SELECT 'not_selected_budget', n - 1000 FROM X WHERE reason = 'scored' AND n > 1000""",
        "word_errors": rf"""{S}, A AS (SELECT id, task, gt, unnest(candidates) AS c FROM S WHERE task = 'text' AND gt IS NOT NULL), B AS (SELECT id, c.id AS candidate_id, {_form("c.text")} AS p, {_form("gt")} AS g FROM A WHERE c.text IS NOT NULL)
SELECT id, candidate_id, CASE WHEN contains(g, ' ') THEN {_wer("p", "g")} END AS wer FROM B""",
        "signals": f"""{S},
A AS (SELECT id, {_GREEDY.format("base")} AS b, {_GREEDY.format("sft")} AS s, sig.disagreement AS d, list_filter(list_transform(coalesce(candidates, []), lambda c: c.quality.score), lambda x: x IS NOT NULL) AS scores FROM S),
C AS (SELECT *, 1 - s AS e, CASE WHEN b IS NOT NULL AND s IS NOT NULL THEN greatest(b - s, 0) END AS r FROM A),
D AS (SELECT *, 0.0::DOUBLE + coalesce(e * 0.4::DOUBLE, 0) + coalesce(r * 0.4::DOUBLE, 0) + coalesce(d * 0.2::DOUBLE, 0) AS total, 0.0::DOUBLE + CASE WHEN e IS NULL THEN 0 ELSE 0.4::DOUBLE END + CASE WHEN r IS NULL THEN 0 ELSE 0.4::DOUBLE END + CASE WHEN d IS NULL THEN 0 ELSE 0.2::DOUBLE END AS weight FROM C)
SELECT id, b AS base_score, s AS sft_score, e AS gt_error, r AS regression, d AS disagreement, CASE WHEN len(scores) > 0 THEN list_max(scores) - list_min(scores) ELSE 0.0::DOUBLE END AS candidate_gap, CASE WHEN weight <> 0 THEN total / weight ELSE 0.0::DOUBLE END AS priority FROM D""",
        "usable_candidates": f"{answers} SELECT id, c.id AS candidate_id FROM A WHERE {_USABLE}",
        "role_liveness": f"{answers} SELECT c.role AS role, bool_or(coalesce(c.status = 'ok', false)) AS alive FROM A GROUP BY 1",
        "task_thresholds": f"{S}, {_THRESHOLDS} SELECT task, low, high FROM T",
        "bucket_assign": f"{S}, {_BUCKETS} SELECT id, mining_bucket FROM B",
        "bucket_counts": f"{S}, {_BUCKETS} SELECT mining_bucket, count(*) AS n FROM B GROUP BY 1",
        "apportion_budget": """
WITH X AS (SELECT *, 1000 * target_share / sum(target_share) OVER () AS exact FROM mix_targets)
SELECT task, domain, mining_bucket, (floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, concat_ws('/', domain, task, mining_bucket)) <= 1000 - sum(floor(exact)) OVER () THEN 1 ELSE 0 END)::BIGINT AS quota FROM X""",
        "stratify_quota": f"{S}, {_QUOTAS} SELECT id, position::INT AS position FROM Z WHERE position <= 1000",
        "quota_report": f"""{S}, {_QUOTAS},
U AS (SELECT category, count(*) FILTER (inside) AS in_quota, count(*) FILTER (position <= 1000) AS actual FROM Z GROUP BY 1)
SELECT category, coalesce(desired, 0)::BIGINT AS desired, coalesce(in_quota, 0) AS in_quota, coalesce(actual, 0) AS actual, greatest(coalesce(desired, 0) - coalesce(in_quota, 0), 0)::BIGINT AS shortfall FROM Y FULL JOIN U USING (category) WHERE desired IS NOT NULL OR actual > 0""",
        "coverage_hash_order": f"""{S} SELECT id, ('0x' || substr(sha256('[42, "' || id || '"]'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS place FROM S WHERE mining_bucket = 'coverage'""",
        "dpo_validate": rf"""
WITH A AS (SELECT *, (length(coalesce(messages[1].content, '')) - length(replace(coalesce(messages[1].content, ''), '<image>', ''))) // 7 AS marks, messages[2].content AS chosen,
  row_number() OVER (PARTITION BY messages, images, rejected_response ORDER BY pair_no) AS rn FROM dpo_pairs)
SELECT pair_no, CASE WHEN NOT coalesce(len(messages) = 2 AND messages[1].role = 'user' AND messages[2].role = 'assistant', false) THEN 'two messages, user and assistant, required'
  WHEN marks <> 1 THEN 'one <image> mark required' WHEN coalesce(len(images), 0) <> 1 THEN 'one image required'
  WHEN coalesce({_strip("chosen")}, '') = '' OR coalesce({_strip("rejected_response")}, '') = '' THEN 'blank answer'
  WHEN chosen = rejected_response THEN 'chosen equals rejected' WHEN rn > 1 THEN 'duplicate pair' END AS problem FROM A""",
        "preflight_lengths": """
WITH A AS (SELECT pair_no, coalesce(length(messages[2].content), 0)::INT AS c, coalesce(length(rejected_response), 0)::INT AS r FROM dpo_pairs)
SELECT pair_no, greatest(c, r) AS length, CASE WHEN greatest(c, r) > 200 THEN 'overlength: ' || greatest(c, r) WHEN c = 0 THEN 'no trainable chosen response tokens' WHEN r = 0 THEN 'no trainable rejected response tokens' END AS verdict FROM A""",
        "audit_alignment": f"""{S}, A AS (SELECT DISTINCT sample_id AS id, images[1] AS image FROM dpo_pairs)
SELECT coalesce(A.id, S.id) AS id, CASE WHEN S.id IS NULL THEN 'no audit' WHEN A.id IS NULL THEN 'no pair' ELSE 'digest differs' END AS problem FROM A FULL JOIN S ON A.id = S.id WHERE S.id IS NULL OR A.id IS NULL OR A.image IS DISTINCT FROM S.image""",
        "request_keys": f"{S}, {_REQUESTS} SELECT sample_id, role, kind, index, prompt, seed, id FROM M",
        "cache_misses": f"""{S}, {_REQUESTS}, A AS (SELECT id AS sample_id, unnest(candidates) AS c FROM S),
O AS (SELECT DISTINCT M.id FROM M JOIN A ON A.sample_id = M.sample_id AND c.role = M.role AND c.index = 0 AND c.kind = 'greedy' AND c.status = 'ok')
SELECT DISTINCT id, role FROM M WHERE id NOT IN (SELECT id FROM O)""",
        "otsl_tokens": f"{S} SELECT id, {', '.join(f'len(regexp_extract_all(gt, {chr(39)}<{t}>{chr(39)}))::INT AS {t}' for t in ('fcel', 'ecel', 'lcel', 'ucel', 'xcel', 'nl'))} FROM S WHERE task = 'table' AND gt IS NOT NULL",
        "report_counts": f"{S} " + " UNION ALL ".join(f"SELECT '{c}' AS field, coalesce({c}, 'unknown') AS value, count(*) AS n FROM S GROUP BY 2" for c in ("task", "source", "domain", "language")),
        "report_bars": f"""{S}, A AS (SELECT coalesce(document_id, 'unknown') AS value, count(*) AS n, min(struct_pack(ingested_at, batch_no, id)) AS first FROM S GROUP BY 1)
SELECT value, n, place::INT AS place FROM (SELECT value, n, row_number() OVER (ORDER BY first, value) AS place FROM A) WHERE place <= 30""",
        "report_histogram": _histogram(),
        "report_scatter": f"{S} SELECT id, round(30 + 300 * sig.base_score, 2) AS cx, round(310 - 300 * sig.sft_score, 2) AS cy FROM S WHERE sig.base_score IS NOT NULL AND sig.sft_score IS NOT NULL",
        "report_pages": f"{S} SELECT id, (row_number() OVER (ORDER BY ingested_at, batch_no, id) - 1) // 40 AS page FROM S",
        "exclusion_reasons": f"{S}, {_ISOLATED} SELECT reason, count(*) AS n FROM I WHERE reason IS NOT NULL GROUP BY 1",
        "tensor_average": f"""{_WIDE} SELECT key, {_MEAN} AS "values", CASE WHEN n <> 4 THEN 'missing in a model' END AS problem FROM G""",
        "tensor_keys": f"""{_TENSORS}, A AS (SELECT key, count(DISTINCT model) AS m, count(*) AS n, count(DISTINCT len(v)) AS s, count(DISTINCT label % 7 = 0) AS d FROM T GROUP BY key)
SELECT key, CASE WHEN m < (SELECT count(DISTINCT model) FROM T) THEN 'missing in a model' WHEN n > m THEN 'twice in a model' WHEN s > 1 THEN 'shapes differ' ELSE 'dtypes differ' END AS problem FROM A WHERE m < (SELECT count(DISTINCT model) FROM T) OR n > m OR s > 1 OR d > 1""",
        "buffers_equal": f"""{_TENSORS} SELECT key, CASE WHEN count(*) <> 4 THEN 'missing in a model' WHEN count(DISTINCT label) > 1 THEN 'models differ' END AS problem FROM T GROUP BY key""",
        "finite_check": f"""{_TENSORS} SELECT model, key, len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AS finite FROM T""",
        "shard_packing": """
WITH RECURSIVE A AS (SELECT s_name AS key, floor(abs(s_acctbal))::BIGINT AS bytes, row_number() OVER (ORDER BY s_name) AS i FROM supplier),
P AS (SELECT key, bytes, i, 0 AS shard, bytes AS used FROM A WHERE i = 1
  UNION ALL SELECT A.key, A.bytes, A.i, CASE WHEN used > 0 AND used + A.bytes > 50000 THEN shard + 1 ELSE shard END, CASE WHEN used > 0 AND used + A.bytes > 50000 THEN A.bytes ELSE used + A.bytes END FROM P JOIN A ON A.i = P.i + 1)
SELECT key, bytes, shard FROM P""",
        "seed_reasons": f"{S} SELECT id, CASE WHEN NOT coalesce(task = 'table', false) THEN 'v1_table_only' WHEN split <> 'train' OR NOT {_TRUSTED} THEN 'held_out_or_untrusted_seed' WHEN gt IS NULL THEN 'missing table GT' END AS reason FROM S",
        "page_resume": """
WITH I AS (SELECT doc_id::VARCHAR AS stem, sha256(e'v1\\n' || sha256(coalesce(text, ''))) AS key, text FROM documents WHERE page_no IS NOT NULL)
SELECT stem, key FROM I WHERE text IS NULL""",
        "stale_pages": "SELECT doc_id::VARCHAR AS stem FROM documents WHERE page_no IS NULL",
        "latest_events": "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1",
        "windowed_events": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    }
