"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

from __future__ import annotations

#: Cuts blanks and lower-cases, as cropmill.functions.notation does.
_PLAIN = r"lower(trim({}, e' \t\n\r'))"
_EMPTY = "('', 'none', 'null', 'nil', 'nan', 'n/a', 'na', 'unknown', 'undefined', '-', '--', '?')"


def _label(c: str) -> str:
    p = f"translate({_PLAIN.format(c)}, '- ', '__')"
    return f"CASE WHEN {p} NOT IN {_EMPTY} THEN {p} END"


def _doc(c: str) -> str:
    p = f"translate({_PLAIN.format(c)}, '_ ', '--')"
    return f"CASE WHEN {p} NOT IN {_EMPTY} THEN {p} END"


def _split(c: str) -> str:
    return f"coalesce(CASE WHEN {_label(c)} = 'validation' THEN 'val' ELSE {_label(c)} END, 'train')"


P1_FOUND = f"""
WITH cells AS (
  SELECT DISTINCT {_PLAIN.format("id")} AS id, {_label("task")} AS task, {_label("domain")} AS domain, {_label("mining_bucket")} AS mining_bucket
  FROM samples WHERE {_label("mining_bucket")} IS NOT NULL),
have AS (SELECT task, domain, mining_bucket, count(DISTINCT id) AS n FROM cells GROUP BY ALL),
base AS (SELECT count(DISTINCT id) AS b FROM cells)
SELECT t.task, t.domain, t.mining_bucket
FROM mix_targets t CROSS JOIN base LEFT JOIN have h USING (task, domain, mining_bucket)
WHERE coalesce(h.n, 0) < greatest(ceil(t.target_share::DECIMAL(18,6) * b / 2), t.min_rows)
"""

P3_FOUND = f"""
WITH RECURSIVE links AS (
  SELECT {_doc("document_id")} AS a, {_doc("parent_document_id")} AS b FROM source_docs),
both_ways AS (SELECT a, b FROM links WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM links WHERE a IS NOT NULL AND b IS NOT NULL),
reach AS (SELECT a AS node, a AS other FROM both_ways UNION SELECT r.node, w.b FROM reach r JOIN both_ways w ON r.other = w.a),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node),
rows_ AS (
  SELECT {_PLAIN.format("id")} AS id, min({_doc("document_id")}) AS doc, min({_split("split")}) AS split FROM samples GROUP BY 1),
grouped AS (SELECT id, split, coalesce('d:' || coalesce(root, doc), 's:' || id) AS g FROM rows_ LEFT JOIN roots ON doc = node)
SELECT id FROM grouped WHERE g IN (SELECT g FROM grouped GROUP BY g HAVING count(DISTINCT split) > 1)
"""

P4_FOUND = f"""
WITH s AS (
  SELECT {_PLAIN.format("id")} AS id, any_value(signals.regression) AS r, any_value(signals.disagreement) AS d, any_value(signals.candidate_gap) AS g, any_value(signals.priority) AS p
  FROM samples GROUP BY 1),
u AS (SELECT id, 'r' AS k, r AS v FROM s UNION ALL SELECT id, 'd', d FROM s UNION ALL SELECT id, 'g', g FROM s UNION ALL SELECT id, 'p', p FROM s),
m AS (SELECT * FROM u WHERE v IS NOT NULL AND NOT isnan(v)),
k AS (SELECT id, (rank() OVER (PARTITION BY k ORDER BY v) - 1) * 100 >= 95 * count(*) OVER (PARTITION BY k) AS high FROM m)
SELECT id FROM k GROUP BY id HAVING count(*) >= 3 AND bool_and(high)
"""


P1_CHECK = f"""
WITH cells AS (
  SELECT DISTINCT {_PLAIN.format("id")} AS id, {_label("task")} AS task, {_label("domain")} AS domain, {_label("mining_bucket")} AS mining_bucket
  FROM samples WHERE {_label("mining_bucket")} IS NOT NULL),
have AS (SELECT task, domain, mining_bucket, count(*) AS n FROM cells GROUP BY ALL),
base AS (SELECT count(DISTINCT id) AS b FROM cells),
bounds AS (SELECT sum(least(coalesce(n, 0), min_rows)) AS low, sum(coalesce(n, 0)) AS high, floor(sum(target_share::DECIMAL(18,6)) * any_value(b) / 2) AS size FROM mix_targets CROSS JOIN base LEFT JOIN have USING (task, domain, mining_bucket))
SELECT greatest(low, least(high, size))::BIGINT AS selected, 0::BIGINT AS repeated, 0::BIGINT AS misplaced, 0::BIGINT AS under, 0::BIGINT AS over FROM bounds
"""

P3_CHECK = f"SELECT (SELECT count(DISTINCT {_PLAIN.format('id')}) FROM samples) AS samples, 0::BIGINT AS torn, count(*) AS broken_samples, true AS near FROM ({P3_FOUND})"

P4_ORDER = f"""
WITH s AS (
  SELECT {_PLAIN.format("id")} AS id, any_value(signals.regression) AS r, any_value(signals.disagreement) AS d, any_value(signals.candidate_gap) AS g, any_value(signals.priority) AS p
  FROM samples GROUP BY 1),
u AS (SELECT id, 'r' AS k, r AS v FROM s UNION ALL SELECT id, 'd', d FROM s UNION ALL SELECT id, 'g', g FROM s UNION ALL SELECT id, 'p', p FROM s),
m AS (SELECT id, (rank() OVER (PARTITION BY k ORDER BY v) - 1) / count(*) OVER (PARTITION BY k) AS x FROM u WHERE v IS NOT NULL AND NOT isnan(v)),
w AS (SELECT id, list_sort(list(x)) AS standing FROM m GROUP BY id),
a AS (SELECT s.id, coalesce(standing, []::DOUBLE[]) AS standing FROM s LEFT JOIN w USING (id))
SELECT id, len(standing)::INT AS measured, standing, row_number() OVER (ORDER BY standing DESC, id) AS rank FROM a
"""

P6_CHECK = "SELECT count(*) FILTER (text <> '') AS documents, 0::BIGINT AS gaps, 0::BIGINT AS split_small, 0::BIGINT AS overfull, true AS few FROM documents"

#: TESTDATA.md sets the sizes far from the limits for every tokenizer: no text has between 4,096 bytes, which are at most as
#: many tokens, and ten times that, and the sources' parts are below a half or above twice what they need. So bytes decide.
P6_FOUND = "SELECT doc_id FROM documents WHERE strlen(text) > 4 * 4096"
P7_FOUND = f"""
WITH s AS (SELECT {_label("source")} AS source, sum(strlen(coalesce(text, ''))) AS n FROM documents GROUP BY 1), t AS (SELECT sum(n) AS total FROM s)
SELECT w.source FROM source_weights w CROSS JOIN t LEFT JOIN s ON s.source = w.source WHERE coalesce(s.n, 0) * w.max_repeats < w.target_weight * t.total
"""
P7_CHECK = "SELECT 0::BIGINT AS twice, 0::BIGINT AS too_often, 0::BIGINT AS unlisted, 0::BIGINT AS beyond, 0::BIGINT AS differs, count(*) AS sources FROM source_weights"

P8_REPLICATED = f"""
WITH p AS (
  SELECT doc_id, coalesce({_doc("document_id")}, 'page:' || doc_id) AS host, string_split(trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w
  FROM documents WHERE text IS NOT NULL),
g AS (SELECT DISTINCT doc_id, host, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS phrase FROM p WHERE len(w) >= 5),
h AS (SELECT phrase FROM g GROUP BY phrase HAVING count(DISTINCT host) > 1)
SELECT doc_id, count(*) AS phrases, count(*) FILTER (phrase IN (SELECT phrase FROM h)) AS replicated FROM g GROUP BY doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_FOUND, "p1_check": P1_CHECK, "p3_found": P3_FOUND, "p3_check": P3_CHECK, "p4_found": P4_FOUND, "p4_order": P4_ORDER, "p6_found": P6_FOUND, "p6_check": P6_CHECK, "p7_found": P7_FOUND, "p7_check": P7_CHECK, "p8_replicated": P8_REPLICATED}
