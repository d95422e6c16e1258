"""DuckDB SQL with the rows of the registered queries that SQL can express."""

from __future__ import annotations

from tallymart.llm import quality

WORD = r"'[^\x20\x09-\x0D]+'"


def mixed_sql(documents: str = "documents", keep: str = "doc_id") -> str:
    """Each row of ``documents`` with size, source_size, target and copies."""
    return rf"""
WITH RECURSIVE sized AS (
  SELECT {keep}, source, doc_id AS id_, coalesce(len(regexp_extract_all(text, {WORD})), 0) AS size FROM {documents}),
by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS cap,
         (1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3)::DOUBLE AS weight FROM by_source),
want AS (SELECT sum(source_size)::DOUBLE AS want FROM by_source),
levels AS (
  SELECT 0.0::DOUBLE AS level
  UNION ALL
  SELECT (any_value(want) - sum(CASE WHEN cap <= weight * level THEN cap ELSE 0 END))
         / nullif(sum(CASE WHEN cap > weight * level THEN weight ELSE 0 END), 0)
  FROM levels, weighted, want GROUP BY level
  HAVING (any_value(want) - sum(CASE WHEN cap <= weight * level THEN cap ELSE 0 END))
         / nullif(sum(CASE WHEN cap > weight * level THEN weight ELSE 0 END), 0) > level),
goal AS (
  SELECT source, source_size, least(cap, weight * (SELECT max(level) FROM levels)) AS target,
         ('0x' || substr(md5('tallymart-mix:' || coalesce('s' || source, 'null')), 1, 8))::UBIGINT::DOUBLE
         / 4294967296.0 AS shift FROM weighted),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, id_ NULLS LAST) AS k FROM sized)
SELECT {", ".join("r." + c.strip() for c in keep.split(","))}, size::BIGINT AS size, source_size, target,
       floor(k * expected + shift)::BIGINT - floor((k - 1) * expected + shift)::BIGINT AS copies
FROM ranked r JOIN (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS expected FROM goal) g
  ON r.source IS NOT DISTINCT FROM g.source"""


def quality_sql(documents: str = "documents", labels: str = "labels") -> str:
    """Features, verdict and failing rules of every document."""
    risk, delta = quality.RISK, quality.DELTA
    feature = {r.name: r.feature.replace("1L", "1").replace(" / ", "::DOUBLE / ") for r in quality.RULES}
    ladder = quality.steps()
    union = lambda cutoffs: " OR ".join(
        f"{feature[r.name]} > {c}" for r, c in zip(quality.RULES, cutoffs) if c is not None
    )
    tests = " UNION ALL ".join(
        f"SELECT lang, pooled, {i} AS step, count(*) FILTER (WHERE {union(c)}) AS k, count(*) AS n FROM pooled GROUP BY lang, pooled"
        for i, c in enumerate(ladder)
    )
    at = lambda i: "CASE done " + " ".join(
        f"WHEN {j} THEN {c[i]}" for j, c in enumerate(ladder, 1) if c[i] is not None
    ) + " END"
    chosen = ", ".join(f"{at(i)} AS c{i}" for i in range(len(quality.RULES)))
    cut = lambda i: f"CASE WHEN o.own THEN o.c{i} ELSE rest.c{i} END"
    fails = ", ".join(f"CASE WHEN {feature[r.name]} > {cut(i)} THEN '{r.name}' END" for i, r in enumerate(quality.RULES))
    rest = ", ".join(f"max(c{i}) FILTER (WHERE pooled) AS c{i}" for i in range(len(quality.RULES)))
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), {WORD}) AS ws FROM {documents}),
windows AS (
  SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS win
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM texts WHERE len(ws) >= 8)),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, sum(least(8, coalesce(next - i, 8)))::BIGINT AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM repeated) GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, {WORD}) GROUP BY r),
features AS (
  SELECT r, doc_id, lang, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         (length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')))::BIGINT AS n_capitals
  FROM texts LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
verdicts AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM features),
marks AS (
  SELECT doc_id, min(quality) = 1 AS good FROM {labels} WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
good AS (SELECT v.* FROM verdicts v JOIN marks m ON v.doc_id = m.doc_id WHERE NOT base_failed AND good),
sizes AS (SELECT lang, count(*) AS n FROM good GROUP BY lang),
rare AS (
  SELECT lang, n < (SELECT ceil(ln({delta} / (count(*) + 1)) / ln(1 - {risk})) FROM sizes) AS pooled FROM sizes),
pooled AS (
  SELECT g.* REPLACE (CASE WHEN NOT r.pooled THEN g.lang END AS lang), r.pooled
  FROM good g JOIN rare r ON g.lang IS NOT DISTINCT FROM r.lang),
tests AS ({tests}),
tails AS (
  SELECT lang, pooled, step, CASE WHEN k >= n * {risk} THEN 1.0 ELSE (
    SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({risk}) + (n - j) * ln(1 - {risk})))
    FROM (SELECT unnest(range(0, k + 1)) AS j)) END AS p FROM tests),
level AS (SELECT {delta}::DOUBLE / count(*) AS level FROM tests WHERE step = 0),
walk AS (
  SELECT lang, pooled, max(CASE WHEN p <= level THEN 0 ELSE 1 END) OVER (
    PARTITION BY lang, pooled ORDER BY step ROWS UNBOUNDED PRECEDING) AS failed FROM tails, level),
reached AS (SELECT lang, pooled, count(*) FILTER (WHERE failed = 0) AS done FROM walk GROUP BY lang, pooled),
chosen AS (SELECT lang, pooled, NOT pooled AS own, {chosen} FROM reached),
rest AS (SELECT {rest} FROM chosen),
judged AS (
  SELECT v.*, concat_ws(',', {fails}) AS failed_rules
  FROM verdicts v LEFT JOIN chosen o ON o.own AND o.lang IS NOT DISTINCT FROM v.lang CROSS JOIN rest)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM judged"""


OP10 = f"SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken FROM ({mixed_sql()})"

OP12 = """
WITH whole AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.r, q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM whole q JOIN whole v ON q.r <> v.r WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

ORACLE_SQL = {
    "op4_quality": quality_sql(),
    "op10_mix": OP10,
    "op12_topk": OP12,
}
