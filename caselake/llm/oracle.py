"""SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

FILTER_AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (SELECT doc_id, part,
    CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
n AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM n a, n b, n c, n d, n e
  WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x AND b.x <> e.x AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x),
s AS (SELECT filter_order, CAST(k AS INTEGER) AS step, substring(filter_order, k, 1) AS filter, substring(filter_order, 1, k - 1) AS earlier
  FROM o, unnest([1, 2, 3, 4, 5]) AS u(k)),
r AS (SELECT *, contains(fails, filter) AS failing, earlier <> '' AND regexp_matches(fails, '[' || earlier || '_]') AS gone FROM c, s),
steps AS (SELECT part, filter_order, step, filter,
    sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept, sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = filter THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN failing AND NOT gone THEN n * good ELSE 0 END) AS good_lost, sum(CASE WHEN failing AND NOT gone THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM r GROUP BY ALL)
SELECT part, filter_order, step, filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM steps"""

# Rows of ``embeddings`` that take part, as whole numbers.
_VECTORS = """v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS z FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0{more})"""
_SCORE = "CAST(coalesce(list_sum(list_transform(list_zip({a}.z, {b}.z), lambda p: p[1] * p[2])), 0) AS BIGINT)"

TOP_K = f"""
WITH {_VECTORS.format(scale=1024, more='')},
s AS (SELECT q.vec_id AS query_id, c.vec_id, {_SCORE.format(a='q', b='c')} AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

HARD_NEGATIVES = f"""
WITH {_VECTORS.format(scale=256, more=' AND label IS NOT NULL')},
m AS (SELECT vec_id, z, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS y FROM v),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.y = c.y AS same, {_SCORE.format(a='a', b='c')} AS score FROM m a JOIN m c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE same),
n AS (SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score WHERE k <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
