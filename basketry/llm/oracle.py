"""DuckDB SQL for the training-data queries that SQL can express."""

from .sharding import SHARD_BYTES

_DIGITS = "('0x' || substr(md5({}), 1, {}))::BIGINT"

SQL: dict[str, str] = {}

SQL["op7_mix_sources"] = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    -ln(({_DIGITS.format("'mix|' || coalesce(doc_id::VARCHAR, '')", 13)} + 1)::DOUBLE / 4503599627370497.0)
      / coalesce(CASE q WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 END, 1.0)::DOUBLE AS k
  FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id) USING (doc_id)
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::DOUBLE AS w
  FROM sized GROUP BY source
), l AS (
  SELECT *, 2.0 * source_size / w AS full_at,
    ((SELECT 1.5::DOUBLE * sum(source_size) FROM s) - coalesce(sum(2.0 * source_size) OVER (
      ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM s
), t AS (
  SELECT source, source_size,
    least(2.0 * source_size, w * (SELECT max(lev) FROM l WHERE lev < full_at))::DOUBLE AS target FROM l
), u AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
    target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS rest,
    sum(size) OVER (PARTITION BY sized.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN rest > 0 AND 2 * (rest - upto) + size >= 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM u
"""

SQL["op9_decontaminate"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS g
  FROM (SELECT *, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM iw WHERE len(w) > 0)
), place AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, greatest(1, len(w) - n + 2))) AS i
        FROM dw, (SELECT DISTINCT n FROM win))
), hit AS (SELECT place.doc_id, win.item_id, i, place.n FROM place JOIN win USING (n, g)),
word AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit),
nh AS (SELECT doc_id, count(*) AS n_hit FROM word GROUP BY doc_id),
it AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM hit GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN nh USING (doc_id) LEFT JOIN it USING (doc_id)
"""


def shard_sql(limit: int) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
    {_DIGITS.format("coalesce(doc_id::VARCHAR, '')", 15)} AS h FROM documents
), each_depth AS (SELECT *, unnest(range(0, 61)) AS depth FROM d),
node AS (
  SELECT *, sum(n_bytes) OVER same <= {limit} OR count(*) OVER same = 1 AS fits FROM each_depth
  WINDOW same AS (PARTITION BY depth, h >> (60 - depth))
), deep AS (SELECT doc_id, n_bytes, h, min(depth) AS depth FROM node WHERE fits GROUP BY doc_id, n_bytes, h)
SELECT doc_id, n_bytes,
  coalesce(list_aggregate([(h >> (59 - i)) & 1 FOR i IN range(0, depth)], 'string_agg', ''), '') AS shard,
  depth::INTEGER AS shard_depth FROM deep
"""


SQL["op10_shard"] = shard_sql(SHARD_BYTES)

SQL["op6_near_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
    AND list_dot_product(e, e) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
c AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(c.least, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(c.least, vec_id)) AS kept
FROM v LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a
"""

SQL["op4_repeated_passages"] = """
WITH raw AS (SELECT doc_id, encode(coalesce(text, '')) AS y FROM documents),
d AS (SELECT doc_id, hex(y) AS x FROM raw),
w AS (
  SELECT doc_id, p, hash(array_slice(y, p + 1, p + 50)) AS s
  FROM (SELECT doc_id, y, unnest(range(0, greatest(0, octet_length(y) - 49))) AS p FROM raw)
), first AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
hit AS (SELECT w.doc_id, w.p FROM w JOIN first USING (s) WHERE first.least < w.doc_id),
run AS (
  SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 50, true)::INTEGER AS new FROM hit
), span AS (
  SELECT doc_id, min(p) AS a, max(p) + 50 AS b
  FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS g FROM run)
  GROUP BY doc_id, g
), gap AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span
), kept AS (
  SELECT gap.doc_id, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head,
    max(b) AS tail, sum(b - a) AS n_removed, count(*) AS n_spans
  FROM gap JOIN d USING (doc_id) GROUP BY gap.doc_id
)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(head || substr(x, 2 * tail + 1), x))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
