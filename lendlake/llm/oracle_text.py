"""DuckDB SQL of the operators that look for shared text and of the vector join."""

from __future__ import annotations

from lendlake.llm.oracle import _LOWER, _UPPER

_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"


def _word_list(pattern: str) -> str:
    return f"regexp_extract_all({_LOWERED}, '{pattern}')"


_ASCII_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED_WORD = r"[^\x20\x09-\x0D]+"

DECONTAMINATE = f"""
WITH items AS (
  SELECT item_id::VARCHAR AS item_id, words, least(13, len(words)) AS k
  FROM (SELECT item_id, {_word_list(_ASCII_WORD)} AS words FROM benchmark) WHERE len(words) > 0
),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(words[i:i + k - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - k + 2)) AS i FROM items)
),
docs AS (SELECT doc_id, {_word_list(_ASCII_WORD)} AS words FROM documents),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
runs AS (
  SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS run
  FROM placed
),
parts AS MATERIALIZED (
  SELECT doc_id, i, k, array_to_string(run[1:k], ' ') AS w
  FROM runs JOIN (SELECT DISTINCT k FROM windows) ON len(run) >= k
),
found AS (SELECT doc_id, i, k, item_id FROM parts JOIN windows USING (k, w)),
hit AS (SELECT DISTINCT doc_id, i + unnest(range(k)) AS i FROM found),
spans AS (
  SELECT doc_id, count(*) AS n
  FROM (SELECT doc_id, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS span FROM hit)
  GROUP BY doc_id, span
),
hits AS (SELECT doc_id, sum(n)::BIGINT AS n_hit, max(n) AS longest_hit FROM spans GROUP BY doc_id),
names AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS joined
  FROM (SELECT DISTINCT doc_id, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(longest_hit, 0) AS longest_hit,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(words), false) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN names USING (doc_id)
"""


def _components(links: str) -> str:
    """SQL parts after the table ``links`` (a, b; both ways): each node's least reachable one."""
    return f"""
reach AS (
  SELECT a, b FROM {links}
  UNION
  SELECT r.a, l.b FROM reach r JOIN {links} l ON l.a = r.b
),
least_reached AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""


JACCARD = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_word_list(_SPACED_WORD)} AS words FROM documents),
placed AS (SELECT doc_id, len(words) AS n_words, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
runs AS (
  SELECT doc_id, n_words, i,
    list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS run
  FROM placed
),
shingles AS (SELECT DISTINCT doc_id, run FROM runs WHERE len(run) = 5 OR (i = 1 AND n_words < 5)),
numbered AS (SELECT doc_id, dense_rank() OVER (ORDER BY run) AS s FROM shingles),
sizes AS (SELECT doc_id, count(*) AS n FROM numbered GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM numbered x JOIN numbered y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)
),{_components("links")}
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached ON a = doc_id
"""

#: Texts are cut into blocks of 1,024 bytes first, so that no slice is taken from a long string.
REPEATS = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n_bytes FROM documents),
blocks AS (
  SELECT doc_id, n_bytes, start, h[2 * start + 1:2 * (start + 1073)] AS part
  FROM (SELECT *, unnest(range(0, n_bytes, 1024)) AS start FROM docs)
),
strings AS (
  SELECT doc_id, start + i AS pos, part[2 * i + 1:2 * i + 100] AS s
  FROM (SELECT *, unnest(range(0, least(1024, n_bytes - 49 - start))) AS i FROM blocks)
),
firsts AS (SELECT s, min(doc_id) AS doc_id FROM strings GROUP BY s),
covered AS (
  SELECT t.doc_id, t.pos, t.pos - lag(t.pos) OVER (PARTITION BY t.doc_id ORDER BY t.pos) AS gap
  FROM strings t JOIN firsts f ON f.s = t.s AND f.doc_id < t.doc_id
),
numbered AS (
  SELECT doc_id, pos, count(*) FILTER (WHERE gap IS NULL OR gap > 50) OVER (PARTITION BY doc_id ORDER BY pos) AS span
  FROM covered
),
spans AS (SELECT doc_id, span, min(pos) AS lo, max(pos) + 50 AS hi FROM numbered GROUP BY doc_id, span),
edges AS (
  SELECT doc_id, lo, hi FROM spans
  UNION ALL SELECT doc_id, n_bytes, n_bytes FROM docs
),
kept AS (
  SELECT doc_id, lo, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo, hi), 0) AS after FROM edges
),
texts AS (
  SELECT doc_id, string_agg(h[2 * after + 1:2 * lo], '' ORDER BY lo, after) AS rest FROM kept JOIN docs USING (doc_id) GROUP BY doc_id
),
removed AS (SELECT doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(rest)) AS kept_sha256
FROM docs JOIN texts USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

NEAR_VECTORS = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
),
usable AS (
  SELECT *, len(v) AS dim, sqrt(list_dot_product(v, v)) AS norm FROM vectors
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
  ON x.label = y.label AND x.dim = y.dim AND x.vec_id <> y.vec_id
  WHERE x.norm > 0 AND y.norm > 0 AND list_dot_product(x.v, y.v) / (x.norm * y.norm) >= 0.93
),{_components("links")},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
  least(vec_id, coalesce(b, vec_id)) = vec_id AS kept
FROM vectors LEFT JOIN counts ON counts.a = vec_id LEFT JOIN least_reached ON least_reached.a = vec_id
"""
