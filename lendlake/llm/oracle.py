"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

#: crc32 by its table, byte by byte: ``crc(bytes)`` over a list of byte values.
_CRC = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
    FROM range(256) AS r(i)
  )
)"""


def _crc32(text: str, table: str = "t") -> str:
    """SQL for the unsigned crc32 of a text's UTF-8 bytes."""
    byte = f"('0x' || substr(hex({text}), 2 * i - 1, 2))::BIGINT"
    values = f"[{byte} for i in range(1, strlen({text}) + 1)]"
    step = f"lambda a, b: xor(a >> 8, {table}[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce([4294967295] || {values}, {step}), 4294967295)"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table: str, key: str) -> str:
    lowered = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return (
        rf"SELECT {key}, unnest(regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word"
        f" FROM {table}"
    )


RESAMPLING = f"""
WITH {_CRC},
doc_words AS ({_words("documents", "doc_id")}),
item_words AS ({_words("benchmark", "item_id")}),
buckets AS (
  SELECT word, {_crc32("word")} % 10000 AS bucket
  FROM (SELECT word FROM doc_words UNION SELECT word FROM item_words), crc_table
),
source AS (SELECT bucket, count(*) AS s FROM doc_words JOIN buckets USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM item_words JOIN buckets USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(
    (coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM doc_words) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT count(*) FROM item_words) + 10000)::DOUBLE)
  ))::BIGINT AS gain
  FROM source LEFT JOIN target USING (bucket)
),
weights AS (
  SELECT doc_id, count(*) AS n_words, sum(gain)::BIGINT AS weight
  FROM doc_words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY doc_id
),
scored AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(weight, 0) AS weight,
    ('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT AS h
  FROM documents LEFT JOIN weights USING (doc_id)
),
final AS (
  SELECT doc_id, n_words, weight,
    weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM scored
),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS drawn
  FROM final WHERE n_words >= 20
)
SELECT doc_id, n_words AS n_features, weight, score,
  CASE WHEN place <= drawn THEN place END AS rank, n_words
FROM final LEFT JOIN ranked USING (doc_id)
"""

PREFIX_TRIE = f"""
WITH {_CRC},
own AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
    ORDER BY turn NULLS FIRST) AS turns
  FROM conversations GROUP BY conv_id
),
shares AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM own, crc_table),
rebuilt AS (
  SELECT o.conv_id, coalesce(b.turns[1:h], []) || o.turns[h + 1:] AS turns
  FROM own o JOIN shares USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
),
paths AS (
  SELECT conv_id, d, turns[1:d] AS path, d = len(turns) AS ends
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
),
trie AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].x, '[^\\x20\\x09-\\x0D]+')) END AS words
  FROM paths GROUP BY path, d
),
linked AS (
  SELECT t.*, p.conv_id AS parent_conv_id,
    (SELECT count(*) FROM trie k WHERE k.d = t.d + 1 AND k.path[1:t.d] = t.path) AS n_children
  FROM trie t LEFT JOIN trie p ON p.d = t.d - 1 AND p.path = t.path[1:t.d - 1]
),
above AS (
  SELECT path[1:unnest(range(d + 1))] AS top, n_children = 0 AS leaf, (n_convs - 1) * words AS saved FROM linked
),
sums AS (
  SELECT top AS path, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY top
)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM linked JOIN sums USING (path)
"""
