"""DuckDB SQL for the operators whose whole-table results SQL can express."""

from __future__ import annotations

# The word patterns of the contracts.
SPACE_WORDS = "[^\\x20\\x09-\\x0D]+"
ALNUM_WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(table: str, columns: str, pattern: str, fold: bool) -> str:
    text = "coalesce(text, '')"
    text = FOLD.format(text) if fold else text
    return f"SELECT row_number() OVER () AS r, {columns}, regexp_extract_all({text}, '{pattern}') AS ws FROM {table}"


DECONTAMINATION = f"""
WITH d AS ({_words('documents', 'doc_id', ALNUM_WORDS, True)}),
b AS ({_words('benchmark', 'CAST(item_id AS VARCHAR) AS item', ALNUM_WORDS, True)}),
bw AS (SELECT DISTINCT item, least(10, len(ws)) AS m, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS g
  FROM b, LATERAL (SELECT unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i) WHERE len(ws) > 0),
dw AS (SELECT r, i, m, array_to_string(ws[i:i + m - 1], ' ') AS g FROM d CROSS JOIN (SELECT DISTINCT m FROM bw),
  LATERAL (SELECT unnest(range(1, len(ws) - m + 2)) AS i) WHERE len(ws) >= m),
hit AS (SELECT r, i, m, item FROM dw JOIN bw USING (m, g)),
words AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT r, i, m FROM hit), LATERAL (SELECT unnest(range(0, m)) AS k) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS ({_words('documents', 'doc_id', SPACE_WORDS, True)}),
s AS (SELECT DISTINCT r, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS g, least(5, len(ws)) AS m
  FROM d, LATERAL (SELECT unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i) WHERE len(ws) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.m = b.m AND a.r <> b.r GROUP BY 1, 2),
link AS (SELECT x, y FROM p JOIN n u ON u.r = x JOIN n v ON v.r = y WHERE 100 * common >= 75 * (u.n + v.n - common)),
reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
least AS (SELECT reach.x AS r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.y GROUP BY 1)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN least USING (r) LEFT JOIN n USING (r)"""

REPEATED_SPANS = f"""
WITH d AS ({_words('documents', 'doc_id', SPACE_WORDS, False)}),
win AS (SELECT r, i, array_to_string(ws[i:i + 34], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, len(ws) - 33)) AS i) WHERE len(ws) >= 35),
again AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + k AS p FROM win JOIN again USING (g), range(0, 35) AS t(k)),
w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM d),
kept AS (SELECT r, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY w.p) FILTER (gone.p IS NULL) AS body
  FROM w LEFT JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""
