"""DuckDB statements for the operators on words, written from their contracts (whole tables)."""

from __future__ import annotations

import string

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_ALNUM = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

OP1_SQL = f"""
WITH w AS (
  SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents WHERE doc_id IS NOT NULL
), win AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS k,
         unnest(range(1, len(w) - 11)) AS i
  FROM w WHERE len(w) >= 13
), f AS (SELECT k, min(doc_id) AS f FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, i + j AS pos
  FROM win JOIN f USING (k), (SELECT unnest(range(0, 13)) AS j) WHERE f < doc_id
), words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
), n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP3_SQL = f"""
WITH items AS (
  SELECT item_id, {_ALNUM.format(text=_LOWER)} AS w FROM benchmark WHERE item_id IS NOT NULL
), iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
         unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2),
                lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS k
  FROM items WHERE len(w) > 0
), d AS (
  SELECT doc_id, {_ALNUM.format(text=_LOWER)} AS w FROM documents WHERE doc_id IS NOT NULL
), dw AS (
  SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS k,
         unnest(range(1, len(w) - n + 2)) AS i
  FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n
), hit AS (SELECT doc_id, n, k, i FROM dw SEMI JOIN iw USING (n, k)),
covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hit, (SELECT unnest(range(0, 10)) AS j) WHERE j < n GROUP BY doc_id
), pairs AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit JOIN iw USING (n, k)),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM pairs GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP4_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents WHERE doc_id IS NOT NULL
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS k
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)
), edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN n USING (doc_id)
"""
