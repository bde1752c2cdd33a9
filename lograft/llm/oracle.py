"""DuckDB SQL for the registered queries that SQL can express.

Written from the definitions of the results, with joins over all windows; the
operators' methods play no part in it.
"""

from __future__ import annotations

_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
_WORDS = r"'[^\x20\x09-\x0D]+'"
_TERMS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, least(len(ws), 1) + 1))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r)
SELECT reach.doc_id, any_value(coalesce(n.n, 0)) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = reach.doc_id GROUP BY reach.doc_id
"""

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
first AS (SELECT g, min(doc_id) AS f FROM win GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos
  FROM win JOIN first USING (g) WHERE f < doc_id),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
kept AS (
  SELECT word.doc_id, count(gone.pos) AS n_removed,
         string_agg(word, ' ' ORDER BY word.pos) FILTER (WHERE gone.pos IS NULL) AS t
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.pos = word.pos GROUP BY word.doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

# Windows are cut from parts of 256 bytes, since a slice costs as much as what stands before it.
BYTES = """
WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS hx, strlen(coalesce(text, '')) AS n FROM documents),
part AS (
  SELECT doc_id, p, n, substr(hx, 2 * p + 1, 2 * 305) AS px
  FROM (SELECT doc_id, hx, n, unnest(range(0, n - 49, 256)) AS p FROM d WHERE n >= 50)),
win AS (
  SELECT doc_id, p + o AS i, md5(substr(px, 2 * o + 1, 100)) AS g
  FROM (SELECT doc_id, p, px, unnest(range(0, least(256, n - 49 - p))) AS o FROM part)),
first AS (SELECT g, min(doc_id) AS f FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i FROM win JOIN first USING (g) WHERE f < doc_id),
mark AS (
  SELECT doc_id, i, i > coalesce(lag(i) OVER w, -51) + 50 AS starts FROM gone
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
run AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS z
  FROM (SELECT *, sum(starts::INT) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM mark) GROUP BY doc_id, r),
-- what stands before every run, and after the last one
gap AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM run
  UNION ALL SELECT doc_id, max(z), max(n) FROM run JOIN d USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, sum(gap.z - gap.a) AS n_kept, count(*) - 1 AS n_spans,
         string_agg(substr(hx, 2 * gap.a + 1, 2 * (gap.z - gap.a)), '' ORDER BY gap.a, gap.z) AS t
  FROM gap JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n - n_kept, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(t, hx))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

DECONTAMINATION = f"""
WITH item AS (
  SELECT item_id, ws, least(10, len(ws)) AS k FROM (
    SELECT item_id, regexp_extract_all({_LOWER}, {_TERMS}) AS ws FROM benchmark) WHERE len(ws) > 0),
phrase AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM item)),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_TERMS}) AS ws FROM documents),
win AS (
  SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM phrase) WHERE len(ws) >= k)),
hit AS (SELECT doc_id, i, win.k, item_id FROM win JOIN phrase ON win.k = phrase.k AND win.g = phrase.g),
pos AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN found USING (doc_id)
"""
