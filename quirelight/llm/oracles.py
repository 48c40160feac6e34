"""DuckDB SQL for the queries that SQL can express."""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_WORDS = rf"regexp_extract_all({LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {ALNUM_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {ALNUM_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (
  SELECT rid, p, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT rid, item_id, p, n FROM occ JOIN win USING (n, s)),
cov AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hit) GROUP BY rid),
its AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""

WORDS = r"[^\x20\x09-\x0D]+"

NGRAM_JOIN = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWERED}, '{WORDS}') AS w FROM documents),
g AS (
  SELECT DISTINCT rid, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT rid, w, least(len(w), 5) AS n, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS p FROM d WHERE len(w) > 0)),
size AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
common AS (SELECT a.rid AS x, b.rid AS y, count(*) AS n FROM g a JOIN g b ON a.s = b.s AND a.rid <> b.rid GROUP BY a.rid, b.rid),
link AS (
  SELECT x, y FROM common c JOIN size p ON p.rid = c.x JOIN size q ON q.rid = c.y
  WHERE 5 * c.n >= 4 * (p.n + q.n - c.n)),
reach AS (SELECT rid AS x, rid AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
class AS (SELECT r.x AS rid, min(d.doc_id) AS class_id FROM reach r JOIN d ON d.rid = r.y GROUP BY r.x)
SELECT d.doc_id, class_id, (SELECT count(*) FROM link l WHERE l.x = d.rid) AS n_links FROM d JOIN class USING (rid)
"""

LEXICAL_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {ALNUM_WORDS} AS w FROM documents),
facts AS (SELECT count(*) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d WHERE len(w) > 0),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, facts),
m AS (SELECT rid, doc_id, 75 + (25 * len(w) * big_n) // big_l AS m FROM d, facts WHERE len(w) > 0),
asked AS (SELECT iid, item_id, term, count(*) AS times
  FROM (SELECT iid, item_id, unnest(w) AS term FROM (SELECT row_number() OVER () AS iid, item_id, {ALNUM_WORDS} AS w FROM benchmark)) GROUP BY iid, item_id, term),
scored AS (
  SELECT iid, item_id, rid, m.doc_id, CAST(sum(times * weight.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * m.m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN m USING (rid) GROUP BY iid, item_id, rid, m.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
