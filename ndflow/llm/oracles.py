"""DuckDB SQL for the queries that SQL can express (brute force: every window
and every pair of documents that shares a shingle)."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORD = r"'[^\x20\x09-\x0D]+'"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS g
  FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d CROSS JOIN (SELECT DISTINCT k FROM bw))),
hits AS (SELECT dw.doc_id, dw.i, dw.k, bw.item FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
pos AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hits),
n AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n.n_hit, 0) AS n_hit, coalesce(it.n_items, 0) AS n_items,
       sha256(coalesce(it.items, '')) AS items_sha256, coalesce(n.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d)),
first AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
cut AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS p FROM win JOIN first ON win.g = first.g WHERE first.m < win.doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN cut USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS c FROM cut GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n.c, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT p.a, p.b FROM pairs p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.c >= 85 * (x.n + y.n - p.c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS root FROM d
  UNION SELECT l.b, r.root FROM reach r JOIN both_ways l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id"""


_PERMS = """SELECT a || b || c || d || e AS filter_order FROM
  (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS a), (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS b), (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
  (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS d), (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5"""

FILTER_AUDIT = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
lab AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT d.part, coalesce(lab.quality = 1, false) AS good, coalesce(lab.toxic = 1, false) AS tox,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t),
     regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS bad
  FROM d LEFT JOIN lab ON lab.doc_id = d.doc_id),
g AS (SELECT part, good, tox, bad, count(*) AS n FROM f GROUP BY ALL),
o AS (SELECT filter_order, CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS step FROM ({_PERMS})),
x AS (
  SELECT g.*, o.*, bad[ascii(filter_order[step]) - 64] AS hit,
    len(list_filter(generate_series(1, step - 1), lambda i: bad[ascii(filter_order[i]) - 64])) > 0 AS gone,
    len(list_filter(bad, lambda b: b)) AS n_bad
  FROM g CROSS JOIN o),
y AS (
  SELECT part, filter_order, step, coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS removed,
    coalesce(sum(n) FILTER (gone AND hit), 0) AS redundant, coalesce(sum(n) FILTER (hit AND n_bad = 1), 0) AS unique_fails,
    coalesce(sum(n) FILTER (NOT gone AND hit AND good), 0) AS good_lost, coalesce(sum(n) FILTER (NOT gone AND hit AND tox), 0) AS toxic_lost
  FROM x GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley
FROM y"""

TOPK_SEARCH = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

COLLOCATIONS = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS k))),
f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f AS a FROM f WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.g, c.a, x.k AS cut, x.f AS l, y.f AS r, (2000000 * CAST(c.a AS HUGEINT)) // (x.f + y.f) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.k < c.k AND x.g = c.g[1:x.k] JOIN f y ON y.lang = c.lang AND y.k = c.k - x.k AND y.g = c.g[x.k + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
left_over AS (
  SELECT best.* FROM best ANTI JOIN c q ON q.lang = best.lang AND q.k > len(best.g) AND 100 * q.a >= 80 * best.a
    AND contains(' ' || array_to_string(q.g, ' ') || ' ', ' ' || array_to_string(best.g, ' ') || ' ')),
r AS (
  SELECT *, array_to_string(g, ' ') AS phrase,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM left_over)
SELECT r.lang, r.rank, r.phrase, CAST(r.a AS BIGINT) AS a, CAST(r.l AS BIGINT) AS l, CAST(r.r AS BIGINT) AS r, CAST(n.n AS BIGINT) AS n,
  CAST(r.score AS BIGINT) AS score
FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000"""
