"""DuckDB SQL for the numbered queries that SQL can express."""

from __future__ import annotations

_RULES = (
    "(VALUES ('allow','org','/'), ('block','example.org','/es/'), ('block','example.org','/en/1'), "
    "('allow','com','/fr/'), ('block','com','/de/')) AS r(verdict, rhost, rpath)"
)

OP2 = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
fits AS (
  SELECT page_id, r.rhost || r.rpath AS rule, r.verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r.rhost || r.rpath) DESC, length(r.rhost) DESC,
                       r.verdict DESC) AS n
  FROM parts JOIN {_RULES}
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, f.rule,
  coalesce(f.verdict, CASE WHEN regexp_matches(p.host || p.path, '(\\.exe|\\.zip|\\.tar\\.gz)$')
    OR contains(p.path, '/login/') OR contains(p.path, '/cgi-bin/') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.n = 1
"""

OP7 = """
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
marked AS (SELECT *, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS has_word FROM lines),
words AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS j,
    len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS w
  FROM marked WHERE has_word),
following AS (
  SELECT doc_id, j, line, w, lead(line, 1) OVER o AS line2, lead(w, 1) OVER o AS w2, lead(line, 2) OVER o AS line3
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY j)),
windows AS (
  SELECT doc_id, j, 1 AS size, md5(line) AS c FROM following WHERE w >= 50
  UNION ALL
  SELECT doc_id, j, 2, md5(line || chr(10) || line2) FROM following WHERE line2 IS NOT NULL AND w + w2 >= 50
  UNION ALL
  SELECT doc_id, j, 3, md5(line || chr(10) || line2 || chr(10) || line3) FROM following WHERE line3 IS NOT NULL),
ranked AS (
  SELECT doc_id, j, size, row_number() OVER (PARTITION BY size, c ORDER BY doc_id, j) AS n FROM windows),
gone AS (
  SELECT DISTINCT doc_id, j + d AS j FROM ranked JOIN (VALUES (0), (1), (2)) AS v(d) ON d < size WHERE n > 1),
runs AS (
  SELECT doc_id, j, CASE WHEN lag(j) OVER (PARTITION BY doc_id ORDER BY j) = j - 1 THEN 0 ELSE 1 END AS first
  FROM gone),
per AS (SELECT doc_id, count(*) AS n_removed, sum(first) AS n_runs FROM runs GROUP BY doc_id),
kept AS (
  SELECT m.doc_id, string_agg(m.line, chr(10) ORDER BY m.i) AS text
  FROM marked m LEFT JOIN words w ON w.doc_id = m.doc_id AND w.i = m.i
  LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.j = w.j
  WHERE g.j IS NULL GROUP BY m.doc_id),
sizes AS (SELECT doc_id, count(*) AS n_lines FROM words GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(s.n_lines, 0) AS BIGINT) AS n_lines,
  CAST(coalesce(p.n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(p.n_runs, 0) AS BIGINT) AS n_runs,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN per p USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

OP11 = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda c: NOT isfinite(c))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.x, d.x) AS BIGINT) AS score
  FROM rows q JOIN rows d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM pairs)
WHERE n <= 20
"""

OP12 = """
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents),
terms AS (
  SELECT d, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
vocabulary AS (SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM vocabulary GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms JOIN vocabulary USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
dense AS (
  SELECT s.lang, s.source, w.term, coalesce(c.n, 0) AS n,
    1 + 1000000000 * (coalesce(c.n, 0)::HUGEINT + 2) // (coalesce(t.total, 0)::HUGEINT + 2 * v.v) AS p
  FROM sources s JOIN vocabulary w USING (lang) JOIN sizes v USING (lang)
  LEFT JOIN counts c USING (lang, source, term) LEFT JOIN totals t USING (lang, source)),
whole AS (
  SELECT lang, term, 1 + 1000000000 * (sum(n)::HUGEINT + 2) // (any_value(total)::HUGEINT + 2 * any_value(v)) AS q
  FROM counts JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) USING (lang) JOIN sizes USING (lang)
  GROUP BY lang, term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
marks AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM dense JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM marks))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLES = {
    "op2_url_filter": OP2,
    "op7_line_dedup": OP7,
    "op11_exact_top_k": OP11,
    "op12_source_divergence": OP12,
}
