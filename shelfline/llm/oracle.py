"""The registered queries as SQL for another engine, where SQL can express them over whole tables."""

# The sample pages hold no redirect or canonical link; the aliases are checked against brute force in the tests.
_OP1 = r"""
WITH parts AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fitted AS (
  SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS place
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitted WHERE place = 1
"""

_OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS largest FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN largest END AS refers_to
FROM m
"""

_OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.ints, c.ints), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_OP12 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (
  SELECT doc_id, part, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM docs),
firsts AS (SELECT text, min(doc_id) AS least FROM docs GROUP BY text),
marks AS (
  SELECT doc_id, coalesce(max((quality = 1)::INTEGER), 0) AS good, coalesce(max((toxic = 1)::INTEGER), 0) AS toxic FROM labels
  WHERE doc_id IS NOT NULL GROUP BY doc_id),
failed AS (
  SELECT w.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         (len(words) < 200)::INTEGER AS a, (100 * len(list_distinct(words)) < 50 * len(words))::INTEGER AS b,
         (100 * (strlen(w.text) - strlen(regexp_replace(w.text, '[A-Z]', '', 'g'))) > 2 * length(w.text))::INTEGER AS c,
         regexp_matches(w.text, '[#$%&*|]')::INTEGER AS d, coalesce(w.doc_id > f.least, false)::INTEGER AS e
  FROM worded w JOIN firsts f ON w.text = f.text LEFT JOIN marks m ON w.doc_id = m.doc_id),
cells AS (
  SELECT part, a, b, c, d, e, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT p.f || q.f || r.f || s.f || t.f AS filter_order
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
walked AS (
  SELECT part, filter_order, step, docs, good, toxic, a + b + c + d + e AS n_failed,
         substr(failing, strpos('ABCDE', substr(filter_order, step, 1)), 1) = '1' AS fails,
         len(list_filter(range(1, step), lambda k: substr(failing, strpos('ABCDE', substr(filter_order, k::INTEGER, 1)), 1) = '1')) > 0 AS gone
  FROM (SELECT *, concat(a, b, c, d, e) AS failing FROM cells), steps),
audit AS (
  SELECT part, filter_order, step,
         sum(CASE WHEN NOT gone AND NOT fails THEN docs ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND fails THEN docs ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone AND fails THEN docs ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails AND n_failed = 1 THEN docs ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM walked GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)))::BIGINT AS shapley
FROM audit
"""

ORACLE = {"op1_url_filter": _OP1, "op4_warc": _OP4, "op8_top_k": _OP8, "op12_filter_audit": _OP12}
