"""SQL for DuckDB that gives the rows of those queries that SQL can express."""

DECONTAMINATE = r"""
WITH lowered AS (
  SELECT 'd' AS side, doc_id AS id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT 'i', item_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
split AS (SELECT side, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
d AS (SELECT id AS doc_id, w FROM split WHERE side = 'd'),
i AS (SELECT id AS item_id, w FROM split WHERE side = 'i'),
windows AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
runs AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS s FROM starts, (SELECT DISTINCT n FROM windows) WHERE p + n - 1 <= len(w)),
found AS (SELECT doc_id, p, r.n, item_id FROM runs r JOIN windows USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

JACCARD_COMPONENTS = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM worded WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 80 * (p.n + q.n - k)),
reached(doc_id, top) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT links.b, reached.top FROM reached JOIN links ON links.a = reached.doc_id)
SELECT d.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, coalesce(min(top), d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN reached USING (doc_id) GROUP BY d.doc_id
"""

VECTOR_CODES = r"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
    row_number() OVER (ORDER BY vec_id, embedding) AS r
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT r, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x FROM kept, range(16) t(p)),
book0 AS (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64),
near0 AS (
  SELECT r, q.p, any_value(x) AS x, arg_min(e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + e) AS e
  FROM parts q JOIN book0 b ON b.p = q.p GROUP BY r, q.p),
mean0 AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, (sum(x[i]) - (((sum(x[i]) % count(*)) + count(*)) % count(*))) // count(*) AS m
    FROM near0, (SELECT unnest(range(1, 1 + (SELECT any_value(len(x)) FROM parts))) AS i) GROUP BY p, e, i) GROUP BY p, e),
book1 AS (SELECT p, e, coalesce(m.c, b.c) AS c FROM book0 b LEFT JOIN mean0 m USING (p, e)),
near1 AS (
  SELECT r, q.p, any_value(x) AS x, arg_min(e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + e) AS e
  FROM parts q JOIN book1 b ON b.p = q.p GROUP BY r, q.p),
mean1 AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, (sum(x[i]) - (((sum(x[i]) % count(*)) + count(*)) % count(*))) // count(*) AS m
    FROM near1, (SELECT unnest(range(1, 1 + (SELECT any_value(len(x)) FROM parts))) AS i) GROUP BY p, e, i) GROUP BY p, e),
book2 AS (SELECT p, e, coalesce(m.c, b.c) AS c FROM book1 b LEFT JOIN mean1 m USING (p, e)),
near2 AS (
  SELECT r, q.p, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + e) AS k
  FROM parts q JOIN book2 b ON b.p = q.p GROUP BY r, q.p),
coded AS (
  SELECT r, string_agg(printf('%02x', CAST(k % 64 AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(k // 64) AS BIGINT) AS error
  FROM near2 GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (r), digest
"""

FILL_IN_MIDDLE = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
lined AS (
  SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS w, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM drawn),
cut AS (
  SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM lined),
three AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(w[1:a], ''), '') AS p, coalesce(array_to_string(w[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(w[b + 1:], ''), '') AS s FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM three
"""
