"""DuckDB SQL of the queries that SQL can express, over the registered tables."""

from __future__ import annotations

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP3 = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
phrases(words, label) AS (VALUES
    (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'),
    (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')),
places AS (
    SELECT doc_id, label, i FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM docs) d
    JOIN phrases p ON d.w[i + 1] = p.words[1] AND d.w[i + 1:i + len(p.words)] = p.words),
found AS (
    SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM places GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels
FROM docs d LEFT JOIN found f ON f.doc_id = d.doc_id
"""

OP5 = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
items AS (SELECT item_id, w FROM (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
    SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS gram, least(len(w), 13) AS n
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items)),
lengths AS (SELECT DISTINCT n FROM windows),
hits AS (
    SELECT doc_id, i, d.n, item_id
    FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths)) d
    JOIN windows v ON v.n = d.n AND v.gram = d.gram),
words AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
by_item AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS item_list
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(item_list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN by_item ON by_item.doc_id = d.doc_id
"""

OP6 = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
    GROUP BY x.doc_id, y.doc_id),
links AS (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * common.n >= 85 * (p.n + q.n - common.n)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (
    SELECT a, b FROM edges
    UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(r.least_id, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(r.least_id, d.doc_id)) AS kept
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS least_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""

OP7 = """
WITH v AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] for p in list_zip(q.e, c.e)]) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scores
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

OP8 = """
WITH after AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM after),
rules(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
    SELECT p.page_id, r.host || r.path AS rule, r.verdict FROM (SELECT DISTINCT page_id, host, path FROM parts) p
    JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    QUALIFY row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC) = 1)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, CASE WHEN p.host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id
"""

_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP11 = f"""
WITH docs AS (SELECT doc_id, {_TERMS.format("text")} AS w FROM documents),
totals AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs),
held AS (
    SELECT doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
    FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM docs) GROUP BY doc_id, n, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, totals GROUP BY term, n_docs),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark),
scores AS (
    SELECT item_id, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
"""

OP12 = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
    GROUP BY x.doc_id, y.doc_id),
links AS (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * common.n >= 85 * (p.n + q.n - common.n)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (
    SELECT a, b FROM edges
    UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(r.least_id, d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS least_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""
