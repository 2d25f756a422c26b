"""DuckDB SQL for those training-data queries that SQL can express."""

#: Classes of documents whose sets of 4-word shingles are alike to 0.8: all pairs that share a shingle, then their closure.
NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN generate_series(1, len(ws) - 3)]) END AS s
  FROM words),
posts AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM posts a JOIN posts b ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reached AS (
  SELECT u AS doc_id, v AS other FROM ways
  UNION
  SELECT r.doc_id, b.v FROM reached r JOIN ways b ON r.other = b.u),
lowest AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id)
SELECT s.doc_id, len(s.s) AS n_shingles, least(s.doc_id, coalesce(l.other, s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(l.other, s.doc_id)) AS kept
FROM sets s LEFT JOIN lowest l USING (doc_id)
"""

#: Lines by leaf (token count, three leading tokens), constants by support, templates of five texts, all but their first line.
LINE_TEMPLATES = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line_no, unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL),
parsed AS (
  SELECT doc_id, text, line_no,
    list_transform(list_filter(regexp_split_to_array(line, '\s+'), lambda t: t <> ''), lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS tokens
  FROM lines),
keyed AS (SELECT *, concat(len(tokens), ' ', array_to_string(tokens[1:3], ' ')) AS leaf, array_to_string(tokens, ' ') AS masked FROM parsed WHERE len(tokens) >= 3),
reached AS (SELECT leaf FROM keyed GROUP BY leaf HAVING count(DISTINCT text) >= 5),
found AS (SELECT * FROM keyed WHERE leaf IN (SELECT leaf FROM reached)),
masks AS (SELECT leaf, masked, any_value(tokens) AS tokens, count(DISTINCT text) AS docs FROM found GROUP BY leaf, masked),
places AS (SELECT leaf, masked, docs, len(tokens) AS n, unnest(generate_series(1, len(tokens))) AS place, unnest(tokens) AS token FROM masks),
constants AS (SELECT leaf, place, token FROM places GROUP BY leaf, place, token HAVING sum(docs) >= 5),
templates AS (
  SELECT p.leaf, p.masked, concat(p.leaf, '|', string_agg(concat(p.place, ':', p.token), '|' ORDER BY p.place)) AS template
  FROM places p JOIN constants c USING (leaf, place, token)
  GROUP BY p.leaf, p.masked, p.n HAVING count(*) >= 0.6::DOUBLE * p.n),
named AS (SELECT template, doc_id, text, line_no, row_number() OVER (PARTITION BY template ORDER BY doc_id, line_no) AS nth FROM found JOIN templates USING (leaf, masked)),
recurring AS (SELECT template FROM named GROUP BY template HAVING count(DISTINCT text) >= 5),
gone AS (SELECT doc_id, list_sort(list_distinct(list(line_no))) AS gone FROM named WHERE nth > 1 AND template IN (SELECT template FROM recurring) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
  coalesce(len(g.gone), 0) AS n_dropped, coalesce(array_to_string(g.gone, ','), '') AS dropped,
  sha256(CASE WHEN g.gone IS NULL THEN coalesce(d.text, '')
    ELSE array_to_string(list_filter(string_split(d.text, chr(10)), lambda x, i: NOT list_contains(g.gone, i - 1)), chr(10)) END) AS text_sha256
FROM documents d LEFT JOIN gone g USING (doc_id)
"""

ORACLES: dict[str, str] = {"op2_line_templates": LINE_TEMPLATES, "op8_minhash_join": NEAR_DUPLICATES}
