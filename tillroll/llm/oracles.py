"""The operators that DuckDB SQL can express, over the whole tables."""

from __future__ import annotations

# All pairs of a label by cosine; components by following links until nothing new is reached.
NEAR_VECTORS = """WITH RECURSIVE v AS (
  SELECT DISTINCT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM v
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
roots AS (SELECT x, min(y) AS root FROM reach GROUP BY x),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id,
  vec_id = coalesce(root, vec_id) AS kept
FROM embeddings LEFT JOIN roots ON vec_id = roots.x LEFT JOIN counts ON vec_id = counts.x
"""

# All pairs that share a shingle; sizes that rule the similarity out are left out first.
NEAR_DOCUMENTS = r"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(len(ws) - 4, 1) + 1), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh
  FROM w),
u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS h FROM s),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.h = b.h AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM s
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
roots AS (SELECT x, min(y) AS root FROM reach GROUP BY x)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, root AS component_id, doc_id = root AS kept
FROM s JOIN roots ON doc_id = x
"""

# Paths as lists of turns; crc32 bit by bit, a byte and eight shifts (-1) at a time.
CONVERSATION_TRIE = """WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, coalesce(role, ''), left(coalesce(text, ''), 32),
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 5 AS base, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(CAST(c AS VARCHAR), ''), lambda b: [CAST(ascii(b) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, s: CASE WHEN s >= 0 THEN xor(crc, s) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END),
    4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM t)),
turns AS (
  SELECT convs.c, 0 AS part, place, r, x FROM convs JOIN t ON t.c = base AND place < h
  UNION ALL SELECT convs.c, 1, place, r, x FROM convs JOIN t ON t.c = convs.c AND place >= h),
seqs AS (SELECT c, coalesce(s, []) AS s FROM convs LEFT JOIN (
  SELECT c, list({'r': r, 'x': x} ORDER BY part, place) AS s FROM turns GROUP BY c) USING (c)),
paths AS (SELECT c, len(s) AS n, d, s[1:d] AS k FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seqs)),
nodes AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '') AS ends,
    CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(k[d].x)) * (count(*) - 1) END AS saved
  FROM paths GROUP BY d, k),
kids AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (d, k)),
below AS (SELECT unnest(range(0, d + 1)) AS a, k, saved, n_children FROM full_nodes),
sums AS (SELECT a AS d, k[1:a] AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM below GROUP BY ALL)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
  CAST(n.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN sums s ON s.d = n.d AND s.k = n.k
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.k[1:n.d - 1]
"""

EXACT_DUPLICATES = r"""WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t,
    translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER g = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id ASC NULLS LAST)
"""

SOURCE_DIVERGENCE = r"""WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents),
tok AS (SELECT id, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
vs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS c FROM tok SEMI JOIN kept USING (lang, term)
  GROUP BY lang, source, term),
c AS (SELECT g.lang, g.source, kept.term, CAST(coalesce(n.c, 0) AS HUGEINT) AS c,
    sum(coalesce(n.c, 0)) OVER (PARTITION BY g.lang, g.source) AS total,
    sum(coalesce(n.c, 0)) OVER (PARTITION BY g.lang, kept.term) AS lang_c,
    sum(coalesce(n.c, 0)) OVER (PARTITION BY g.lang) AS lang_total
  FROM g JOIN kept ON g.lang = kept.lang
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term),
p AS (SELECT lang, source, term, c, 1 + 1000000000 * (c + 2) // (total + 2 * v) AS p,
    1 + 1000000000 * (lang_c + 2) // (lang_total + 2 * v) AS q
  FROM c JOIN vs USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p WHERE c > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms)
    WHERE rank <= 10)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
"""

ORACLES: dict[str, str] = {
    "op2_grid_order": NEAR_VECTORS,
    "op5_minhash": NEAR_DOCUMENTS,
    "op11_burst_trie": CONVERSATION_TRIE,
    "op12_content_sort": EXACT_DUPLICATES,
    "op13_transducer": SOURCE_DIVERGENCE,
}
