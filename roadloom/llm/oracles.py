"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

OP4 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS sh
  FROM d
),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
u AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT u.y, r.root FROM r JOIN u ON u.x = r.doc_id)
SELECT n.doc_id, n.n AS n_shingles, min(r.root) AS component_id FROM n JOIN r USING (doc_id) GROUP BY ALL
"""

OP5 = r"""
WITH RECURSIVE g AS (
  SELECT doc_id, source, coalesce(text, '') AS text, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: x <> '') AS lines FROM documents
),
d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    -ln((CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':')[1:13] AS BIGINT) + 0.5e0) / 4503599627370496e0)
    / (0.25e0 + 0.75e0 * (CAST(length(regexp_replace(text, '[\x21-\x40\x5B-\x60\x7B-\x7E]+', '', 'g')) AS DOUBLE) / greatest(length(text), 1))
      * (CAST(len(list_distinct(lines)) AS DOUBLE) / greatest(len(lines), 1))) AS key
  FROM g
),
s AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][(r - 1) % 3 + 1] AS DOUBLE) AS w, 3e0 * source_size AS lim FROM s),
f AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY lim / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
),
lv AS (SELECT min_by(level, (lim / w, r)) AS level FROM f WHERE lim >= level * w),
t AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, least(lim, lv.level * w) AS target FROM f, lv),
q AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
),
z AS (SELECT *, target - epochs * source_size AS rest FROM q)
SELECT doc_id, size, source_size, target,
  CAST(size * (epochs + CASE WHEN upto <= rest THEN 1 WHEN upto - size < rest AND 2 * (rest - upto + size) > size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM z
"""

OP3 = r"""
WITH c AS (
  SELECT doc_id AS id, false AS bench, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT item_id, true, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') FROM benchmark
),
b AS (SELECT id AS item_id, len(w) AS size, list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda i: array_to_string(w[i:i+least(5, len(w))-1], ' ')) AS sh FROM c WHERE bench AND len(w) >= 5),
bs AS (SELECT item_id, size, unnest(sh) AS g, unnest(range(len(sh))) AS place FROM b),
d AS (SELECT id AS doc_id, len(w) AS n, list_transform(range(1, greatest(1, len(w) - 3)), lambda i: array_to_string(w[i:i+4], ' ')) AS sh FROM c WHERE NOT bench),
ds AS (SELECT doc_id, n, unnest(sh) AS g, unnest(range(len(sh))) AS pos FROM d),
h AS (SELECT * FROM ds WHERE g IN (SELECT g FROM bs)),
st AS (SELECT DISTINCT doc_id, item_id, size, greatest(0, least(pos - place, n - size)) AS start FROM h JOIN bs USING (g)),
ws AS (SELECT st.doc_id, item_id, size, start, g, count(*) AS k FROM st JOIN ds ON ds.doc_id = st.doc_id AND pos >= start AND pos < start + size - 4 GROUP BY ALL),
bk AS (SELECT item_id, g, count(*) AS k FROM bs GROUP BY ALL),
tot AS (SELECT doc_id, item_id, start, sum(k) AS k FROM ws GROUP BY ALL),
bt AS (SELECT item_id, sum(k) AS k FROM bk GROUP BY ALL),
m AS (SELECT doc_id, item_id, start, sum(least(ws.k, bk.k)) AS c FROM ws JOIN bk USING (item_id, g) GROUP BY ALL),
r AS (SELECT doc_id, item_id, start, c / (tot.k + bt.k - c) AS sim FROM m JOIN tot USING (doc_id, item_id, start) JOIN bt USING (item_id) WHERE 100 * c >= 80 * (tot.k + bt.k - c))
SELECT doc_id, item_id, max(sim) AS similarity, CAST(min_by(start, (-sim, start)) AS INTEGER) AS start_word FROM r GROUP BY ALL
"""

# All pairs. Vectors are finite there; list_cosine_similarity of doubles.
OP11 = r"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95e0),
r AS (SELECT vec_id, vec_id AS root FROM v UNION SELECT p.y, r.root FROM r JOIN p ON p.x = r.vec_id),
c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT x, count(*) AS n_links FROM p GROUP BY x)
SELECT c.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept FROM c LEFT JOIN n ON n.x = c.vec_id
"""

# CRC-32 from its table of 256 remainders (polynomial 3988292384); a turn is the digest of its
# role's length, role and text.
OP13 = r"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
t AS (
  SELECT conv_id, turn, md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, CAST(strlen(coalesce(text, '')) AS BIGINT) AS b
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (SELECT conv_id, list({'k': k, 'b': b} ORDER BY turn NULLS FIRST, k) AS own FROM t GROUP BY conv_id),
g AS (
  SELECT conv_id, own, CAST(xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, x: xor(a >> 8, tab[CAST((xor(a, x) & 255) AS BIGINT) + 1])), 4294967295) % 9 AS BIGINT) AS h
  FROM c, crc
),
s AS (
  SELECT g.conv_id, list_concat(coalesce(z.own, [])[1:g.h], g.own[g.h + 1:]) AS seq
  FROM g LEFT JOIN c z ON z.conv_id = g.conv_id - g.conv_id % 5
),
p AS (SELECT conv_id, d, list_transform(seq[1:d], lambda x: x.k) AS path, CASE WHEN d > 0 THEN seq[d].b ELSE 0 END AS b, d = len(seq) AS ends FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM s)),
n AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(b) AS own,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY path, d
),
k AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
u AS (SELECT path[1:j] AS path, CAST(sum(own) AS BIGINT) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM (SELECT path, own, n_children, unnest(range(d + 1)) AS j FROM m) GROUP BY 1)
SELECT m.conv_id, m.d AS depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, u.n_leaves, u.saved_tokens, m.ends_sha256
FROM m JOIN u USING (path) LEFT JOIN m q ON m.d > 0 AND q.path = m.path[1:m.d - 1]
"""

ORACLES: dict[str, str] = {"op3_decontamination": OP3, "op4_ngram_join": OP4, "op5_mixing": OP5, "op11_near_vectors": OP11, "op13_prefix_trie": OP13}
