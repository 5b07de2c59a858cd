"""DuckDB SQL of the contract queries that SQL can express."""

from __future__ import annotations

# [^\x20\x09-\x0D]+ words of a text (null: none).
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP5 = rf"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
         CAST(len({_WORDS}) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 9) AS BIGINT) AS hash
  FROM documents),
per AS (
  SELECT skey, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][1 + CAST((row_number() OVER (ORDER BY skey) - 1) % 3 AS INT)] AS BIGINT) AS weight
  FROM docs GROUP BY skey),
-- water filling: the sources with the least room for their weight are capped first
ranked AS (
  SELECT *, source_size * 3 AS cap,
         coalesce(sum(source_size * 3) OVER w, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open_weight,
         sum(source_size) OVER () AS total
  FROM per WINDOW w AS (ORDER BY source_size * 3.0 / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, row_number() OVER (ORDER BY cap * 1.0 / weight, skey) AS place, CAST(CAST(total AS BIGINT) - CAST(capped AS BIGINT) AS DOUBLE) / CAST(open_weight AS DOUBLE) AS level FROM ranked),
level AS (
  SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= cap),
targets AS (
  SELECT skey, source_size, CASE WHEN l.level IS NULL OR l.level * weight > cap THEN CAST(cap AS DOUBLE)
                                 ELSE l.level * weight END AS target
  FROM (SELECT *, source_size * 3 AS cap FROM per), level l),
parts AS (
  SELECT skey, source_size, target,
         CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS q FROM targets),
cums AS (
  SELECT skey, hash, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY skey ORDER BY hash) AS cum
  FROM docs GROUP BY skey, hash),
edges AS (
  SELECT c.skey, arg_min(c.hash, c.hash) AS hash, arg_min(c.cum, c.hash) AS cum, arg_min(c.words, c.hash) AS words
  FROM cums c JOIN parts p USING (skey) WHERE c.cum > p.target - p.q * p.source_size GROUP BY c.skey),
thresholds AS (
  SELECT p.*, CASE WHEN e.skey IS NULL THEN 68719476736
                   WHEN e.cum - (p.target - p.q * p.source_size) < (p.target - p.q * p.source_size) - (e.cum - e.words)
                   THEN e.hash + 1 ELSE e.hash END AS threshold
  FROM parts p LEFT JOIN edges e USING (skey))
SELECT doc_id, size, source_size, target,
       CAST(least(q + CASE WHEN hash < threshold THEN 1 ELSE 0 END, 3) * size AS BIGINT) AS taken
FROM docs JOIN thresholds USING (skey)"""

_FORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"

OP7 = f"""
WITH docs AS (SELECT doc_id, length(coalesce(text, '')) AS points, sha256({_FORM}) AS text_sha256 FROM documents),
groups AS (
  SELECT text_sha256, count(*) AS group_size, first(doc_id ORDER BY points DESC, doc_id NULLS LAST) AS keep_id
  FROM docs GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM docs JOIN groups USING (text_sha256)"""

# Words of a text as the benchmark contract cuts them: A-Z lower-cased, [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
_FOLDED = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP9 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_FOLDED} AS w FROM documents),
items AS (SELECT item_id, {_FOLDED} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
hits AS (
  SELECT d.r, d.i, d.size, w.item_id
  FROM (SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
        FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)) d
  JOIN windows w ON d.win = w.win AND d.size = w.size),
covered AS (
  SELECT r, count(*) AS n_hit
  FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS place FROM hits) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""

OP4 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS win
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)),
firsts AS (SELECT win, min(coalesce(doc_id, 9223372036854775807)) AS lo FROM windows GROUP BY win),
covered AS (
  SELECT r, list(DISTINCT place) AS gone
  FROM (SELECT r, unnest(range(i, i + 50)) AS place FROM windows JOIN firsts USING (win)
        WHERE lo < coalesce(doc_id, 9223372036854775807)) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w
              ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM docs LEFT JOIN covered USING (r)"""

# crc32 of a value's text of ASCII characters, bit by bit (4294967295 and 3988292384 are CRC-32's fixed values).
_CRC = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({} AS VARCHAR), ''), "
        "lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), "
        "lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END)), CAST(4294967295 AS BIGINT))")


def _merkle(levels: int = 6) -> str:
    """Levels are unrolled: 16^6 leaves a source and as many sources."""
    field = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    ctes = [f"""leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, sha256({head} || {field.format("text")}) AS leaf,
         sha256({head} || {field.format(lower)}) AS changed, coalesce({_CRC.format("doc_id")} % 5 = 0, false) AS tampered
  FROM documents)""", """i0 AS MATERIALIZED (
  SELECT r, doc_id, leaf, CASE WHEN tampered THEN changed ELSE leaf END AS cur, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n, '' AS proof
  FROM leaves)""", "s0 AS MATERIALIZED (SELECT tree, pos, n, leaf AS digest FROM i0)"]

    def climb(nodes: str, rows: str, k: int, tree: str, keep: str) -> list[str]:
        return [f"""{nodes}r{k} AS MATERIALIZED (
  SELECT tree, pos // 16 AS pos, (n + 15) // 16 AS n, list(digest ORDER BY pos) AS kids FROM {nodes}{k} WHERE n > 1 GROUP BY tree, pos // 16, n)""",
                f"""{nodes}{k + 1} AS MATERIALIZED (SELECT tree, pos, n, sha256(array_to_string(kids, '')) AS digest FROM {nodes}r{k}
  UNION ALL SELECT * FROM {nodes}{k} WHERE n = 1)""",
                f"""{rows}{k + 1} AS MATERIALIZED (
  SELECT r, doc_id, leaf, {keep} c.tree, c.pos // 16 AS pos, (c.n + 15) // 16 AS n,
         proof || coalesce(array_to_string(list_filter(kids, lambda x, i: i <> c.pos % 16 + 1), ''), '') AS proof,
         CASE WHEN kids IS NULL THEN cur ELSE sha256(array_to_string(list_transform(kids, lambda x, i: CASE WHEN i = c.pos % 16 + 1 THEN cur ELSE x END), '')) END AS cur
  FROM {rows}{k} c LEFT JOIN {nodes}r{k} k ON {tree} = k.tree AND c.pos // 16 = k.pos)"""]

    for k in range(levels):
        ctes += climb("s", "i", k, "c.tree", "")
    ctes += [f"t0 AS MATERIALIZED (SELECT -1 AS tree, tree AS pos, (SELECT count(*) FROM s{levels}) AS n, digest FROM s{levels})",
             f"""j0 AS MATERIALIZED (
  SELECT r, doc_id, leaf, s.digest AS subroot, -1 AS tree, i.tree AS pos, (SELECT count(*) FROM s{levels}) AS n, proof, cur
  FROM i{levels} i JOIN s{levels} s USING (tree))"""]
    for k in range(levels):
        ctes += climb("t", "j", k, "c.tree", "subroot,")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = t.digest AS verified
FROM j{levels}, t{levels} t"""


OP12 = _merkle()

OP13 = rf"""
WITH told AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS MATERIALIZED (SELECT conv_id, {_CRC.format("conv_id")} % 6 AS h, conv_id - conv_id % 100 AS base FROM (SELECT DISTINCT conv_id FROM told)),
built AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS depth, role, text
  FROM (SELECT c.conv_id, 0 AS part, t.i, t.role, t.text FROM convs c JOIN told t ON t.conv_id = c.base AND t.i <= c.h
        UNION ALL SELECT c.conv_id, 1, t.i, t.role, t.text FROM convs c JOIN told t ON t.conv_id = c.conv_id AND t.i > c.h)),
paths AS MATERIALIZED (
  SELECT conv_id, depth, length(text) AS size,
         md5(string_agg(md5(strlen(role) || ':' || role || text), '' ) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS key
  FROM built UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS MATERIALIZED (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size FROM paths GROUP BY key, depth),
parents AS MATERIALIZED (
  SELECT n.key, n.depth, p.key AS up, q.conv_id AS parent_conv_id
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 JOIN nodes q ON q.key = p.key AND q.depth = p.depth),
kids AS MATERIALIZED (SELECT up AS key, depth - 1 AS depth, count(*) AS n_children FROM parents GROUP BY up, depth),
sums AS MATERIALIZED (
  SELECT p.key, p.depth, sum(CASE WHEN k.key IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved_tokens
  FROM nodes n LEFT JOIN kids k ON k.key = n.key AND k.depth = n.depth JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth
  GROUP BY p.key, p.depth),
ends AS MATERIALIZED (
  SELECT key, depth, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id) JOIN paths USING (conv_id, depth) GROUP BY key, depth)
SELECT n.conv_id, n.depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN sums USING (key, depth) LEFT JOIN parents USING (key, depth) LEFT JOIN kids USING (key, depth) LEFT JOIN ends USING (key, depth)"""

OP11 = rf"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM shingles GROUP BY r),
links AS MATERIALIZED (
  SELECT a, b
  FROM (SELECT x.r AS a, y.r AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.r <> y.r GROUP BY x.r, y.r)
  JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT r, r AS t FROM docs UNION SELECT reach.r, b FROM reach JOIN links ON a = t)
SELECT any_value(d.doc_id) AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN docs d ON d.r = reach.r JOIN docs o ON o.r = reach.t LEFT JOIN sizes s ON s.r = d.r GROUP BY d.r"""

ORACLE = {"op4_substring_dedup": OP4, "op5_mixing": OP5, "op7_exact_dedup": OP7, "op9_decontamination": OP9, "op11_jaccard": OP11,
          "op12_merkle": OP12,           "op13_prefix_trie": OP13}
