"""DuckDB SQL for the dealt queries, written from their contracts and not from the operators."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WHITE = r"[^\x20\x09-\x0D]+"

DECONTAMINATE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
dw AS (
  SELECT rid, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM d, (SELECT DISTINCT size FROM bw) AS s, unnest(range(1, len(w) - size + 2)) AS t(i) WHERE len(w) >= size),
hits AS (SELECT rid, size, i, item_id FROM dw JOIN bw USING (size, win)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + size)) AS t(p) GROUP BY rid),
items AS (
  SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

SUBSTRINGS = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{WHITE}') AS w FROM documents),
win AS (
  SELECT rid, doc_id, i, hash(array_to_string(w[i : i + 12], ' ')) AS h, md5(array_to_string(w[i : i + 12], ' ')) AS m
  FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
least_id AS (SELECT h, m, min(doc_id) AS least FROM win GROUP BY h, m),
bad AS (SELECT DISTINCT rid, p FROM win JOIN least_id USING (h, m), unnest(range(i, i + 13)) AS t(p) WHERE least < doc_id),
words AS (SELECT rid, i, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS body, count(*) AS n
  FROM words ANTI JOIN bad ON words.rid = bad.rid AND words.i = bad.p GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

TRIES = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, turn, md5(length(r) || ':' || r || t) AS id, CAST(strlen(t) AS BIGINT) AS size FROM c),
own AS (SELECT conv_id, list({'id': id, 'size': size} ORDER BY turn NULLS FIRST, id) AS t FROM o GROUP BY conv_id),
hashed AS (  -- CRC-32 of the decimal id, bit by bit
  SELECT conv_id, t, CAST(xor(list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda a, b: list_reduce(list_concat([xor(a, b)], CAST(range(8) AS BIGINT[])), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))
  ), 4294967295) % 9 AS BIGINT) AS h FROM own),
conv AS (
  SELECT a.conv_id, list_concat(CASE WHEN b.t IS NULL THEN a.t[1:0] ELSE b.t[1:a.h] END, a.t[a.h + 1 : len(a.t)]) AS t
  FROM hashed AS a LEFT JOIN own AS b ON b.conv_id = a.conv_id - a.conv_id % 5),
pre AS (
  SELECT conv_id, d, d = len(t) AS last, array_to_string(list_transform(t[1:d], lambda x: x.id), '') AS node,
    CASE WHEN d > 0 THEN array_to_string(list_transform(t[1 : d - 1], lambda x: x.id), '') END AS above,
    CASE WHEN d > 0 THEN t[d].size ELSE 0 END AS size
  FROM conv, unnest(range(0, len(t) + 1)) AS u(d)),
nodes AS (
  SELECT node, any_value(above) AS above, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM pre GROUP BY node),
kids AS (SELECT above, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above),
own_part AS (SELECT node, depth, (kids.n IS NULL)::BIGINT AS leaf, (n_convs - 1) * size AS saved FROM nodes LEFT JOIN kids ON kids.above = node),
sums AS (
  SELECT node[1 : 32 * k] AS top, sum(leaf) AS n_leaves, sum(saved) AS saved FROM own_part, unnest(range(0, depth + 1)) AS u(k) GROUP BY top)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes AS n JOIN sums ON sums.top = n.node LEFT JOIN nodes AS p ON p.node = n.above LEFT JOIN kids ON kids.above = n.node
"""

LINES = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, i, lines[i] AS line, regexp_extract_all({LOWER.replace("text", "lines[i]")}, '{WHITE}') AS w
  FROM t, unnest(range(1, len(lines) + 1)) AS u(i)),
judged AS (SELECT rid, doc_id, i, w, array_to_string(w, ' ') AS whole FROM l WHERE len(w) >= 1),
each AS (SELECT whole, any_value(w) AS w, len(any_value(w)) AS n, min((doc_id, i)) AS rank FROM judged GROUP BY whole),
-- an edit leaves the first or the last half of the shorter line as it is
half AS (
  SELECT whole, w, n, rank, k, 1 AS side, array_to_string(w[1 : k], ' ') AS part
  FROM each, unnest(list_distinct([n // 2, (n - 1) // 2])) AS u(k) WHERE n >= 3
  UNION ALL SELECT whole, w, n, rank, k, 2, array_to_string(w[n - k + 1 : n], ' ')
  FROM each, unnest(list_distinct([n // 2, (n - 1) // 2])) AS u(k) WHERE n >= 3),
pairs AS (
  SELECT DISTINCT a.whole, a.w, b.whole AS other, b.w AS v, b.rank FROM half AS a
  JOIN half AS b USING (k, side, part) WHERE abs(a.n - b.n) <= 1 AND a.whole <> b.whole AND k = least(a.n, b.n) // 2),
apart AS (
  SELECT *, list_position(list_transform(range(1, least(len(w), len(v)) + 2), lambda x: w[x] IS NOT DISTINCT FROM v[x]), false) AS p FROM pairs),
close AS (
  SELECT whole, rank FROM apart WHERE CASE
    WHEN len(w) = len(v) THEN w[p + 1 : len(w)] = v[p + 1 : len(v)]
    WHEN len(w) < len(v) THEN w[p : len(w)] = v[p + 1 : len(v)]
    ELSE w[p + 1 : len(w)] = v[p : len(v)] END),
near AS (SELECT whole, min(rank) AS first FROM (SELECT whole, rank FROM each UNION ALL SELECT whole, rank FROM close) GROUP BY whole),
gone AS (SELECT rid, i FROM judged JOIN near USING (whole) WHERE first < (doc_id, i)),
kept AS (
  SELECT l.rid, count(*) AS n, string_agg(line, chr(10) ORDER BY l.i) AS body
  FROM l ANTI JOIN gone ON l.rid = gone.rid AND l.i = gone.i GROUP BY l.rid)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (rid)
"""


def secrets() -> str:
    """The secret scan; its patterns are the operator's, all else is said anew."""
    from llm.secrets import KINDS, ORDER, SCOPE

    def one(i: int, k) -> str:
        p = k.pattern.replace("'", "''")
        cut = f"string_split_regex(t, '{p}')"
        strong = f"length(c[j]) >= {k.least}" if k.strong else "false"
        return f"""
SELECT rid, '{k.role}' AS role, '{k.name}' AS weak, '{k.strong or ""}' AS base, {strong} AS strong, length(m[j]) AS size,
  CAST(list_sum([length(x) FOR x IN g[1 : j]]) + list_sum([length(x) FOR x IN m[1 : j]]) AS BIGINT) AS stop
FROM (SELECT rid, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {k.group}) AS c, {cut} AS g FROM d) AS x,
  unnest(range(1, len(m) + 1)) AS u(j) WHERE {strong} OR length(c[j]) >= {k.weak}"""

    union = " UNION ALL ".join(one(i, k) for i, k in enumerate(KINDS))
    order = "[" + ", ".join(f"'{x}'" for x in ORDER) + "]"
    base = "name IN ('assign', 'access', 'hex')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
parts AS (SELECT *, stop - size AS start FROM ({union}) AS all_kinds),
named AS (
  SELECT rid, start, stop, CASE WHEN strong THEN base WHEN EXISTS (
    SELECT 1 FROM parts AS b WHERE b.rid = a.rid AND (a.role = 'secret') <> (b.role = 'secret')
      AND b.start <= a.stop + {SCOPE} AND b.stop >= a.start - {SCOPE}) THEN weak END AS name
  FROM parts AS a),
spans AS (SELECT *, name || ':' || start || ':' || stop AS span, list_position({order}, name) AS p FROM named WHERE name IS NOT NULL),
sums AS (
  SELECT rid, count(*) FILTER (name = 'assign') AS n_assign, count(*) FILTER (name = 'access') AS n_access,
    count(*) FILTER (name = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start, p) FILTER ({base}) AS base,
    string_agg(span, ',' ORDER BY start, p, span) AS spans FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN sums USING (rid)
"""
