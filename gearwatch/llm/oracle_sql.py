"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from .mixing import MOST_REPEATS, SHARE, WEIGHTS

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
grams AS (SELECT doc_id, p, w[p:p + 4] AS g FROM d, unnest(range(1, len(w) - 3)) AS r(p)),
again AS (SELECT doc_id, p FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM again, unnest(range(0, 5)) AS r(k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered c USING (doc_id)),
f AS (
  SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words FROM m),
b AS (
  SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT
       + 4 * (n_words > 0 AND word_chars < 2 * n_words)::INT + 8 * (word_chars > 20 * n_words)::INT
       + 16 * (10 * n_symbols > 3 * n_words)::INT + 32 * (n_dup_lines >= 4 AND 2 * n_dup_lines > n_lines)::INT AS BIGINT) AS failed
  FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed,
       failed = 0 AS kept, failed FROM b"""

MIX = rf"""
WITH e AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size, row_number() OVER (PARTITION BY doc_id, text, source) - 1 AS k,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
d AS (
  SELECT doc_id, source, size, CASE WHEN k = 0 THEN h ELSE CAST('0x' || substr(md5(h || ':' || k), 1, 15) AS BIGINT) END AS h FROM e),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CAST({list(WEIGHTS)}[1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)}] AS DOUBLE) AS w,
         CAST({MOST_REPEATS} * source_size AS DOUBLE) AS cap, CAST({SHARE} AS DOUBLE) * (SELECT sum(source_size) FROM s) AS total FROM s),
l AS (
  SELECT *, row_number() OVER o AS n,
         (total - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY cap / w, source IS NULL DESC, source)),
k AS (SELECT min(n) AS n, arg_min(level, n) AS level FROM l WHERE w * level < cap),
t AS (SELECT source, source_size, CASE WHEN l.n >= k.n THEN w * k.level ELSE cap END AS target FROM l, k),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS own
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN budget > 0 AND (upto < budget OR upto - own < budget AND upto - budget < budget - (upto - own))
                            THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r"""

ORACLES = {"op7_quality_rules": QUALITY, "op10_mix_sources": MIX}

#: CRC-32 of a text of ASCII characters: a table of 256 values made by the polynomial, then one step a character.
CRC_TABLE = """list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""


def crc32(text: str, table: str) -> str:
    steps = f"list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT)))"
    return f"xor(4294967295, list_reduce({steps}, lambda c, x: xor(c >> 8, {table}[1 + (xor(c, x) & 255)])))"


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}) || ':' || {f} END" for f in fields) + ")"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MERKLE = f"""
WITH RECURSIVE tab AS (SELECT {CRC_TABLE} AS t),
d AS (
  SELECT doc_id, coalesce('=' || source, '') AS grp, {_leaf('text')} AS leaf,
         CASE WHEN {crc32('CAST(doc_id AS VARCHAR)', 't')} % 5 = 0 THEN {_leaf(_LOWER)} ELSE {_leaf('text')} END AS found
  FROM documents, tab),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM d),
low AS (
  SELECT grp, 0 AS lev, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT grp, lev + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM low WHERE n > 1
  GROUP BY grp, lev, pos // 16, n),
subroots AS (SELECT grp, digest AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lev, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT lev + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM high WHERE n > 1
  GROUP BY lev, pos // 16, n),
runs AS (
  SELECT 0 AS tree, grp, lev, pos // 16 AS run, list(digest ORDER BY pos) AS s FROM low WHERE n > 1 GROUP BY grp, lev, pos // 16
  UNION ALL
  SELECT 1, '', lev, pos // 16, list(digest ORDER BY pos) FROM high WHERE n > 1 GROUP BY lev, pos // 16),
walk AS (
  SELECT l.doc_id, l.leaf, l.grp AS own, 0 AS tree, l.grp, 0 AS lev, l.pos, l.n, '' AS proof, l.found AS fold, l.pos AS place FROM leaves l
  UNION ALL
  SELECT w.doc_id, w.leaf, w.own,
         CASE WHEN w.n > 1 THEN w.tree ELSE 1 END, CASE WHEN w.n > 1 THEN w.grp ELSE '' END,
         CASE WHEN w.n > 1 THEN w.lev + 1 ELSE 0 END, CASE WHEN w.n > 1 THEN w.pos // 16 ELSE b.pos END,
         CASE WHEN w.n > 1 THEN (w.n + 15) // 16 ELSE b.n END,
         CASE WHEN w.n > 1 THEN proof || array_to_string(r.s[:w.pos % 16], '') || array_to_string(r.s[w.pos % 16 + 2:], '') ELSE proof END,
         CASE WHEN w.n > 1 THEN sha256(array_to_string(r.s[:w.pos % 16], '') || fold || array_to_string(r.s[w.pos % 16 + 2:], '')) ELSE fold END,
         w.place
  FROM walk w JOIN subroots b ON b.grp = w.own
  LEFT JOIN runs r ON w.n > 1 AND r.tree = w.tree AND r.grp = w.grp AND r.lev = w.lev AND r.run = w.pos // 16
  WHERE w.n > 1 OR w.tree = 0)
SELECT w.doc_id, w.leaf, b.subroot, h.digest AS root, sha256(w.proof) AS proof_sha256, w.fold AS folded_root, w.fold = h.digest AS verified
FROM walk w JOIN subroots b ON b.grp = w.own JOIN high h ON h.n = 1 WHERE w.tree = 1 AND w.n = 1"""

ORACLES["op11_merkle_manifest"] = MERKLE

TRIE = f"""
WITH tab AS (SELECT {CRC_TABLE} AS t),
own AS (
  SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), x := coalesce("text", '')) ORDER BY turn NULLS FIRST) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (SELECT c, s, {crc32('CAST(c AS VARCHAR)', 't')} % 6 AS h FROM own, tab),
built AS (
  SELECT a.c, list_concat(coalesce(b.s, [])[:a.h], a.s[a.h + 1:]) AS s FROM cut a LEFT JOIN own b ON b.c = a.c - a.c % 100),
mem AS (SELECT c, d, len(s) AS n, md5(CAST(s[:d] AS JSON)::VARCHAR) AS k, md5(CAST(s[:greatest(d - 1, 0)] AS JSON)::VARCHAR) AS up,
               CASE WHEN d > 0 THEN length(s[d].x) ELSE 0 END AS chars
        FROM built, unnest(range(0, len(s) + 1)) AS r(d)),
node AS (
  SELECT k, d, any_value(up) AS up, min(c) AS c, count(*) AS n, min(chars) AS chars,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends
  FROM mem GROUP BY k, d),
kids AS (SELECT up, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY up, d),
sub AS (
  SELECT m.k, m.d, sum((x.n - 1) * x.chars) AS saved, count(*) FILTER (WHERE y.n IS NULL) AS leaves
  FROM node x JOIN mem m ON m.c = x.c AND m.d <= x.d LEFT JOIN kids y ON y.up = x.k AND y.d = x.d GROUP BY m.k, m.d)
SELECT a.c AS conv_id, a.d AS depth, p.c AS parent_conv_id, a.n AS n_convs, CAST(coalesce(y.n, 0) AS BIGINT) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, a.ends AS ends_sha256
FROM node a JOIN sub s ON s.k = a.k AND s.d = a.d
LEFT JOIN node p ON a.d > 0 AND p.k = a.up AND p.d = a.d - 1 LEFT JOIN kids y ON y.up = a.k AND y.d = a.d"""

ORACLES["op12_prefix_trie"] = TRIE
