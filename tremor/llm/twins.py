"""DuckDB SQL for the queries that SQL can express; the sums and joins are plain, for small tables."""

from __future__ import annotations

from tremor.llm.lines import OP9_SQL

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, between: str) -> str:
    """Words of a text column as a list: A-Z lower-cased, split at runs of the class ``between``."""
    return (f"list_filter(regexp_split_to_array(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[{between}]+'), "
            "lambda x: x <> '')")


OP2_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words("text", chr(92) + "x20" + chr(92) + "x09-" + chr(92) + "x0D")} AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 4) + 1)) AS i FROM w WHERE len(words) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r(doc_id, to_id) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.to_id)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(s.class_id) AS class_id, min(to_id) AS component_id
FROM r LEFT JOIN n USING (doc_id) LEFT JOIN (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY shingles) AS class_id
  FROM (SELECT doc_id, list(shingle ORDER BY shingle) AS shingles FROM s GROUP BY doc_id) x) s USING (doc_id)
GROUP BY doc_id"""
OP2_SQL = OP2_SQL.replace("min(s.class_id) AS class_id", "coalesce(min(s.class_id), doc_id) AS class_id")

# windows by their place in the text's hex form (two digits a byte); a window that is not the first of its kind is a repeat
OP3_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS v FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d) x),
g AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY v ORDER BY doc_id, i) AS k FROM w) x WHERE k > 1),
p AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM g),
q AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM p),
s AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM q GROUP BY doc_id, run),
k AS (SELECT s.doc_id, coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY a), 0) AS x, a AS y, a, b,
        CASE WHEN row_number() OVER (PARTITION BY s.doc_id ORDER BY a DESC) = 1 THEN substr(h, 2 * b + 1) ELSE '' END AS rest, h
      FROM s JOIN d USING (doc_id)),
t AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
        string_agg(substr(h, 2 * x + 1, 2 * (y - x)) || rest, '' ORDER BY a) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, len(d.h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, d.h))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)"""

_NOT_WORD = "".join(chr(92) + x for x in ("x00-", "x2F", "x3A-", "x60", "x7B-", "x7F"))
OP7_SQL = f"""
WITH d AS (SELECT doc_id, {_words("text", _NOT_WORD)} AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words("text", _NOT_WORD)} AS words FROM benchmark WHERE item_id IS NOT NULL),
v AS (SELECT DISTINCT item, least(10, len(words)) AS n, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS win
      FROM (SELECT item, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS i FROM b WHERE len(words) > 0) x),
z AS (SELECT DISTINCT n FROM v),
o AS (SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS win
      FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, z WHERE len(words) >= n) x),
h AS (SELECT o.doc_id, o.i, o.n, v.item FROM o JOIN v USING (n, win)),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) x GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) x GROUP BY doc_id)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)"""

_HOLD = "MATERIALIZED"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text column, over the table ``crc`` of :data:`_CRC_TABLE`."""
    return (f"xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)), "
            "lambda acc, c: xor(crc.t[(xor(acc, c) & 255)::BIGINT + 1], acc >> 8)), 4294967295::UBIGINT)")


#: One row: the 256 remainders, by the rule of the reflected polynomial.
_CRC_TABLE = f"""crc AS {_HOLD} (SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce([n::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda acc, x: CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384::UBIGINT) ELSE acc >> 1 END) AS v FROM range(256) r(n)) x)"""

OP11_SQL = rf"""
WITH {_CRC_TABLE},
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS {_HOLD} (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha) - 1 AS i, sha, words
  FROM (SELECT *, sha256(strlen(role) || ':' || role || text) AS sha,
    len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words FROM turns) x),
convs AS {_HOLD} (SELECT c.conv_id, {_crc32("c.conv_id::VARCHAR")}::BIGINT % 4 AS h, c.conv_id - c.conv_id % 20 AS donor
  FROM (SELECT DISTINCT conv_id FROM own) c, crc),
head AS (SELECT convs.conv_id, own.i AS pos, own.sha, own.words FROM convs JOIN own ON own.conv_id = donor WHERE own.i < h),
taken AS (SELECT convs.conv_id, h, count(head.conv_id) AS taken FROM convs LEFT JOIN head USING (conv_id) GROUP BY ALL),
rebuilt AS {_HOLD} (SELECT * FROM head UNION ALL
  SELECT own.conv_id, i - h + taken AS pos, sha, words FROM own JOIN taken USING (conv_id) WHERE i >= h),
prefix AS (SELECT conv_id, pos + 1 AS depth, sha256(string_agg(sha, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS k, words FROM rebuilt),
path AS {_HOLD} (SELECT conv_id, depth, k, coalesce(lag(k) OVER (PARTITION BY conv_id ORDER BY depth), '') AS up, words FROM prefix
  UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM convs),
node AS {_HOLD} (SELECT k, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(up) AS up, any_value(words) AS words, count(*) AS n_convs
  FROM path GROUP BY k),
children AS (SELECT up AS k, count(*) AS n_children FROM node WHERE up IS NOT NULL GROUP BY up),
own_value AS {_HOLD} (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN children USING (k)),
below AS (SELECT path.k, sum((n_convs - 1) * u.words) AS saved_tokens, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
  FROM own_value u JOIN path ON path.conv_id = u.conv_id AND path.depth <= u.depth GROUP BY path.k),
ends AS (SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(k, depth) AS k FROM path GROUP BY conv_id) x GROUP BY k)
SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs, v.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM own_value v LEFT JOIN node p ON p.k = v.up LEFT JOIN below ON below.k = v.k LEFT JOIN ends ON ends.k = v.k"""


def _tree(name: str, levels: int) -> str:
    """CTEs of the trees over ``{name}0`` (key, idx, h): nodes of each level, and each node's siblings before and after it."""
    out = []
    for k in range(levels):
        out.append(f"{name}n{k} AS {_HOLD} (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM {name}{k})")
        out.append(f"{name}s{k} AS {_HOLD} (SELECT a.key, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l, "
                   f"coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r FROM {name}n{k} a JOIN {name}n{k} b "
                   f"ON a.key = b.key AND a.idx // 16 = b.idx // 16 WHERE a.n > 1 GROUP BY a.key, a.idx)")
        out.append(f"{name}{k + 1} AS {_HOLD} (SELECT key, idx // 16 AS idx, CASE WHEN max(n) = 1 THEN min(h) ELSE "
                   f"sha256(string_agg(h, '' ORDER BY idx)) END AS h FROM {name}n{k} GROUP BY key, idx // 16)")
    return ",\n".join(out)


def _walk(name: str, start: str, levels: int) -> str:
    """CTEs that carry rows with (key, i, cur, proof) up the trees."""
    out, last = [], start
    for k in range(levels):
        out.append(f"{name}w{k} AS {_HOLD} (SELECT p.* REPLACE (CASE WHEN s.key IS NULL THEN cur ELSE sha256(l || cur || r) END AS cur, "
                   f"proof || coalesce(l || r, '') AS proof) FROM {last} p LEFT JOIN {name}s{k} s ON s.key = p.key AND s.idx = p.i // {16 ** k})")
        last = f"{name}w{k}"
    return ",\n".join(out)


#: Levels of the plain trees: enough for 16 ** 6 documents of a source and 16 ** 5 sources.
_DOC_LEVELS, _SOURCE_LEVELS = 6, 5


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}::VARCHAR) || ':' || {f}::VARCHAR END" for f in fields) + ")"


OP12_SQL = f"""
WITH {_CRC_TABLE},
leaves AS {_HOLD} (SELECT CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS key, doc_id, {_leaf("text")} AS leaf,
  CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS now FROM documents, crc),
placed AS {_HOLD} (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
d0 AS (SELECT key, i AS idx, leaf AS h FROM placed),
{_tree("d", _DOC_LEVELS)},
subroots AS {_HOLD} (SELECT key, h AS subroot, row_number() OVER (ORDER BY key) - 1 AS place FROM d{_DOC_LEVELS}),
s0 AS (SELECT '' AS key, place AS idx, subroot AS h FROM subroots),
{_tree("s", _SOURCE_LEVELS)},
start AS (SELECT doc_id, key, i, leaf, coalesce(now, leaf) AS cur, '' AS proof FROM placed),
{_walk("d", "start", _DOC_LEVELS)},
upper AS (SELECT w.doc_id, w.leaf, '' AS key, place AS i, subroot, cur, proof FROM dw{_DOC_LEVELS - 1} w JOIN subroots USING (key)),
{_walk("s", "upper", _SOURCE_LEVELS)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = h AS verified
FROM sw{_SOURCE_LEVELS - 1}, s{_SOURCE_LEVELS}"""

ORACLE_SQL = {"op2_jaccard": OP2_SQL, "op3_repeats": OP3_SQL, "op7_decontaminate": OP7_SQL, "op9_lines": OP9_SQL,
              "op11_prefix_trie": OP11_SQL, "op12_manifest": OP12_SQL}
