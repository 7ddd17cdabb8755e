"""SQL that gives the rows of the corpus queries on the same tables."""
from postlens.llm.line_dedup import SITES
from postlens.llm.quality_rules import RULES, STOP_WORDS

WORD = r"[^\x20\x09-\x0D]+"


def _breaks(rule):
    value = f"({rule.measure} + {rule.slack}) * {100 if rule.per else 1}"
    unit = rule.per or "1"
    tests = [f"{value} < {unit} * {rule.low}"] * (rule.low is not None) + [f"{value} > {unit} * {rule.high}"] * (rule.high is not None)
    return "(" + " OR ".join(tests) + ")"


def _components(key, source):
    """CTEs reach (x, y) over the pairs p (x, y), and the final columns."""
    return f""", reach AS (SELECT x, y FROM p UNION SELECT reach.x, p.y FROM reach JOIN p ON reach.y = p.x),
least AS (SELECT x, least(x, min(y)) AS m FROM reach GROUP BY x),
named AS (SELECT *, coalesce(m, {key}) AS component_id FROM {source} LEFT JOIN least ON x = {key})"""


QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM s),
g AS (SELECT doc_id, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3, lead(w, 4) OVER o AS w4
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w1, w2, w3, w4) AS c FROM g WHERE w4 IS NOT NULL),
k AS (SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), i + 5) - i) AS c FROM f WHERE c > 1),
r AS (SELECT doc_id, sum(c)::BIGINT AS c FROM k GROUP BY doc_id),
m AS (SELECT s.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.c, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
  len(list_filter(ws, lambda x: lower(x) IN ({", ".join(f"'{w}'" for w in STOP_WORDS)})))::BIGINT AS n_stop_words,
  len(list_filter(ws, lambda x: NOT regexp_matches(x, '\p{{L}}')))::BIGINT AS n_letterless,
  len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*([-*•]|[0-9]+[.)])[\x20\x09-\x0D]')))::BIGINT AS n_bullet_lines,
  len(list_filter(ls, lambda x: regexp_matches(x, '([.][.][.]|…)[\x20\x09-\x0D]*$')))::BIGINT AS n_ellipsis_lines
  FROM s LEFT JOIN r USING (doc_id)),
v AS (SELECT *, concat_ws(',', {", ".join(f"CASE WHEN {_breaks(r)} THEN '{r.name}' END" for r in RULES)}) AS broken FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({" OR ".join(_breaks(r) for r in RULES if r.base)}) AS base_failed, broken = '' AS kept, broken FROM v
"""

FOREST = """
WITH RECURSIVE u AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id
  AND list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95)""" + _components(
    "vec_id", "embeddings") + """
SELECT vec_id, (SELECT count(*) FROM p WHERE p.x = vec_id) AS n_links, component_id, component_id = vec_id AS kept FROM named
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
p AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
every AS (SELECT documents.doc_id, coalesce(n, 0) AS n_shingles FROM documents LEFT JOIN n ON n.doc_id = documents.doc_id)""" + _components(
    "doc_id", "every") + """
SELECT doc_id, n_shingles, component_id, component_id = doc_id AS kept FROM named
"""

LINES = rf"""
WITH l AS (SELECT doc_id, coalesce(source, '?') AS site, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
b AS (SELECT line, min(doc_id) AS owner FROM l WHERE regexp_matches(line, '{WORD}') GROUP BY line HAVING count(DISTINCT site) >= {SITES}),
m AS (SELECT l.*, owner IS NOT NULL AND owner <> doc_id AS gone FROM l LEFT JOIN b ON b.line = l.line),
t AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS g,
  string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS left_text FROM m GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n, 0) AS n_lines, coalesce(g, 0) AS n_removed, sha256(coalesce(left_text, '')) AS text_sha256
FROM documents LEFT JOIN t ON t.doc_id = documents.doc_id
"""

CHAT = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, CASE WHEN t = 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) x(t))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(text) + len(regexp_extract_all(text, '</?s>|\[/?INST\]'))
    + CASE WHEN role = 'assistant' THEN 18 ELSE 17 END)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id
"""

def _length_first(column):
    text = f"{column}::VARCHAR"
    return f"coalesce(octet_length(encode({text}))::VARCHAR || ':' || {text}, '-')"


_FIELDS = " || ".join(_length_first(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
_LOWERED = _FIELDS.replace("text::VARCHAR", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

# crc32 of the decimal digits, bit by bit, as DuckDB has no such function.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
  lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
  lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""


def _tree(name, group, base):
    """CTE with every node (g, level, pos, node, n) of the trees over ``base`` (g, pos, node, n)."""
    return f"""{name} AS (SELECT g, 0 AS level, pos, node, n FROM {base} UNION ALL
  SELECT g, level + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM {name} WHERE n > 1 GROUP BY g, level, pos // 16)"""


def _sides(name, tree):
    """CTE with the hashes left and right of every node below a root."""
    return f"""{name} AS (SELECT g, level, pos, n,
  coalesce(string_agg(node, '') OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(node, '') OVER (o ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {tree} WHERE n > 1 WINDOW o AS (PARTITION BY g, level, pos // 16 ORDER BY pos))"""


MERKLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, sha256({_FIELDS}) AS leaf,
  CASE WHEN xor({_CRC}, 4294967295) % 5 = 0 THEN sha256({_LOWERED}) ELSE sha256({_FIELDS}) END AS shown FROM documents),
p AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY source) AS n,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, shown) - 1 AS pos FROM d),
b AS (SELECT g, pos, leaf AS node, n FROM p), {_tree("t", "g", "b")},
s AS (SELECT g, node FROM t WHERE n = 1),
c AS (SELECT 0 AS g, g AS pos, node, count(*) OVER () AS n FROM s), {_tree("u", "g", "c")},
{_sides("x", "t")}, {_sides("y", "u")},
steps AS (SELECT p.g, p.pos, x.level AS k, x.l, x.r FROM p JOIN x ON x.g = p.g AND x.pos = p.pos // (16 ** x.level)::BIGINT
  UNION ALL SELECT p.g, p.pos, 100 + y.level, y.l, y.r FROM p JOIN y ON y.pos = p.g // (16 ** y.level)::BIGINT),
path AS (SELECT g, pos, list({{'l': l, 'r': r}} ORDER BY k) AS path FROM steps GROUP BY g, pos)
SELECT doc_id, leaf, s.node AS subroot, root.node AS root,
  sha256(coalesce(array_to_string(list_transform(path, lambda z: z.l || z.r), ''), '')) AS proof_sha256,
  coalesce(list_reduce(list_prepend({{'l': shown, 'r': ''}}, path), lambda a, z: {{'l': sha256(z.l || a.l || z.r), 'r': ''}}).l, shown) AS folded_root,
  folded_root = root.node AS verified
FROM p LEFT JOIN path ON path.g = p.g AND path.pos = p.pos JOIN s ON s.g = p.g CROSS JOIN (SELECT node FROM u WHERE n = 1) root
"""

ORACLES = {"op4_forest_dedup": FOREST, "op7_line_dedup": LINES, "op8_hyperminhash": NEAR_DUPLICATES, "op9_chat": CHAT,
           "op10_quality_rules": QUALITY_RULES, "op11_merkle_exchange": MERKLE}
