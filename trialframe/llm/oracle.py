"""DuckDB SQL for those of the queries that SQL can express."""

from __future__ import annotations

from .chat_format import CONTROL
from .license_scan import LOWER, TEMPLATES, UPPER, Template

OP1 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e)
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

_ESCAPES = " + ".join(f"(len(x) - len(replace(x, '{c}', ''))) // {len(c)}" for c in CONTROL)

OP4 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), e AS (
  SELECT *, list_transform([role, text], lambda x: len(x) + len(x) - len(replace(x, chr(92), '')) + {_ESCAPES}) AS size, len(role) - len(replace(role, chr(10), '')) AS feeds FROM t
)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size[1] + size[2] + feeds + {len("<|im_start|>") + len("<|im_end|>") + 2})::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP5 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM w)
), late AS (
  SELECT doc_id, p FROM windows QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1
), gone AS (
  SELECT DISTINCT doc_id, p + o AS i FROM (SELECT doc_id, p, unnest(range(0, 20)) AS o FROM late)
), stay AS (
  SELECT x.doc_id, x.i, x.word FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w) x
  ANTI JOIN gone g ON g.doc_id = x.doc_id AND g.i = x.i
), text AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM stay GROUP BY doc_id
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(text.n, 0))::BIGINT AS n_removed, sha256(coalesce(text.t, '')) AS kept_sha256
FROM w LEFT JOIN text ON text.doc_id = w.doc_id
"""

# Items of fewer than five words don't occur in the given tables, and the SQL leaves them out.
OP10 = r"""
WITH words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x09-\x0D\x20!-/:-@\[-`{-~]+'), lambda x: x <> '') AS w
  FROM (SELECT 'doc' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'item', item_id, text FROM benchmark)
), shingles AS (
  SELECT DISTINCT kind, id, array_to_string(w[p:p + 4], ' ') AS s FROM (SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS p FROM words)
), items AS (
  SELECT id AS item_id, s, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE kind = 'item'
)
SELECT d.id AS doc_id, i.item_id, count(*)::BIGINT AS n_shared, any_value(i.n)::BIGINT AS n_shingles, count(*) / any_value(i.n)::DOUBLE AS containment
FROM shingles d JOIN items i ON d.kind = 'doc' AND d.s = i.s
GROUP BY d.id, i.item_id HAVING count(*) >= 0.8 * any_value(i.n)
"""



def _template_row(template: Template) -> str:
    words = ", ".join(f"'{w}'" for w in template.words)
    return f"('{template.label}', {template.consecutive}, {template.base}, {template.stride}, {template.need}, [{words}])"


# every block of every text is compared with every template
OP11 = rf"""
WITH t AS (
  SELECT *, list_distinct(words) AS own FROM (VALUES {", ".join(map(_template_row, TEMPLATES))}) AS t(label, consecutive, base, stride, need, words)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), near AS (
  SELECT d.*, t.*, unnest(range(0, (len(w) + stride - 1) // stride)) AS b FROM d JOIN t ON len(list_intersect(w, own)) >= need
), blocks AS (
  SELECT *, len(list_intersect(list_distinct(w[b * stride + 1 : (b + 2) * stride]), own)) AS shared FROM near
), met AS (
  SELECT r, label, base, shared / len(own) AS containment,
    CASE WHEN consecutive THEN list_filter(range(b * stride, (b + 1) * stride), lambda i: w[i + 1 : i + len(words)] = words) END AS places
  FROM blocks WHERE shared >= need
), kept AS (
  SELECT r, max(containment) AS score, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels,
    sum(len(places)) FILTER (base) AS n_base, min(list_min(places)) FILTER (base) AS first_word, max(list_max(places)) FILTER (base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels
  FROM met WHERE places IS NULL OR len(places) > 0 GROUP BY r
)
SELECT doc_id::BIGINT AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN kept USING (r)
"""

_CRC = "list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda a, b: list_reduce([xor(a, b)] || range(8), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))"

OP13 = rf"""
WITH t AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT *, conv_id - conv_id % 20 AS first, xor({_CRC}, 4294967295) % 4 AS h FROM t
), c AS (
  SELECT h.conv_id, coalesce(b.turns[1 : h.h], []) || h.turns[h.h + 1 :] AS turns FROM h LEFT JOIN t b ON b.conv_id = h.first
), member AS (
  SELECT conv_id, turns[1 : d] AS path, d, len(turns) = d AS ends FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM c)
), node AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM member GROUP BY path, d
), kids AS (
  SELECT path[1 : d - 1] AS path, count(*) AS n FROM node WHERE d > 0 GROUP BY 1
), own AS (
  SELECT node.path, node.d, kids.n IS NULL AS leaf, CASE WHEN node.d > 0 THEN (node.n - 1) * len(regexp_extract_all(node.path[node.d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
  FROM node LEFT JOIN kids ON kids.path = node.path
), sums AS (
  SELECT path[1 : a] AS path, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own) GROUP BY 1
)
SELECT node.conv_id::BIGINT AS conv_id, node.d::BIGINT AS depth, up.conv_id::BIGINT AS parent_conv_id, node.n::BIGINT AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
  sums.n_leaves::BIGINT AS n_leaves, sums.saved_tokens::BIGINT AS saved_tokens, node.ends_sha256
FROM node JOIN sums ON sums.path = node.path LEFT JOIN kids ON kids.path = node.path LEFT JOIN node up ON node.d > 0 AND up.path = node.path[1 : node.d - 1] AND up.d = node.d - 1
"""

SQL = {"op13_prefix_trie": OP13, "op11_license_scan": OP11, "op1_topk_search": OP1, "op4_chat_format": OP4, "op5_substring_dedup": OP5, "op10_decontamination": OP10}
