"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_WORDS = rf"""regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP3 = f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS spelled
  FROM (SELECT item_id, w, least(10, len(w)) AS n,
               unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
        FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM item_window),
place AS (
  SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS spelled
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM doc, size WHERE len(w) >= n)),
hit AS (SELECT doc_id, p, place.n AS n, item_id FROM place JOIN item_window USING (n, spelled)),
covered AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS spot FROM (SELECT DISTINCT doc_id, p, n FROM hit))
  GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::varchar AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit,
       coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _rendered(turns: str) -> str:
    return (
        f"coalesce(array_to_string(['<|' || x.role || '|>' || chr(10) || x.text || chr(10) || "
        f"'<|end|>' || chr(10) for x in {turns}], ''), '')"
    )


def _mask(turns: str) -> str:
    before = f"coalesce(list_sum([length(y.role) + length(y.text) + 14 for y in {turns}[1:i - 1]]), 0)"
    return (
        f"coalesce(array_to_string([(({before}) + length({turns}[i].role) + 5)::bigint::varchar || '-' || "
        f"(({before}) + length({turns}[i].role) + length({turns}[i].text) + 14)::bigint::varchar "
        f"for i in range(1, len({turns}) + 1) if {turns}[i].role = 'assistant'], ','), '')"
    )


OP4 = f"""
WITH conv AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM conversations)
  GROUP BY conv_id, alone),
answered AS (
  SELECT conv_id, t,
         coalesce(list_max([i for i in range(1, len(t) + 1) if t[i].role = 'assistant']), 0) AS last
  FROM conv),
offered AS (SELECT xor(conv_id, 1) AS conv_id, t[last] AS answer FROM answered WHERE last > 0),
pair AS (
  SELECT a.conv_id, a.t AS chosen,
         CASE WHEN last = 0 THEN t WHEN answer IS NULL THEN t[1:last - 1]
              ELSE list_append(t[1:last - 1], answer) END AS rejected
  FROM answered a LEFT JOIN offered o ON a.conv_id = o.conv_id),
cut AS (
  SELECT *, coalesce(list_min([i for i in range(1, least(len(chosen), len(rejected)) + 1)
                               if chosen[i] <> rejected[i]]) - 1,
                     least(len(chosen), len(rejected))) AS n
  FROM pair),
part AS (
  SELECT conv_id, n, chosen[1:n] AS p, chosen[n + 1:len(chosen)] AS c,
         rejected[n + 1:len(rejected)] AS r
  FROM cut)
SELECT conv_id, n::bigint AS n_prompt_turns, {_rendered("p")} AS prompt,
       {_rendered("c")} AS chosen, {_mask("c")} AS chosen_mask,
       {_rendered("r")} AS rejected, {_mask("r")} AS rejected_mask
FROM part
"""

OP10 = f"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      {_LOWER}) AS key
  FROM line),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT doc_id, i, line, coalesce(doc_id <> keeper, false) AS lost
  FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

# CRC-32 of an ASCII string, bit by bit.
_CRC32 = """xor(list_reduce(
  [4294967295::bigint] || [ascii(x)::bigint for x in string_split({}, '')],
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                           lambda c, d: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"""

OP11 = f"""
WITH conv AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                       ORDER BY turn NULLS FIRST) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
drawn AS (SELECT conv_id, t, {_CRC32.format("conv_id::varchar")} % 9 AS h FROM conv),
rebuilt AS (
  SELECT a.conv_id, coalesce(b.t[1:a.h], []) || a.t[a.h + 1:len(a.t)] AS t
  FROM drawn a LEFT JOIN conv b ON b.conv_id = a.conv_id - a.conv_id % 5),
path AS (
  SELECT conv_id, len(t) AS turns, d,
         list_transform(range(0, d + 1), lambda k: sha256(t[1:k]::json::varchar)) AS ids,
         CASE WHEN d > 0 THEN strlen(t[d].text) ELSE 0 END AS size
  FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)),
node AS (
  SELECT ids[d + 1] AS id, any_value(ids) AS ids, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(size) AS size, CASE WHEN d > 0 THEN any_value(ids[d]) END AS parent,
         coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (turns = d), '') AS ended
  FROM path GROUP BY ids[d + 1], d),
child AS (SELECT parent AS id, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY parent),
counted AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (id)),
below AS (
  SELECT id, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved
  FROM (SELECT unnest(ids) AS id, n_children, n_convs, size FROM counted) GROUP BY id)
SELECT c.conv_id, c.depth::bigint AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
       n_leaves, saved::bigint AS saved_tokens, sha256(c.ended) AS ends_sha256
FROM counted c JOIN below USING (id) LEFT JOIN counted p ON c.parent = p.id
"""

_DRAW = "('0x' || h[{}:{}])::bigint"

OP13 = f"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::varchar, '')) AS h
  FROM documents),
unit AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
         {", ".join(f"{_DRAW.format(1 + 8 * i, 8 + 8 * i)} AS h{1 + i}" for i in range(4))}
  FROM doc),
place AS (
  SELECT doc_id, t, u, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS low,
         greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS high,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM unit),
part AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:low], ''), '') AS p,
         coalesce(array_to_string(u[low + 1:high], ''), '') AS m,
         coalesce(array_to_string(u[high + 1:n], ''), '') AS s
  FROM place)
SELECT doc_id, n::bigint AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM part
"""

ORACLES = {
    "op3_decontamination": OP3,
    "op4_chat_format": OP4,
    "op10_line_dedup": OP10,
    "op11_prefix_trie": OP11,
    "op13_infill": OP13,
}
