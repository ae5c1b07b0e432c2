"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_RULES = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
p AS (SELECT rid, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
g AS (SELECT rid, i, concat_ws(chr(10), w, lead(w, 1) OVER s, lead(w, 2) OVER s, lead(w, 3) OVER s, lead(w, 4) OVER s) AS gram,
             lead(w, 4) OVER s IS NOT NULL AS whole FROM p WINDOW s AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g WHERE whole) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + 5)) AS i FROM r) GROUP BY rid),
m AS (SELECT d.rid, doc_id, text, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
             len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))) AS n_lines,
             len(list_distinct(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))) AS n_distinct,
             length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) AS n_capitals,
             coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines - n_distinct AS n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR 100 * (n_lines - n_distinct) > 40 * n_lines OR 100 * n_capitals > 40 * word_chars) AS kept
FROM b
"""

_ESC = r"replace(replace(coalesce({0}, ''), '\', '\\'), '<|', '<\|')"
_HEAD = "'<|' || " + _ESC.format("coalesce(role, 'none')") + " || '|>' || chr(10)"
_BODY = _ESC.format("text") + " || '<|end|>' || chr(10)"
_SIDE = """
(SELECT conv_id, coalesce(string_agg(head || body, '' ORDER BY k) FILTER (k > n_common), '') AS {0},
        coalesce(string_agg(repeat('0', length(head)) || repeat(CASE WHEN role = 'assistant' THEN '1' ELSE '0' END, length(body)), '' ORDER BY k) FILTER (k > n_common), '') AS {0}_mask
 FROM (SELECT conv_id, k, role, """ + _HEAD + " AS head, " + _BODY + """ AS body FROM {1}) JOIN common USING (conv_id) GROUP BY conv_id)
"""
_CHAT = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
l AS (SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS lent FROM t WHERE role = 'assistant' GROUP BY conv_id),
s AS (SELECT o.conv_id, o.turn, n.lent FROM l o JOIN l n ON n.conv_id = xor(o.conv_id, 1)),
c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM t),
r AS (SELECT c.conv_id, c.turn, c.role, CASE WHEN c.role = 'assistant' AND s.conv_id IS NOT NULL THEN s.lent ELSE c.text END AS text, c.k
      FROM c LEFT JOIN s ON c.conv_id = s.conv_id AND c.turn = s.turn),
common AS (SELECT conv_id, coalesce(min(k) FILTER (c.text IS DISTINCT FROM r.text) - 1, count(*)) AS n_common FROM c JOIN r USING (conv_id, k) GROUP BY conv_id)
SELECT conv_id, coalesce(prompt, '') AS prompt, n_common, chosen, chosen_mask, rejected, rejected_mask
FROM common JOIN """ + _SIDE.format("chosen", "c") + " USING (conv_id) JOIN " + _SIDE.format("rejected", "r") + """ USING (conv_id)
LEFT JOIN (SELECT conv_id, string_agg(""" + _HEAD + " || " + _BODY + """, '' ORDER BY k) FILTER (k <= n_common) AS prompt
           FROM c JOIN common USING (conv_id) GROUP BY conv_id) USING (conv_id)
"""

_WARC = """
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
       CASE WHEN octet_length(encode(coalesce(html, ''))) >= 100 AND page_id <> min(page_id) OVER g THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(encode(coalesce(html, ''))) >= 100 AND page_id <> min(page_id) OVER g THEN min(page_id) OVER g END AS refers_to,
       url, true AS intact
FROM pages WINDOW g AS (PARTITION BY coalesce(html, ''))
"""

_EXACT = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

MIX_CTES = rf"""
d AS MATERIALIZED (SELECT *, len({_WORDS})::BIGINT AS size, md5(concat('mix:', doc_id)) AS o FROM {{0}}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, (sum(source_size) OVER ())::BIGINT AS everything FROM s),
f AS (SELECT *, 2 * source_size AS cap,
             (CAST(everything AS DOUBLE) * 3 / 2 - coalesce(sum(2 * source_size) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
             / (sum(weight) OVER (b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
      FROM w WINDOW b AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source NULLS LAST)),
v AS (SELECT arg_min(level, (CAST(cap AS DOUBLE) / weight, coalesce(source, chr(1114111)))) AS level FROM f WHERE level <= CAST(cap AS DOUBLE) / weight),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), v.level * weight) AS target FROM f CROSS JOIN v),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
x AS (SELECT d.*, source_size, target, CASE WHEN size > 0 THEN whole + (sum(size) OVER (PARTITION BY d.source ORDER BY o) - size / 2.0::DOUBLE <= target - whole * source_size)::INT ELSE 0 END::BIGINT AS times
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
"""

_MIX = "WITH " + MIX_CTES.format("documents") + " SELECT doc_id, size, source_size, target, size * times AS taken FROM x"



def _codes() -> str:
    """Rounds one after the other; whole numbers throughout."""
    parts, entries, rounds = 8, 16, 6
    nearest = """a{0} AS MATERIALIZED (
  SELECT rid, part, arg_min(e, (d, e)) AS e, min(d)::BIGINT AS d
  FROM (SELECT rid, part, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS d FROM p JOIN c{0} USING (part))
  GROUP BY rid, part)"""
    renewed = """c{1} AS MATERIALIZED (
  SELECT c.part, c.e, coalesce(m.c, c.c) AS c
  FROM c{0} c LEFT JOIN (
    SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS c
    FROM (SELECT part, e, i, sum(x[i])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{0} JOIN p USING (rid, part), range(1, 9) g(i) GROUP BY part, e, i)
    GROUP BY part, e) m ON m.part = c.part AND m.e = c.e)"""
    steps = [step for r in range(rounds) for step in (nearest.format(r), renewed.format(r, r + 1))] + [nearest.format(rounds)]
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT rid, part, list_slice(v, part * 8 + 1, part * 8 + 8) AS x FROM k, range({parts}) t(part)),
c0 AS MATERIALIZED (
  SELECT part, e, x AS c FROM p JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k QUALIFY e < {entries}) USING (rid)),
{", ".join(steps)},
r AS (SELECT rid, string_agg(format('{{:02x}}', e), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY rid),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM k JOIN r USING (rid) CROSS JOIN h
"""


ORACLE = {
    "op11_vector_codes": _codes(),
    "op3_quality_rules": _RULES,
    "op5_chat_formatting": _CHAT,
    "op6_warc": _WARC,
    "op9_exact_dedup": _EXACT,
    "op10_mixing": _MIX,
}
