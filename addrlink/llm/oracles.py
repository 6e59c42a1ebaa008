"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from . import quality_rules as q

_MEASURED = {
    "symbol_share": "1000 * n_symbols // greatest(n_words, 1)",
    "upper_share": "1000 * n_upper // greatest(word_chars, 1)",
    "dup_line_share": "1000 * n_dup_lines // greatest(n_lines, 1)",
    "repeat_share": "1000 * n_repeat_words // greatest(n_words, 1)",
    "word_length": "100 * word_chars // greatest(n_words, 1)",
}

OP1 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
         [x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS ws,
         [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM documents),
win AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM d)),
twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY rid),
c AS (
  SELECT d.rid, doc_id, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_upper,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (rid)),
m AS (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
         {", ".join(f"{sql} AS {name}" for name, sql in _MEASURED.items())}
  FROM c),
one AS (
  {" UNION ALL ".join(f"SELECT lang, source, '{name}' AS measure, {name} AS v, {q.MEASURES[name]} AS least "
                      f"FROM m WHERE NOT base_failed" for name in _MEASURED)}),
b AS (
  SELECT lang, source, measure, least, greatest(length(bin(v)) - 10, 0) AS s, v FROM one),
levels AS (
  SELECT level, CASE WHEN level > 0 THEN lang END AS l, CASE WHEN level > 1 THEN source END AS s2,
         measure, least, (v >> s) << s AS bucket, count(*) AS n
  FROM b, (VALUES (0), (1), (2)) x(level) GROUP BY ALL),
run AS (
  SELECT *, sum(n) OVER (PARTITION BY level, l, s2, measure ORDER BY bucket) AS upto,
         sum(n) OVER (PARTITION BY level, l, s2, measure) AS total FROM levels),
lim AS (
  SELECT level, l, s2, measure, max(total) AS total,
         min(bucket) FILTER (4 * upto >= 3 * total)
         + {q.FENCE} * greatest(min(bucket) FILTER (4 * upto >= 3 * total)
                                - min(bucket) FILTER (4 * upto >= total), max(least)) AS top
  FROM run GROUP BY ALL),
g AS (
  SELECT lang, source, lim.measure, arg_max(top, level) AS top
  FROM (SELECT DISTINCT lang, source FROM one) k
  JOIN lim ON (level = 0 OR total >= {q.MIN_GROUP_ROWS})
       AND l IS NOT DISTINCT FROM CASE WHEN level > 0 THEN lang END
       AND s2 IS NOT DISTINCT FROM CASE WHEN level > 1 THEN source END
  GROUP BY ALL),
over_ AS (
  {" UNION ALL ".join(f"SELECT rid FROM m JOIN g ON g.measure = '{name}' AND m.lang IS NOT DISTINCT FROM g.lang "
                      f"AND m.source IS NOT DISTINCT FROM g.source AND m.{name} > g.top" for name in _MEASURED)})
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM over_) AS kept
FROM m
"""

OP2 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([y for y in embedding if y IS NULL OR NOT isfinite(y)]) = 0
    AND len([y for y in embedding if y <> 0]) > 0),
link AS (
  SELECT a.rid AS ra, a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.rid <> b.rid AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
n AS (SELECT ra, count(*) AS k FROM link GROUP BY ra)
SELECT e.vec_id, coalesce(n.k, 0)::BIGINT AS n_links, comp.c AS component_id,
       coalesce(e.vec_id = comp.c, FALSE) AS kept
FROM embeddings e LEFT JOIN v ON v.vec_id = e.vec_id LEFT JOIN n ON n.ra = v.rid
LEFT JOIN comp ON comp.a = e.vec_id
"""

OP4 = r"""
WITH r(rule_host, rule_path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (
  SELECT row_number() OVER () AS rid, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (
  SELECT rid, rule_host || rule_path AS rule, verdict FROM p JOIN r
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC, length(rule_host) DESC) = 1)
SELECT page_id, host, path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM p LEFT JOIN f USING (rid)
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(text, '') AS t, coalesce(lang, '') AS lang,
         coalesce(source, '') AS source FROM documents),
w AS (
  SELECT rid, lang, source, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT rid, lang, source,
               unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS x FROM d)),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gc AS (
  SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(c.n, 0) AS n
  FROM g JOIN k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
gt AS (SELECT lang, source, sum(n) AS total FROM gc GROUP BY ALL),
p AS (
  SELECT gc.lang, gc.source, term, n,
         (1 + 1000000000::HUGEINT * (n + 1) // (gt.total + v.v))::BIGINT AS p,
         (1 + 1000000000::HUGEINT * (lang_n + 1) // (v.total + v.v))::BIGINT AS q
  FROM gc JOIN gt ON gt.lang = gc.lang AND gt.source = gc.source JOIN v ON v.lang = gc.lang),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, r::INTEGER AS rank FROM ranked
WHERE part = 'pair' OR r <= 200
"""

OP12 = """
WITH e AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
c AS (
  SELECT rid, vec_id, label, len(v) AS dim, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM e),
s AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, sum(a.x * b.x)::BIGINT AS score
  FROM c a JOIN c b ON a.i = b.i AND a.dim = b.dim AND a.rid <> b.rid
  WHERE a.vec_id % 100 = 0 GROUP BY a.rid, b.rid, a.vec_id, b.vec_id, a.label, b.label),
p AS (
  SELECT rid, anchor_id, id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY rid ORDER BY score DESC, id) AS place FROM s WHERE same),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.rid, p.place ORDER BY s.score DESC, s.id) AS r
  FROM p JOIN s ON s.rid = p.rid AND NOT s.same
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
  WHERE p.place <= 5)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 10
"""

OP13 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
w AS (
  SELECT *, 14 + length(role)
         + length(role) - length(translate(role, '\:#<', ''))
         + length(regexp_replace(regexp_replace(text, '##(\\*)# ', '##\\\1# ', 'g'),
                                 '<(\\*)/turn>', '<\\\1/turn>', 'g')) AS n
  FROM t),
o AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         count(*) OVER (PARTITION BY conv_id) AS total
  FROM w)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (role = 'assistant' OR k = total)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""

ORACLES = {"op1_quality_rules": OP1, "op2_embedding_dedup": OP2, "op4_url_filter": OP4,
           "op11_source_divergence": OP11, "op12_hard_negatives": OP12, "op13_chat_format": OP13}
