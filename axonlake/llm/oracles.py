"""SQL for the corpus queries that it can express, for DuckDB over whole tables."""

from __future__ import annotations

#: Removal of earlier documents' strings: texts as hexadecimal digits, two a byte.
SUFFIX_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(0, len(h) // 2 - 49))) AS p FROM d)),
gone AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS first FROM starts) WHERE first < doc_id),
runs AS (SELECT doc_id, p, coalesce(lag(p) OVER w, -100) AS before FROM gone WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS z FROM (SELECT doc_id, p, sum((p > before + 50)::INT) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM runs) GROUP BY doc_id, k),
kept AS (SELECT doc_id, a AS upto, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM (SELECT doc_id, a, z FROM spans UNION ALL SELECT doc_id, len(h) // 2, len(h) // 2 FROM d))
SELECT d.doc_id, (len(any_value(h)) // 2)::BIGINT AS n_bytes, (len(any_value(h)) // 2 - coalesce(sum(upto - since), 0))::BIGINT AS n_removed, (count(*) - 1)::BIGINT AS n_spans,
 sha256(unhex(string_agg(substr(h, 2 * since + 1, 2 * (upto - since)), '' ORDER BY since))) AS kept_sha256
FROM d JOIN kept USING (doc_id) GROUP BY d.doc_id
"""

#: Line frequency: words, lines by their words in small letters, documents whose lines are all the same counted once.
QUALITY_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
grams AS (SELECT r, p, ws[p:p + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS p FROM w)),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
repeats AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, p + unnest([0, 1, 2]) AS q FROM twice) GROUP BY r),
raw AS (SELECT r, source, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
lines AS MATERIALIZED (SELECT r, source, i, line, len(ws) AS n, array_to_string(ws, ' ') AS norm FROM (SELECT *, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM raw) WHERE len(ws) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
whole AS (SELECT r, md5(string_agg(norm, chr(10) ORDER BY i)) AS x FROM lines GROUP BY r),
hosts AS (SELECT source, count(*) AS n FROM d GROUP BY source),
often AS (SELECT l.source, norm FROM lines l JOIN whole USING (r) JOIN hosts h ON h.source IS NOT DISTINCT FROM l.source GROUP BY l.source, norm, h.n HAVING count(DISTINCT x) > 20 AND count(DISTINCT x) > 0.0005 * h.n),
removed AS (SELECT r, sum(n) AS n FROM lines l JOIN often o ON o.norm = l.norm AND o.source IS NOT DISTINCT FROM l.source GROUP BY r),
s AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words, len(ws) - coalesce(removed.n, 0) AS rest
 FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN repeats USING (r) LEFT JOIN removed USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rest >= 0.3 * n_words AS kept FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
"""


def _field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Merkle manifest: levels by recursion, siblings by their run of eight, the tampered leaf folded level by level.
MERKLE_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, lang, {_leaf("text")} AS leaf, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
  {_leaf("CASE WHEN c % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END")} AS bad
  FROM (SELECT *, xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda p, z: xor(p >> 1, 3988292384 * (p & 1))))) AS c FROM documents)),
t AS (SELECT 0 AS lvl, lang, i, n, leaf AS h FROM d UNION ALL SELECT lvl + 1, lang, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY lvl, lang, i // 8),
subs AS MATERIALIZED (SELECT lang, lvl AS top, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS k, count(*) OVER () AS langs FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, k AS i, langs AS n, subroot AS h FROM subs UNION ALL SELECT lvl + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY lvl, i // 8),
all_nodes AS MATERIALIZED (SELECT t.lvl, coalesce('=' || t.lang, '') AS g, i, n, h FROM t UNION ALL SELECT lvl, '*', i, n, h FROM u),
sib AS MATERIALIZED (SELECT a.lvl, a.g, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after FROM all_nodes a JOIN all_nodes b ON a.lvl = b.lvl AND a.g = b.g AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY 1, 2, 3),
steps AS MATERIALIZED (SELECT d.doc_id, s.lvl AS step, before, after FROM d JOIN sib s ON s.g = coalesce('=' || d.lang, '') AND s.i = d.i // (8 ** s.lvl)::BIGINT
  UNION ALL SELECT d.doc_id, subs.top + s.lvl, before, after FROM d JOIN subs ON subs.lang IS NOT DISTINCT FROM d.lang JOIN sib s ON s.g = '*' AND s.i = subs.k // (8 ** s.lvl)::BIGINT),
proofs AS (SELECT doc_id, string_agg(before || after, '' ORDER BY step) AS p FROM steps GROUP BY 1),
f AS (SELECT doc_id, 0 AS step, bad AS h FROM d UNION ALL SELECT f.doc_id, f.step + 1, sha256(before || f.h || after) FROM f JOIN steps s ON s.doc_id = f.doc_id AND s.step = f.step),
ends AS (SELECT doc_id, max_by(h, step) AS folded_root FROM f GROUP BY 1)
SELECT d.doc_id, d.leaf, subs.subroot, u.h AS root, sha256(coalesce(p, '')) AS proof_sha256, folded_root, folded_root = u.h AS verified
FROM d JOIN subs ON subs.lang IS NOT DISTINCT FROM d.lang JOIN u ON u.n = 1 JOIN ends ON ends.doc_id = d.doc_id LEFT JOIN proofs ON proofs.doc_id = d.doc_id
"""

#: Hard negatives: the scores of all anchors with all rows, positives and then negatives ranked by window functions.
NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
 WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM s WHERE same) WHERE r <= 5)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM (
 SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
 FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score) WHERE rank <= 5
"""
