"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_OP7 = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, p, w[p : p + 19] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
again AS (SELECT doc_id, p FROM win QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q, TRUE AS out FROM again),
each AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS q FROM d),
left_over AS (SELECT doc_id, count(out) AS n_removed, string_agg(x, ' ' ORDER BY q) FILTER (out IS NULL) AS kept FROM each LEFT JOIN gone USING (doc_id, q) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)
"""

_OP9 = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), {_LOWER}) AS key FROM l),
many AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
f AS (SELECT k.*, many.last IS NOT NULL AND k.doc_id IS DISTINCT FROM many.last AS gone FROM k LEFT JOIN many USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

_OP10 = rf"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT item_id, w[p : p + least(10, len(w)) - 1] AS g FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(g) AS n FROM win),
dg AS (SELECT doc_id, p, n, w[p : p + n - 1] AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM dw, sizes WHERE len(w) >= n)),
met AS (SELECT DISTINCT doc_id, p, n, item_id FROM dg JOIN win USING (g)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM met) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM met) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

_OP4 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 5
"""

_OP1 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
-- the marks of a turn, and one backslash for each control string in a text
f AS (SELECT *, length(text) + len(regexp_extract_all(text, '<\\*s>|<\\*/s>|\[\\*(SYS|/SYS|INST|/INST|ANS|ROLE|/ROLE)\]'))
             + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 22 WHEN 'assistant' THEN 13 ELSE 20 + length(role) END AS chars,
             coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), 'start') || '>' || role IN
             ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user') AS ok FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, bool_and(ok) AS in_order
FROM f GROUP BY conv_id
"""

_OP11 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, p, h[2 * p + 1 : 2 * p + 100] AS g FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS p FROM d WHERE length(h) >= 100)),
again AS (SELECT doc_id, p FROM win QUALIFY doc_id > min(doc_id) OVER (PARTITION BY g)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM again),
edge AS (SELECT *, q - 1 IS DISTINCT FROM lag(q) OVER (PARTITION BY doc_id ORDER BY q) AS opens FROM gone),
run AS (SELECT doc_id, min(q) AS a, max(q) + 1 AS b FROM (SELECT doc_id, q, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY q) AS r FROM edge) GROUP BY doc_id, r),
cut AS (SELECT doc_id, h, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM run JOIN d USING (doc_id)),
left_over AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(h[2 * since + 1 : 2 * a], '' ORDER BY a) || any_value(h)[2 * max(b) + 1 :] AS kept FROM cut GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)
"""

_OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), {_LOWER}) AS t FROM documents),
w AS (SELECT doc, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT g.lang, g.source, k.term, v, CAST(coalesce(c.n, 0) AS HUGEINT) AS n FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, 1 + 1000000000 * (n + 1) // CAST(sum(n) OVER (PARTITION BY lang, source) + v AS HUGEINT) AS p FROM n),
l AS (SELECT lang, term, 1 + 1000000000 * (n + 1) // CAST(sum(n) OVER (PARTITION BY lang) + v AS HUGEINT) AS q
      FROM (SELECT lang, term, any_value(v) AS v, CAST(sum(n) AS HUGEINT) AS n FROM n GROUP BY lang, term)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200
"""

_OP13 = r"""
WITH RECURSIVE enc AS (SELECT doc_id, lang, n_chars,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents),
-- crc32, byte by byte through the table of its polynomial
steps AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
          FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))),
c AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS crc FROM enc, steps),
d AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
             CASE WHEN crc % 7 = 0 THEN sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS changed FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
tree AS (SELECT lang, 0 AS lvl, list(leaf ORDER BY pos) AS l FROM r GROUP BY lang
         UNION ALL SELECT lang, lvl + 1, list_transform(range(0, len(l), 2), lambda i: sha256(l[i + 1] || coalesce(l[i + 2], ''))) FROM tree WHERE len(l) > 1),
sub AS (SELECT lang, l[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM tree WHERE len(l) = 1),
top AS (SELECT 0 AS lvl, list(subroot ORDER BY pos) AS l FROM sub
        UNION ALL SELECT lvl + 1, list_transform(range(0, len(l), 2), lambda i: sha256(l[i + 1] || coalesce(l[i + 2], ''))) FROM top WHERE len(l) > 1),
up AS (SELECT r.doc_id, r.lang, r.pos, lvl, (r.pos >> lvl) & 1 AS side, l[xor(r.pos >> lvl, 1) + 1] AS sib FROM r JOIN tree ON r.lang IS NOT DISTINCT FROM tree.lang AND len(l) > 1
       UNION ALL SELECT r.doc_id, r.lang, r.pos, 1000 + lvl, (sub.pos >> lvl) & 1, l[xor(sub.pos >> lvl, 1) + 1] FROM r JOIN sub ON r.lang IS NOT DISTINCT FROM sub.lang JOIN top ON len(l) > 1),
p AS (SELECT lang, pos, coalesce(string_agg(sib, '' ORDER BY lvl), '') AS proof, list(CASE WHEN sib IS NULL THEN 'N' WHEN side = 1 THEN 'L' || sib ELSE 'R' || sib END ORDER BY lvl) AS path FROM up GROUP BY lang, pos),
f AS (SELECT r.doc_id, leaf, subroot, (SELECT l[1] FROM top WHERE len(l) = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
             list_reduce(list_prepend(coalesce(changed, leaf), coalesce(path, [])), lambda a, x: sha256(CASE x[1] WHEN 'L' THEN x[2:] || a WHEN 'R' THEN a || x[2:] ELSE a END)) AS folded_root
      FROM r JOIN sub ON r.lang IS NOT DISTINCT FROM sub.lang LEFT JOIN p ON r.lang IS NOT DISTINCT FROM p.lang AND r.pos = p.pos)
SELECT *, folded_root = root AS verified FROM f
"""

ORACLE_SQL: dict[str, str] = {"op1_chat_format": _OP1, "op4_topk": _OP4, "op7_substring_dedup": _OP7, "op9_line_dedup": _OP9, "op10_decontaminate": _OP10, "op11_suffix_dedup": _OP11, "op12_divergence": _OP12, "op13_merkle": _OP13}
