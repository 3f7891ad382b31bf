"""DuckDB SQL for the corpus queries that SQL can express."""

from . import line_rules
from .mixing import WORD

OP5_LINE_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
e AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
p AS (SELECT r, i, concat_ws(' ', word, {', '.join(f'lead(word, {k}) OVER o' for k in range(1, 8))}) AS run, lead(i, 7) OVER o AS whole FROM e WINDOW o AS (PARTITION BY r ORDER BY i)),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM p WHERE whole IS NOT NULL),
s AS (SELECT r, least(8, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i), 8)) AS fresh FROM g WHERE n > 1),
c AS (SELECT r, sum(fresh)::BIGINT AS covered FROM s GROUP BY r),
x AS (SELECT r, l, len(regexp_extract_all(l, '{WORD}')) AS n, len(regexp_extract_all(l, '!!')) AS shouted, len(regexp_extract_all(l, '{line_rules.SYMBOLS}')) AS symbols, len(regexp_extract_all(l, '{line_rules.SEPARATORS}')) AS seps FROM w, unnest(ls) AS u(l)),
f AS (SELECT r, n FROM x WHERE regexp_matches(l, '{line_rules.BOILERPLATE}') OR (shouted >= 3 AND shouted >= 0.3 * n) OR (symbols >= 3 AND symbols >= 0.5 * n) OR (seps >= 2 AND seps >= 0.25 * n)
  OR (n >= 20 AND NOT regexp_matches(l, '[.!?…:;。]')) OR (n >= 6 AND len(list_distinct(regexp_extract_all(l, '{WORD}'))) < 0.4 * n)),
k AS (SELECT r, count(*) AS lines, sum(n)::BIGINT AS words FROM f GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, '{line_rules.SYMBOLS}'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(covered, 0) AS n_repeat_words, coalesce(lines, 0) AS n_lines_removed, coalesce(words, 0) AS n_words_removed FROM w LEFT JOIN c USING (r) LEFT JOIN k USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words_removed <= 0.5 * n_words AS kept, n_lines_removed, n_words_removed FROM m"""


OP9_NEAR_DEDUP = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
l AS (SELECT a, b FROM p JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other),
m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, component_id = doc_id AS kept FROM d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)"""
