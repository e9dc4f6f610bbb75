"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN
         [array_to_string(words, ' ')] ELSE list_transform(range(1, len(words) - 1),
         lambda i: array_to_string(words[i:i + 2], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE 100 * least(na.n, nb.n) >= 90 * greatest(na.n, nb.n)
  GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y
  WHERE 100 * n_both >= 90 * (na.n + nb.n - n_both)),
sym AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM w
  UNION
  SELECT reach.x, sym.y FROM reach JOIN sym ON sym.x = reach.y)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c USING (doc_id)
"""

FILTER_AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, doc_id > min(doc_id) OVER (PARTITION BY t) AS e FROM d),
x AS (
  SELECT f.*, coalesce(l.good, 0) AS good, coalesce(l.bad, 0) AS bad FROM f LEFT JOIN (
    SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS bad
    FROM labels GROUP BY doc_id) l USING (doc_id)),
u AS (
  SELECT part, good, bad, [a, b, c, d, e] AS failed,
         CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) + CAST(e AS INT) AS k,
         count(*) AS n FROM x GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT filter_order, step, instr('ABCDE', substr(filter_order, step, 1)) AS own,
         list_transform(range(1, step), lambda i: instr('ABCDE', substr(filter_order, i, 1))) AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (
  SELECT part, filter_order, step, n, good, bad, k, failed[own] AS fails,
         len(list_filter(before, lambda i: failed[i])) > 0 AS gone FROM u, s)
SELECT part, filter_order, CAST(step AS INT) AS step,
       CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (gone AND fails), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (fails AND k = 1), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(n * good) FILTER (NOT gone AND fails), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(n * bad) FILTER (NOT gone AND fails), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(n * 120 // greatest(k, 1)) FILTER (fails), 0) AS BIGINT) AS shapley
FROM r GROUP BY part, filter_order, step
"""

COLLOCATION = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
s AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  FROM w),
f AS (SELECT lang, k, phrase, count(*) AS f FROM s GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 10),
o AS (
  SELECT lang, phrase, a, k, w, unnest(range(1, k)) AS cut FROM c),
x AS (
  SELECT o.lang, o.phrase, o.a, cut, l.f AS l, r.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * o.a * o.a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM o JOIN f l ON l.lang = o.lang AND l.phrase = array_to_string(w[:cut], ' ')
  JOIN f r ON r.lang = o.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
y AS (
  SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a AS f FROM c WHERE k = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE k = 3) GROUP BY ALL)
SELECT y.lang, row_number() OVER (PARTITION BY y.lang ORDER BY score DESC, a DESC, y.phrase) AS rank,
       y.phrase, a, l, r, n, score
FROM y JOIN n ON n.lang = y.lang LEFT JOIN i ON i.lang = y.lang AND i.phrase = y.phrase
WHERE coalesce(100 * i.longer < 50 * a, TRUE)
QUALIFY row_number() OVER (PARTITION BY y.lang ORDER BY score DESC, a DESC, y.phrase) <= 2000
"""

# Escaping adds a character for each backslash and each start of a control string; of control strings that start
# alike the shortest is counted.  A turn's marks have 25 characters.
_ADDED = " + ".join(f"(length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)}" for c in (
    "\\", "<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))

CHAT = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL
  SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
c AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(25 + length(role) + length(text) + {_ADDED.format("role")} + {_ADDED.format("text")}) AS chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM c
"""
