"""DuckDB SQL for the queries that SQL can express."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op3_line_dedup"] = r"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
each_line AS (SELECT doc_id, unnest(lines) AS raw, generate_subscripts(lines, 1) AS pos FROM docs),
plain_lines AS (
  SELECT doc_id, pos, trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g')) AS plain FROM each_line),
lines AS (
  SELECT doc_id, pos, plain, line, len(string_split(line, ' ')) AS n,
         list_slice(string_split(line, ' '), 1, 3) AS lead_tokens
  FROM (SELECT *, regexp_replace(plain, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS line FROM plain_lines)
  WHERE line <> ''),
leaves AS (
  SELECT n, lead_tokens, count(DISTINCT doc_id) >= 3 AS wide, count(*) AS many_lines FROM lines
  GROUP BY n, lead_tokens HAVING count(DISTINCT doc_id) >= 2),
candidates AS (SELECT * FROM lines JOIN leaves USING (n, lead_tokens) WHERE wide OR n >= 10),
different AS (
  SELECT n, lead_tokens, line, many_lines, count(*) AS many FROM candidates WHERE wide GROUP BY ALL),
tokens AS (
  SELECT n, lead_tokens, line, many_lines, many, unnest(string_split(line, ' ')) AS token,
         generate_subscripts(string_split(line, ' '), 1) AS place
  FROM different),
constants AS (
  SELECT n, lead_tokens, place, token FROM tokens WHERE token <> '<*>'
  GROUP BY n, lead_tokens, place, token, many_lines
  HAVING sum(many) >= 3 AND sum(many) >= many_lines * 0.05),
shapes AS (
  SELECT t.n, t.lead_tokens, t.line,
         list({'place': t.place, 'token': c.token} ORDER BY t.place) FILTER (c.token IS NOT NULL) AS template,
         count(c.token) AS fixed,
         count(*) FILTER (t.place > 3) AS beyond,
         count(*) FILTER (t.place > 3 AND c.token IS NOT NULL) AS fixed_beyond
  FROM tokens t LEFT JOIN constants c
    ON t.n = c.n AND t.lead_tokens = c.lead_tokens AND t.place = c.place AND t.token = c.token
  GROUP BY ALL),
templated AS (
  SELECT * FROM shapes WHERE fixed > 0 AND fixed >= n * 0.5 AND fixed_beyond >= beyond * 0.5),
shaped AS (
  SELECT c.doc_id, c.pos, c.n, c.lead_tokens, c.plain, s.template
  FROM candidates c LEFT JOIN templated s
    ON c.n = s.n AND c.lead_tokens = s.lead_tokens AND c.line = s.line),
by_template AS (
  SELECT n, lead_tokens, template, min(doc_id) AS first_id FROM shaped WHERE template IS NOT NULL
  GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3),
by_text AS (
  SELECT plain, min(doc_id) AS first_id FROM shaped WHERE template IS NULL OR n >= 10
  GROUP BY plain, n HAVING count(DISTINCT doc_id) >= CASE WHEN n >= 10 THEN 2 ELSE 3 END),
gone AS (
  SELECT s.doc_id, s.pos FROM shaped s JOIN by_template r
    ON s.n = r.n AND s.lead_tokens = r.lead_tokens AND s.template = r.template
  WHERE s.doc_id <> r.first_id
  UNION
  SELECT s.doc_id, s.pos FROM shaped s JOIN by_text r ON s.plain = r.plain
  WHERE s.doc_id <> r.first_id AND (s.template IS NULL OR s.n >= 10)),
kept AS (
  SELECT e.doc_id, string_agg(e.raw, chr(10) ORDER BY e.pos) AS text
  FROM each_line e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(k.text, '') AS text, len(d.lines) AS n_lines,
       (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS n_dropped
FROM docs d LEFT JOIN kept k USING (doc_id)
"""

ORACLE_SQL["op7_quality_rules"] = r"""
WITH docs AS (
  SELECT doc_id, source, text, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
places AS (
  SELECT doc_id, generate_subscripts(words, 1) AS place, words FROM docs WHERE len(words) >= 8),
windows AS (
  SELECT doc_id, place, list_slice(words, place, place + 7) AS win
  FROM places WHERE place + 7 <= len(words)),
twice AS (
  SELECT w.doc_id, w.place FROM windows w JOIN (
    SELECT doc_id, win FROM windows GROUP BY ALL HAVING count(*) > 1) r USING (doc_id, win)),
covered AS (
  SELECT doc_id, count(DISTINCT place + step) AS n
  FROM twice CROSS JOIN range(8) AS steps(step) GROUP BY doc_id),
raw_lines AS (
  SELECT doc_id, source, text, unnest(string_split(body, chr(10))) AS raw FROM docs),
lines AS (
  SELECT doc_id, source, text, raw, len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS n,
         trim(regexp_replace(lower(raw), '[\x20\x09-\x0D]+', ' ', 'g')) AS line
  FROM raw_lines WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')),
repeats AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n FROM lines GROUP BY doc_id),
frequent AS (
  SELECT source, line, min(doc_id) AS first_id FROM lines
  GROUP BY source, line HAVING count(DISTINCT doc_id) > 20),
removed AS (
  SELECT l.doc_id, sum(l.n)::bigint AS n FROM lines l
  JOIN frequent f ON l.source = f.source AND l.line = f.line AND l.doc_id <> f.first_id
  GROUP BY l.doc_id),
counts AS (
  SELECT d.doc_id, len(d.words) AS n_words,
         length(regexp_replace(d.body, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(d.body) - length(regexp_replace(d.body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(r.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         coalesce(g.n, 0) AS removed_words
  FROM docs d LEFT JOIN repeats r USING (doc_id) LEFT JOIN covered c USING (doc_id)
  LEFT JOIN removed g USING (doc_id)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         removed_words > 0 AND (n_words - removed_words < 20
           OR n_words - removed_words < n_words * 0.2) AS depleted
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT depleted AS kept, removed_words
FROM judged
"""

ORACLE_SQL["op12_filter_audit"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
firsts AS (SELECT body, min(doc_id) AS first_id FROM docs GROUP BY body),
judged AS (
  SELECT part,
    CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 10 * length(body)
           THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS fails,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = docs.doc_id AND l.quality = 1) AS good,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = docs.doc_id AND l.toxic = 1) AS toxic
  FROM docs JOIN firsts USING (body)),
masks AS (SELECT part, fails, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a JOIN letters b ON b.bit <> a.bit
  JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
  JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit)
  JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
steps AS (
  SELECT filter_order, step::int AS step, bits[step] AS own,
         list_sum(list_slice(bits, 1, step))::int - bits[step] AS earlier
  FROM orders CROSS JOIN range(1, 6) AS of(step)),
counted AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER ((fails & (own + earlier)) = 0), 0)::bigint AS kept,
    coalesce(sum(n) FILTER ((fails & own) > 0 AND (fails & earlier) = 0), 0)::bigint AS removed,
    coalesce(sum(n) FILTER ((fails & own) > 0 AND (fails & earlier) > 0), 0)::bigint AS redundant,
    coalesce(sum(n) FILTER (fails = own), 0)::bigint AS unique_fails,
    coalesce(sum(n) FILTER ((fails & own) > 0 AND (fails & earlier) = 0 AND good), 0)::bigint AS good_lost,
    coalesce(sum(n) FILTER ((fails & own) > 0 AND (fails & earlier) = 0 AND toxic), 0)::bigint AS toxic_lost
  FROM masks CROSS JOIN steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::bigint AS shapley
FROM counted
"""

ORACLE_SQL["op13_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
each_term AS (SELECT row_id, lang, source, unnest(terms) AS term FROM docs),
words AS (
  SELECT lang, term, count(*) AS n FROM each_term GROUP BY ALL HAVING count(DISTINCT row_id) >= 30),
langs AS (
  SELECT lang, coalesce(n_terms, 0) AS n_terms, coalesce(total, 0) AS total
  FROM (SELECT DISTINCT lang FROM docs)
  LEFT JOIN (SELECT lang, count(*) AS n_terms, sum(n) AS total FROM words GROUP BY lang) USING (lang)),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM each_term JOIN words USING (lang, term) GROUP BY ALL),
totals AS (
  SELECT lang, source, coalesce(total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) USING (lang, source)),
shares AS (
  SELECT t.lang, t.source, w.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (t.total + 5 * l.n_terms) AS p,
         1 + (1000000000::hugeint * (w.n + 5)) // (l.total + 5 * l.n_terms) AS q
  FROM totals t JOIN langs l USING (lang) JOIN words w USING (lang)
  LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = w.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::bigint AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
telling AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q)::bigint AS value
  FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::int AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM telling))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""
