"""Comparison SQL of the training-data queries that SQL can express.

None for token ids, checksums and language models, fuzzy lines, template slots and seeded
shuffles: the tests compare those with plain Python.
"""

WORDS = r"[\x20\x09-\x0D]+"
AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
MARKS = r"^[ \t]*(?:>[ \t]*)+"

QUOTES = rf"""
WITH RECURSIVE ls AS (
  SELECT conv_id, turn, string_split(text, chr(10)) AS a FROM conversations WHERE text IS NOT NULL
), l AS (
  SELECT conv_id, turn, i, a[i] AS line,
         length(regexp_replace(regexp_extract(a[i], '{MARKS}'), '[^>]', '', 'g')) AS lv
  FROM ls, unnest(range(1, len(a) + 1)) AS t(i)
), m AS (
  SELECT *, lead(lv) OVER w AS nxt,
         lag(lv) OVER w IS NULL OR lag(lv) OVER w <> lv OR trim(line) = '' OR trim(lag(line) OVER w) = '' AS new
  FROM l WINDOW w AS (PARTITION BY conv_id, turn ORDER BY i)
), r AS (
  SELECT *, sum(new::INT) OVER (PARTITION BY conv_id, turn ORDER BY i) AS run,
         regexp_replace(line, '{MARKS}', '') AS bare FROM m
), raw AS (
  SELECT conv_id, turn, lv, string_agg(bare, chr(10) ORDER BY i) AS t FROM r GROUP BY conv_id, turn, lv, run
  UNION ALL SELECT conv_id, turn, lv, bare FROM r
), p AS (
  SELECT conv_id, turn, lv, trim(regexp_replace(lower(t), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS t FROM raw
), first AS (
  SELECT conv_id, t, min(turn) AS origin FROM p WHERE lv = 0 AND t <> '' GROUP BY 1, 2
), best AS (
  SELECT conv_id, turn, origin AS parent FROM (
    SELECT p.conv_id, p.turn, origin,
           row_number() OVER (PARTITION BY p.conv_id, p.turn ORDER BY lv, origin DESC) AS k
    FROM p JOIN first USING (conv_id, t) WHERE lv > 0 AND origin < p.turn)
  WHERE k = 1
), own AS (
  SELECT conv_id, turn, string_agg(line, chr(10) ORDER BY i) FILTER (
           lv = 0 AND NOT (coalesce(nxt, 0) > 0 AND regexp_matches(
             line, '(?i)^[ \t]*(?:on|am|le|el)\b.*\b(?:wrote|schrieb|a écrit|escribió)\b.*:[ \t]*$'))) AS text
  FROM r GROUP BY 1, 2
), up AS (
  SELECT c.conv_id, c.turn, c.turn AS root, 0 AS steps FROM conversations c ANTI JOIN best USING (conv_id, turn)
  UNION ALL
  SELECT b.conv_id, b.turn, up.root, up.steps + 1 FROM best b JOIN up ON up.conv_id = b.conv_id AND up.turn = b.parent
)
SELECT c.conv_id, c.turn, c.role, CASE WHEN c.text IS NOT NULL THEN coalesce(own.text, '') END AS text,
       best.parent AS parent_turn, up.root AS root_turn, up.steps::BIGINT AS reply_depth,
       row_number() OVER (PARTITION BY c.conv_id ORDER BY up.root, c.turn) - 1 AS seq
FROM conversations c JOIN up USING (conv_id, turn)
LEFT JOIN best USING (conv_id, turn) LEFT JOIN own USING (conv_id, turn)
"""

QUALITY = rf"""
WITH t AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '{WORDS}'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS i,
         unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS gram
  FROM t
), twice AS (
  SELECT doc_id, unnest(list(i)) AS i FROM g GROUP BY doc_id, gram HAVING count(*) > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 5)) AS u(k) GROUP BY 1
), c AS (
  SELECT doc_id, lang, source, len(w) AS n_words, len(l) AS n_lines,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM t LEFT JOIN rep USING (doc_id)
), m AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, [
    {{'rate': 'symbol', 'v': CASE WHEN n_words = 0 THEN 0 ELSE 1000 * n_symbols // n_words END}},
    {{'rate': 'line', 'v': CASE WHEN n_lines = 0 THEN 0 ELSE 1000 * n_dup_lines // n_lines END}},
    {{'rate': 'repeat', 'v': CASE WHEN n_words = 0 THEN 0 ELSE 1000 * n_repeat_words // n_words END}},
    {{'rate': 'word', 'v': CASE WHEN n_words = 0 THEN 0 ELSE 100 * word_chars // n_words END}}] AS rates
  FROM c
), v AS (
  SELECT doc_id, lang, source, base_failed, r.rate AS rate, r.v AS v,
         (r.v >> greatest(length(bin(r.v)) - 5, 0)) << greatest(length(bin(r.v)) - 5, 0) AS low
  FROM (SELECT doc_id, lang, source, base_failed, unnest(rates) AS r FROM m)
), q AS (
  SELECT lang, source, rate, low, 1000000 * count(*) AS n FROM v WHERE NOT base_failed GROUP BY 1, 2, 3, 4
), ql AS (
  SELECT lang, rate, low, count(*) AS n, sum(count(*)) OVER (PARTITION BY lang, rate) AS total
  FROM v WHERE NOT base_failed GROUP BY 1, 2, 3
), blend AS (
  SELECT lang, source, rate, low, n FROM q
  UNION ALL
  SELECT g.lang, g.source, g.rate, ql.low, 25 * 1000000 * ql.n // ql.total
  FROM (SELECT DISTINCT lang, source, rate FROM q) g JOIN ql ON g.rate = ql.rate AND g.lang IS NOT DISTINCT FROM ql.lang
), run AS (
  SELECT lang, source, rate, low,
         sum(sum(n)) OVER (PARTITION BY lang, source, rate ORDER BY low) AS upto,
         sum(sum(n)) OVER (PARTITION BY lang, source, rate) AS docs
  FROM blend GROUP BY 1, 2, 3, 4
), lim AS (
  SELECT lang, source, rate, min(low) FILTER (4 * upto >= docs) AS q1, min(low) FILTER (4 * upto >= 3 * docs) AS q3
  FROM run GROUP BY 1, 2, 3
), ok AS (
  SELECT doc_id, bool_and(
    v <= q3 + 4 * greatest(q3 - q1, CASE lim.rate WHEN 'symbol' THEN 25 WHEN 'line' THEN 50 WHEN 'repeat' THEN 20 ELSE 100 END)
    AND (lim.rate <> 'word' OR v >= q1 - 4 * greatest(q3 - q1, 50))) AS fits
  FROM v JOIN lim ON v.rate = lim.rate AND v.lang IS NOT DISTINCT FROM lim.lang AND v.source IS NOT DISTINCT FROM lim.source
  GROUP BY 1
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       base_failed, NOT base_failed AND coalesce(fits, TRUE) AS kept
FROM m LEFT JOIN ok USING (doc_id)
"""

NEAR_DUP = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {AZ}), '{WORDS}'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS g
  FROM t
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), u AS (
  SELECT a, b FROM e UNION SELECT b, a FROM e
), r AS (
  SELECT doc_id, doc_id AS c FROM documents UNION SELECT u.a, r.c FROM r JOIN u ON u.b = r.doc_id
)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c AS component_id, doc_id = c AS kept
FROM (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)
"""

URLS = rf"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {AZ}) AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(h, p, verdict) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
         ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), fit AS (
  SELECT page_id, h || rules.p AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || rules.p) DESC, length(h) DESC, verdict DESC) AS k
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, rules.p)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM fit WHERE k = 1) USING (page_id)
"""

ORACLE: dict[str, str] = {
    "op2_quotes": QUOTES,
    "op4_quality": QUALITY,
    "op7_near_dup": NEAR_DUP,
    "op8_urls": URLS,
}
