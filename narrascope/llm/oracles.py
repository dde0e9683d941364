"""SQL for the queries that it can express."""

EXACT_DEDUP = r"""
WITH normal AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
    FROM documents)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       sha256(body) AS text_sha256
FROM normal
WINDOW same AS (PARTITION BY body)
"""

LINE_DEDUP = r"""
WITH split AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents),
keyed AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
    FROM split),
held AS (
    SELECT line_key, max(doc_id) AS owner FROM keyed WHERE length(line_key) >= 20
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
    SELECT keyed.*, coalesce(doc_id <> owner, false) AS gone FROM keyed LEFT JOIN held USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

COLLOCATIONS = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents),
pieces AS (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
    FROM texts),
grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS ws
    FROM pieces, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k),
counted AS (
    SELECT lang, k, array_to_string(ws, ' ') AS phrase, any_value(ws) AS ws, count(*) AS f
    FROM grams GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT lang, k, phrase, ws, f AS a FROM counted WHERE k > 1),
cuts AS (
    SELECT lang, k, phrase, ws, a, unnest(range(1, k)) AS first_words FROM candidates),
scored AS (
    SELECT c.lang, c.phrase, c.a, first_words, x.f AS l, y.f AS r,
           (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
    FROM cuts c
    JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:first_words], ' ')
    JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[first_words + 1:], ' ')),
weakest AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, first_words) = 1),
inner_parts AS (
    SELECT lang, a, k, ws, m, unnest(range(1, k - m + 2)) AS i
    FROM candidates, (VALUES (2), (3)) AS lengths(m) WHERE m < k),
around AS (
    SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer
    FROM inner_parts GROUP BY ALL),
stay AS (
    SELECT weakest.* FROM weakest LEFT JOIN around USING (lang, phrase)
    WHERE longer IS NULL OR 100 * longer < 80 * a),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang)
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score
FROM stay JOIN totals USING (lang)
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER best <= 2000
"""
