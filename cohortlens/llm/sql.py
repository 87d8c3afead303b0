"""DuckDB SQL for the queries that SQL can express."""

# -- quality rules: words and windows as rows, one aggregation per document --
QUALITY_LEDGER = r"""
w AS (
    SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
    FROM (SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws
          FROM {docs})
),
tri AS (
    SELECT doc_id, i, word, lag(word) OVER o AS before,
           lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3
    FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
twice AS (
    SELECT doc_id, i FROM tri WHERE w3 IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY doc_id, word, w2, w3) > 1
),
covered AS (
    SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words
    FROM twice, (VALUES (0), (1), (2)) AS t(d) GROUP BY doc_id
),
words AS (
    SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars,
           count(*) FILTER (WHERE word = before) AS n_stutters
    FROM tri GROUP BY doc_id
),
lines AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM {docs})
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
measured AS (
    SELECT d.doc_id,
           CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
           CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
           CAST(coalesce(n_stutters, 0) AS BIGINT) AS n_stutters,
           CAST(length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
           CAST(length(regexp_replace(coalesce(text, ''), '[^!]', '', 'g')) AS BIGINT) AS n_exclamations
    FROM {docs} d LEFT JOIN words USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
),
ledger AS (
    SELECT *, CAST(
        (CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
        + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
        + (CASE WHEN 10 * n_capitals > 4 * word_chars THEN 16 ELSE 0 END)
        + (CASE WHEN 10 * n_exclamations > 3 * n_words THEN 32 ELSE 0 END)
        + (CASE WHEN 10 * n_stutters > 3 * n_words THEN 64 ELSE 0 END) AS BIGINT) AS failure_bits
    FROM measured
)"""

ORACLE_SQL = {
    "op9_quality_rules": "WITH " + QUALITY_LEDGER.format(docs="documents") + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failure_bits & 3) <> 0 AS base_failed, failure_bits = 0 AS kept, failure_bits
FROM ledger""",
    "op6_url_rules": r"""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
    FROM pages
),
parts AS (
    SELECT page_id, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
),
rules(verdict, host, path) AS (VALUES
    ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')
),
fits AS (
    SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
           arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM parts p JOIN rules r
      ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.page_id
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f USING (page_id)""",
    "op12_ranked_search": r"""
WITH terms AS (
    SELECT doc_id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term <> '' GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, total GROUP BY term
),
postings AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms)))) AS v
    FROM tf JOIN lengths USING (doc_id) JOIN weights USING (term), total
),
items AS (
    SELECT item_id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
),
scores AS (
    SELECT item_id, doc_id, CAST(sum(v) AS BIGINT) AS score FROM items JOIN postings USING (term) GROUP BY ALL
),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 20""",
}
