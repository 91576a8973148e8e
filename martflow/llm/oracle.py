"""SQL for the corpus queries that SQL can express on whole tables.

The others are not expressible in SQL alone, or not fast enough; tests/llm holds them against
brute force, exact round trips or held-out accuracy.
"""

from __future__ import annotations

OP11 = r"""
WITH words AS (
    SELECT doc_id, source, coalesce(text, '') AS value,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), windows AS (
    SELECT doc_id, spot, [words[spot], words[spot + 1], words[spot + 2]] AS three
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS spot FROM words)
), repeated AS (
    SELECT doc_id, spot FROM windows
    QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1
), reached AS (
    SELECT doc_id, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT doc_id, unnest([spot, spot + 1, spot + 2]) AS place FROM repeated)
    GROUP BY doc_id
), lined AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(value, chr(10))) AS line FROM words)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    GROUP BY doc_id
), counts AS (
    SELECT w.doc_id, source AS host, len(words) AS n_words,
           coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
           length(value) - length(translate(value, '#*$%&|<>', '')) AS n_symbols,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM words w LEFT JOIN reached USING (doc_id) LEFT JOIN lined USING (doc_id)
), failures AS (
    SELECT doc_id, host, rule, failed
    FROM (SELECT doc_id, host,
                 unnest(['few_words', 'repeated_words', 'symbols', 'word_length', 'repeated_lines']) AS rule,
                 unnest([n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words,
                         word_chars < 3 * n_words OR word_chars > 12 * n_words,
                         100 * n_dup_lines > 30 * n_lines]) AS failed
          FROM counts)
), hosts AS (
    SELECT host, rule, count(*)::DOUBLE AS n, count_if(failed)::DOUBLE AS f
    FROM failures WHERE host IS NOT NULL GROUP BY ALL
), sums AS (
    SELECT rule, count(*) AS k, sum(n) AS n, sum(n * n) AS n2, sum(f) AS f, sum(f * f / n) AS q,
           sum(f) / sum(n) AS m
    FROM hosts GROUP BY rule
), spread AS (
    SELECT rule, m, CASE WHEN n > n2 / n THEN (q - f * f / n - (k - 1) * m * (1 - m)) / (n - n2 / n) ELSE 0 END AS v
    FROM sums
), priors AS (
    SELECT rule, m, CASE WHEN v <= 0 THEN 1e6 ELSE least(greatest(m * (1 - m) / v - 1, 10), 1e6) END AS s
    FROM spread
), condemned AS (
    SELECT DISTINCT host FROM hosts JOIN priors USING (rule) WHERE (f + s * m) / (n + s) > 0.5
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
           AND coalesce(host NOT IN (SELECT host FROM condemned), true) AS kept
FROM counts
"""

OP13 = r"""
WITH doc_terms AS (
    SELECT row, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
), item_terms AS (
    SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
), sizes AS (
    SELECT row, doc_id, count(*) AS n FROM doc_terms GROUP BY row, doc_id
), corpus AS (
    SELECT count(*) AS documents, sum(n)::BIGINT AS terms FROM sizes
), postings AS (
    SELECT row, term, count(*) AS tf FROM doc_terms GROUP BY row, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM postings, corpus GROUP BY term, documents
), scores AS (
    SELECT item_id, row, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * documents) // terms))))::BIGINT AS score
    FROM item_terms JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (row), corpus
    GROUP BY item_id, row, doc_id
), placed AS (
    SELECT item_id, doc_id, score,
           row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS place
    FROM scores WHERE score > 0
)
SELECT item_id, place::INT AS rank, doc_id, score FROM placed WHERE place <= 10
"""

ORACLE: dict[str, str] = {"op11_host_rules": OP11, "op13_ranked_search": OP13}
