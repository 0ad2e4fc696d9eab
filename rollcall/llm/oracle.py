"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

from __future__ import annotations

QUALITY_RULES = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
    SELECT r, doc_id, text,
        regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), grams AS (
    SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM parts WHERE len(w) >= 3
), windows AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM grams
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words
    FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r
), measured AS (
    SELECT doc_id, len(w) AS n_words, len(lines) AS n_lines,
        len(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        len(list_distinct(w)) AS n_different,
        len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter
    FROM parts LEFT JOIN covered USING (r)
), failing AS (
    SELECT *, n_words < 50 AS f0, 100 * n_repeat_words > 50 * n_words AS f1,
        word_chars < 2 * n_words AS f2, word_chars > 20 * n_words AS f3, 10 * n_symbols > n_words AS f4,
        10 * n_dup_lines > 3 * n_lines AS f5, 5 * n_letter < 2 * n_words AS f6,
        10 * n_different < n_words AND n_words >= 50 AND n_different < 20 AS f7
    FROM measured
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
    f0 OR f1 AS base_failed,
    NOT (f0 OR f1 OR f4 OR f6 OR f7) AND f2::INT + f3::INT + f5::INT <= 1 AS kept,
    (f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT + 32 * f5::INT + 64 * f6::INT
        + 128 * f7::INT)::BIGINT AS failed
FROM failing
"""

WARC = r"""
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS p FROM pages
), named AS (
    SELECT page_id, octet_length(p) AS n, sha1(p) AS digest FROM payloads
), kept AS (
    SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS keeper FROM named
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
    CASE WHEN page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to,
    NULL::VARCHAR AS problem
FROM kept
"""

DECONTAMINATION = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), items AS (
    SELECT row_number() OVER () AS q, item_id,
        regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark
), doc_shingles AS (
    SELECT r, doc_id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) AS s
    FROM docs
), item_shingles AS (
    SELECT q, item_id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) AS s
    FROM items
), sizes AS (
    SELECT q, count(*) AS n FROM item_shingles GROUP BY q
), found AS (
    SELECT r, doc_id, q, item_id, count(*) AS n_found
    FROM doc_shingles JOIN item_shingles USING (s) GROUP BY ALL
)
SELECT doc_id, item_id, n::BIGINT AS n_shingles, n_found::BIGINT AS n_found, n_found / n AS containment
FROM found JOIN sizes USING (q) WHERE 100 * n_found >= 80 * n
"""

RANKED_SEARCH = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
    SELECT row_number() OVER () AS q, item_id, unnest(list_distinct(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t FROM benchmark
), totals AS (
    SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM docs
), held AS (
    SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs)
    WHERE t IN (SELECT t FROM items) GROUP BY r, t
), weights AS (
    SELECT t, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM held, totals GROUP BY t, n
), lengths AS (
    SELECT r, doc_id, 100 - 50 + (50 * len(w) * n) // l AS m FROM docs, totals WHERE len(w) > 0
), scored AS (
    SELECT q, item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM items JOIN held USING (t) JOIN weights USING (t) JOIN lengths USING (r) GROUP BY q, item_id, r, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""

LINE_DEDUP = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
    SELECT r, doc_id, unnest(l) AS line, unnest(range(len(l))) AS place FROM docs
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), shared AS (
    SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 20
    GROUP BY k HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= 3
), marked AS (
    SELECT r, doc_id, line, place, shared.k IS NOT NULL AND doc_id IS DISTINCT FROM keep AS lost
    FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (lost)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": QUALITY_RULES,
    "op3_warc": WARC,
    "op10_decontamination": DECONTAMINATION,
    "op11_ranked_search": RANKED_SEARCH,
    "op13_line_dedup": LINE_DEDUP,
}
