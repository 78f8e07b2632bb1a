"""DuckDB SQL of the queries that SQL can express; the others are tested by brute force."""

LINE_DEDUP = """
WITH lines AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS line, text IS NULL AS missing, text FROM documents
), windows AS (
    SELECT doc_id, p AS position, array_to_string(line[p + 1 : p + 3], chr(10)) AS content
    FROM (SELECT doc_id, line, unnest(range(len(line) - 2)) AS p FROM lines WHERE len(line) >= 3)
), later AS (
    SELECT doc_id, position FROM windows
    QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, position) > 1
), removed AS (
    SELECT DISTINCT doc_id, position + k AS position FROM later, (SELECT unnest(range(3)) AS k)
), gathered AS (
    SELECT doc_id, list(position) AS positions, count(*) AS n FROM removed GROUP BY doc_id
)
SELECT doc_id, CASE WHEN missing THEN 0 ELSE len(line) END AS n_lines, coalesce(n, 0) AS n_removed,
    CASE WHEN n IS NULL THEN text ELSE coalesce(array_to_string(
        [line[i + 1] FOR i IN range(len(line)) IF NOT list_contains(positions, i)], chr(10)), '') END AS text
FROM lines LEFT JOIN gathered USING (doc_id)
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""

FILTER_AUDIT = """
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS word FROM docs
), judged AS (
    SELECT doc_id, part, concat(
        CASE WHEN len(word) < 100 THEN 'A' END,
        CASE WHEN 100 * len(list_distinct(word)) < 80 * len(word) THEN 'B' END,
        CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' END,
        CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
        CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' END) AS fails
    FROM words
), marks AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), groups AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM judged LEFT JOIN marks USING (doc_id) GROUP BY part, fails
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, step, filter_order[step] AS x, filter_order[:step - 1] AS before
    FROM orders, (SELECT unnest(range(1, 6))::INT AS step)
), met AS (
    SELECT groups.*, filter_order, step, x, contains(fails, x) AS here,
        before <> '' AND regexp_matches(fails, '[' || before || '_]') AS earlier
    FROM groups, steps
), counted AS (
    SELECT part, filter_order, step, x,
        coalesce(sum(n) FILTER (NOT here AND NOT earlier), 0) AS kept,
        coalesce(sum(n) FILTER (here AND NOT earlier), 0) AS removed,
        coalesce(sum(n) FILTER (here AND earlier), 0) AS redundant,
        coalesce(sum(n) FILTER (fails = x), 0) AS unique_fails,
        coalesce(sum(good) FILTER (here AND NOT earlier), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (here AND NOT earlier), 0) AS toxic_lost
    FROM met GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM counted
"""

HARD_NEGATIVES = """
WITH given AS (
    SELECT vec_id, row_number() OVER () AS row, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        list_dot_product(a.v, b.v)::BIGINT AS score
    FROM given a JOIN given b ON a.vec_id % 100 = 0 AND a.row <> b.row
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS FIRST) AS place
    FROM scored WHERE same QUALIFY place <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
    (row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id NULLS FIRST))::INT AS rank,
    n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""

ORACLE = {
    "op7_line_dedup": LINE_DEDUP,
    "op8_exact_dedup": EXACT_DEDUP,
    "op11_filter_audit": FILTER_AUDIT,
    "op13_hard_negatives": HARD_NEGATIVES,
}
