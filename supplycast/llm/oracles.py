"""SQL counterparts of the training-data queries that SQL can express.

The others rest on byte-level hashing, fitted models, components or archive files; their tests compare
them with brute force, exact round trips or held-out accuracy.
"""

from __future__ import annotations

from supplycast.llm import mixing

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# A template stands on more than a hundredth of a site's distinct texts, at least five of them, also
# without the pages that frequent lines make up for more than half.
_LINE_DEDUP = f"""
WITH pages AS (
    SELECT source, body, string_split(body, chr(10)) AS parts
    FROM (SELECT DISTINCT source, coalesce(text, '') AS body FROM documents)
), totals AS (
    SELECT source, count(*) AS n FROM pages GROUP BY source
), lines AS (
    SELECT source, body, unnest(list_distinct(list_filter(parts, lambda x: trim(x, {_BLANK}) <> '')))
        AS line
    FROM pages
), often AS (
    SELECT l.source, list(line) AS known FROM (
        SELECT source, line, count(*) AS having_it FROM lines GROUP BY source, line
    ) l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
    WHERE having_it >= 5 AND having_it > 1e-2 * n GROUP BY l.source
), own AS (
    SELECT p.source, body FROM pages p JOIN often o ON p.source IS NOT DISTINCT FROM o.source
    WHERE list_sum(list_transform(parts, lambda x: CASE WHEN list_contains(known, x) THEN strlen(x)
            ELSE 0 END)) <= 5e-1 * list_sum(list_transform(parts, lambda x: strlen(x)))
), bad AS (
    SELECT l.source, list(line) AS bad FROM (
        SELECT l.source, line, count(*) AS having_it
        FROM lines l JOIN own o ON l.source IS NOT DISTINCT FROM o.source AND l.body = o.body
        GROUP BY l.source, line
    ) l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
    WHERE having_it >= 5 AND having_it > 1e-2 * n GROUP BY l.source
), kept AS (
    SELECT d.doc_id, d.source, d.text, bad,
        string_split(d.text, chr(10)) AS parts,
        list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(bad, x)) AS good
    FROM documents d LEFT JOIN bad b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, source,
    CASE WHEN bad IS NULL OR text IS NULL THEN 0 ELSE len(parts) - len(good) END AS n_dropped,
    CASE WHEN bad IS NULL OR text IS NULL THEN text ELSE array_to_string(good, chr(10)) END AS text
FROM kept
"""

_MIXING = f"""
WITH sized AS (
    SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size
    FROM documents
), sums AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), placed AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sums
), weighed AS (
    SELECT *, CAST({list(mixing.WEIGHTS)}[1 + (place - 1) % {len(mixing.WEIGHTS)}] AS BIGINT) AS weight
    FROM placed
), ranked AS (
    SELECT *,
        CAST(coalesce(sum({mixing.MOST_COPIES} * source_size) OVER tight, 0) AS BIGINT) AS capped,
        CAST(sum(source_size) OVER () AS BIGINT) AS total,
        CAST(sum(weight) OVER () - coalesce(sum(weight) OVER tight, 0) AS BIGINT) AS left_weight
    FROM weighed
    WINDOW tight AS (ORDER BY CAST(source_size AS DOUBLE) / weight, place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT total - capped AS left_size, left_weight FROM ranked
    WHERE (total - capped) * weight <= {mixing.MOST_COPIES} * source_size * left_weight
    ORDER BY capped, total - capped, left_weight LIMIT 1
), goals AS (
    SELECT source, source_size, least(
        CAST(left_size * weight AS DOUBLE) / l.left_weight,
        CAST({mixing.MOST_COPIES} * source_size AS DOUBLE)) AS target,
        CAST(CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(source, chr(0) || 'null')), 1, 8)
            AS BIGINT) AS DOUBLE) / 4294967296.0 AS start
    FROM ranked, level l
), numbered AS (
    SELECT doc_id, source, size, row_number() OVER (
        PARTITION BY source
        ORDER BY CAST(floor(ln(size + 1.0) * 12) AS INTEGER),
            substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, {mixing.PART_DIGITS}),
            size, doc_id) AS place
    FROM sized
)
SELECT doc_id, size, n.source_size, target,
    CAST(copies * size AS BIGINT) AS taken, copies
FROM (
    SELECT d.doc_id, d.size, g.source_size, g.target, CAST(
        floor(g.start + d.place * (g.target / g.source_size))
        - floor(g.start + (d.place - 1) * (g.target / g.source_size)) AS BIGINT) AS copies
    FROM numbered d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
) n
"""

_HARD_NEGATIVES = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        CAST(list_inner_product(a.parts, b.parts) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (
        PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM scored JOIN positive USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (
    PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""


ORACLES = {
    "op6_line_dedup": _LINE_DEDUP,
    "op9_mixing": _MIXING,
    "op13_hard_negatives": _HARD_NEGATIVES,
}
