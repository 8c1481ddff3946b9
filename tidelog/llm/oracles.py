"""The same results in SQL, where SQL can express them."""

from __future__ import annotations

_NORMAL = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

_EXACT_DEDUP = f"""
WITH normal AS (SELECT doc_id, {_NORMAL} AS content FROM documents),
marked AS (
    SELECT doc_id, content, max(doc_id) OVER (PARTITION BY content) AS keep_id,
           count(*) OVER (PARTITION BY content) AS group_size
    FROM normal
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(content) AS text_sha256
FROM marked
"""

_MIX = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS hash
    FROM documents
), classed AS (
    SELECT *, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)) AS class FROM sized
), per_source AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM per_source
), ratios AS (
    SELECT *, CAST(source_size * 3 AS DOUBLE) / weight AS ratio, sum(source_size) OVER () AS total,
           sum(weight) OVER () AS all_weight
    FROM weighed
), caps AS (
    SELECT *, sum(source_size * 3) OVER upto + ratio * (all_weight - sum(weight) OVER upto) <= total AS capped
    FROM ratios WINDOW upto AS (ORDER BY ratio RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), levels AS (
    SELECT *, CAST(total - sum(CASE WHEN capped THEN source_size * 3 ELSE 0 END) OVER () AS DOUBLE)
           / CAST(nullif(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 0) AS DOUBLE) AS level
    FROM caps
), targets AS (
    SELECT source, source_size, CASE WHEN capped THEN CAST(source_size * 3 AS DOUBLE) ELSE level * weight END AS target
    FROM levels
), units AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 4294967296.0) AS BIGINT) ELSE 0 END AS unit,
           CAST('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 8) AS BIGINT) AS start
    FROM targets
), ranked AS (
    SELECT c.doc_id, c.size, u.source_size, u.target, u.unit, u.start,
           CAST(row_number() OVER (PARTITION BY c.source ORDER BY c.class, c.hash, c.doc_id, c.size) AS HUGEINT) AS rank
    FROM classed c JOIN units u ON c.source IS NOT DISTINCT FROM u.source
)
SELECT doc_id, size, source_size, target,
       CAST((start + rank * unit) // 4294967296 - (start + (rank - 1) * unit) // 4294967296 AS BIGINT) AS copies,
       CAST(((start + rank * unit) // 4294967296 - (start + (rank - 1) * unit) // 4294967296) * size AS BIGINT) AS taken
FROM ranked
"""

_URL_RULES = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), parts AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), fitting AS (
    SELECT p.*, r.*,
           row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) + length(rule_path) DESC NULLS LAST) AS place
    FROM parts p LEFT JOIN rules r
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
FROM fitting WHERE place = 1
"""

_SHARDS = """
WITH placed AS (
    SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS bytes,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS place
    FROM documents
), buckets AS (
    SELECT d.depth, place >> (60 - d.depth) AS prefix, sum(bytes) AS shard_bytes, count(*) AS shard_rows,
           min(place) = max(place) AS one
    FROM placed, (SELECT CAST(unnest(range(0, 61)) AS INTEGER) AS depth) d GROUP BY ALL
), fitting AS (
    SELECT p.doc_id, p.bytes, p.place, b.*,
           row_number() OVER (PARTITION BY p.doc_id, p.place ORDER BY b.depth) AS turn
    FROM placed p JOIN buckets b ON p.place >> (60 - b.depth) = b.prefix
    WHERE b.shard_bytes <= 67108864 OR b.one OR b.depth = 60
)
SELECT doc_id, bytes, CASE WHEN depth > 0 THEN lpad(bin(prefix), depth, '0') ELSE '' END AS shard, depth,
       shard_rows, CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_bytes <= 67108864 AS fits
FROM fitting WHERE turn = 1
"""

_HARD_NEGATIVES = """
WITH taken AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS own,
           CAST(list_dot_product(a.vector, r.vector) AS BIGINT) AS score
    FROM taken a JOIN taken r ON a.vec_id % 100 = 0
), positives AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
        FROM scored WHERE own AND vec_id <> anchor_id
    ) ordered WHERE place <= 5
), negatives AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS place
    FROM positives p JOIN scored n
      ON p.anchor_id = n.anchor_id AND NOT n.own AND 80 * p.score <= 100 * n.score AND n.score <= p.score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= 5
"""

SQL = {
    "op13_hard_negatives": _HARD_NEGATIVES,
    "op6_shard_documents": _SHARDS,
    "op3_exact_dedup": _EXACT_DEDUP,
    "op5_mix_sources": _MIX,
    "op10_url_rules": _URL_RULES,
}
