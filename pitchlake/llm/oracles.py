"""DuckDB SQL for the queries of this subpackage that SQL can express."""

EXACT_DEDUP = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM n
"""

NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
        WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
    FROM w
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have
    FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (
    SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
    WHERE 100 * both_have >= 75 * (nx.n + ny.n - both_have)
), l AS (
    SELECT x, y FROM e UNION ALL SELECT y, x FROM e
), r AS (
    SELECT doc_id, doc_id AS c FROM documents
    UNION
    SELECT l.y, r.c FROM r JOIN l ON l.x = r.doc_id
), c AS (
    SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
    SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM w WHERE len(ws) >= 50
), k AS (
    SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS win FROM g
), f AS (
    SELECT win, min(doc_id) AS first_doc FROM k GROUP BY win
), hit AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM k JOIN f USING (win) WHERE doc_id > first_doc
), words AS (
    SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w
), t AS (
    SELECT doc_id, count(*) AS n_words, count(hit.j) AS n_removed,
           string_agg(word, ' ' ORDER BY j) FILTER (WHERE hit.j IS NULL) AS kept_words
    FROM words LEFT JOIN hit USING (doc_id, j) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept_words, '')) AS kept_sha256
FROM documents LEFT JOIN t USING (doc_id)
"""

TOP_K = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

SOURCE_MIX = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5(concat_ws(' ', 'mix', doc_id, md5(text))) AS shuffle
    FROM documents
), s AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)
), w AS (
    SELECT *, [5e0, 2e0, 1e0][number % 3 + 1] AS weight, CAST(3 * source_size AS DOUBLE) AS most FROM s
), t AS (
    SELECT CAST(sum(source_size) AS BIGINT) AS total, count(*) AS n_sources, 1024 AS block FROM s
), level AS (
    SELECT *, (total - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit
    FROM w, t WINDOW o AS (ORDER BY most / weight, number)
), target AS (
    SELECT w.*, block, n_sources, (source_size + block - 1) // block AS blocks,
           least(most, weight * (SELECT arg_min(unit, most / weight) FROM level WHERE unit * weight <= most)) AS target
    FROM w, t
), pass AS (
    SELECT *, CAST(floor(target) AS BIGINT) // greatest(source_size, 1) AS times,
           CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) % source_size ELSE 0 END AS rest
    FROM target
), need AS (
    SELECT *, times * blocks + (rest + block - 1) // block AS needed FROM pass
), n AS (
    SELECT CAST(sum(needed) AS BIGINT) AS n_slots FROM need
), part AS (
    SELECT *, floor(coalesce(sum(needed) OVER (ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / n_slots * 2147483648e0) AS low,
           CASE WHEN number = max(number) OVER () THEN 2147483648e0
                ELSE floor(sum(needed) OVER (ORDER BY number ROWS UNBOUNDED PRECEDING) / n_slots * 2147483648e0) END AS high
    FROM need, n
), point AS (
    SELECT i, ((i % 2147483648) * 1327217885) % 2147483648 AS point FROM (SELECT unnest(range(n_slots)) AS i FROM n)
), drawn AS (
    SELECT i AS slot, number, row_number() OVER (PARTITION BY number ORDER BY i) - 1 AS rank FROM point JOIN part ON point >= low AND point < high
), have AS (
    SELECT part.*, coalesce(c, 0) AS have FROM part LEFT JOIN (SELECT number, count(*) AS c FROM drawn GROUP BY number) USING (number)
), slot AS (
    SELECT slot, number, rank FROM drawn
    UNION ALL
    SELECT n_slots + (rank - have) * n_sources + number, number, rank FROM (SELECT *, unnest(range(have, needed)) AS rank FROM have)
), taking AS (
    SELECT slot, number, rank % blocks AS block_number, CASE WHEN rank // blocks < times THEN source_size ELSE rest END AS ends
    FROM slot JOIN part USING (number) WHERE rank < needed
), laid AS (
    SELECT doc_id, number, block, size, CAST(coalesce(sum(size) OVER (
        PARTITION BY number ORDER BY shuffle, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at_word
    FROM d JOIN part ON d.source IS NOT DISTINCT FROM part.source
), piece AS (
    SELECT *, unnest(range(at_word // block, (at_word + size - 1) // block + 1)) AS block_number FROM laid WHERE size > 0
), got AS (
    SELECT doc_id, slot, least(at_word + size, (block_number + 1) * block, ends) - greatest(at_word, block_number * block) AS words
    FROM piece JOIN taking USING (number, block_number)
), taken AS (
    SELECT doc_id, CAST(sum(words) AS BIGINT) AS taken, min(slot) AS first_slot FROM got WHERE words > 0 GROUP BY doc_id
)
SELECT d.doc_id, size, source_size, target, coalesce(taken, 0) AS taken, CAST(first_slot AS BIGINT) AS first_slot
FROM d JOIN part ON d.source IS NOT DISTINCT FROM part.source LEFT JOIN taken USING (doc_id)
"""

URL_FILTERS = r"""
WITH u AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM u
), rules AS (
    SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                          ('net', '/es/', 'block'), ('net', '/fr/', 'block')) AS t(r_host, r_path, r_verdict)
), parts AS (
    SELECT DISTINCT host, path FROM p
), hit AS (
    SELECT host, path, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(r_verdict, length(r_host || r_path)) AS r_verdict
    FROM parts JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY host, path
)
SELECT page_id, p.host, p.path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM p LEFT JOIN hit ON hit.host = p.host AND hit.path = p.path
"""

RANKED_SEARCH = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
    FROM documents
), sized AS (
    SELECT doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0
), whole AS (
    SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized
), q AS (
    SELECT item_id, term, CAST(count(*) AS BIGINT) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY ALL
), tf AS (
    SELECT doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, n, unnest(ts) AS term FROM sized)
    WHERE term IN (SELECT term FROM q) GROUP BY ALL
), df AS (
    SELECT term, CAST(count(*) AS BIGINT) AS df FROM tf GROUP BY term
), w AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, whole
), impact AS (
    SELECT doc_id, term, w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS impact
    FROM tf JOIN w USING (term), whole
), s AS (
    SELECT item_id, doc_id, CAST(sum(times * impact) AS BIGINT) AS score FROM q JOIN impact USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""
