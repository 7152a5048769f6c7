"""DuckDB SQL of the operators' queries, where SQL can express them."""

from __future__ import annotations

#: Word lists of whole texts; spaces are the six ASCII ones.
_WORDS = """
words AS (
    SELECT doc_id, regexp_extract_all(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
)"""

OP8 = "WITH" + _WORDS.format(text="text") + """,
win AS (
    SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM words WHERE len(w) >= 13)
),
first AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p
    FROM win JOIN first USING (g) WHERE m < doc_id
),
place AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
    SELECT place.doc_id, string_agg(word, ' ' ORDER BY place.p) AS t, count(*) AS n
    FROM place ANTI JOIN gone ON place.doc_id = gone.doc_id AND place.p = gone.p
    GROUP BY place.doc_id
)
SELECT words.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

OP1 = """
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
),
latest AS (SELECT hex, max(page_id) AS top FROM hashed GROUP BY hex)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, (1 + 5 * (i // 4))::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31)::INTEGER + 1, 1)), '')
           AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM hashed JOIN latest USING (hex)
"""

#: Vectors that can be compared, in double precision.
_VECTORS = """
vec AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
)"""

OP3 = "WITH" + _VECTORS + """,
scored AS (
    SELECT q.vec_id AS query_id, v.vec_id,
           list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * v.e[i]), lambda x, y: x + y) AS score
    FROM vec q JOIN vec v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
    WHERE q.vec_id % 20 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 20
"""

OP5 = "WITH RECURSIVE" + _VECTORS + """,
link AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM vec a JOIN vec b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95
),
reach AS (
    SELECT u, v FROM link
    UNION
    SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u
),
low AS (SELECT u, min(v) AS m FROM reach GROUP BY u),
degree AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN low ON vec_id = low.u LEFT JOIN degree ON vec_id = degree.u
"""

OP6 = "WITH RECURSIVE" + _WORDS.format(
    text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + """,
gram AS (
    SELECT DISTINCT doc_id, array_to_string(w[s:s + 3], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS s FROM words WHERE len(w) > 0)
),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM gram a JOIN gram b USING (g)
    WHERE a.doc_id <> b.doc_id GROUP BY ALL
),
link AS (
    SELECT u, v FROM shared JOIN size a ON a.doc_id = u JOIN size b ON b.doc_id = v
    WHERE 100 * c >= 85 * (a.n + b.n - c)
),
reach AS (
    SELECT u, v FROM link
    UNION
    SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u
),
low AS (SELECT u, min(v) AS m FROM reach GROUP BY u)
SELECT words.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(words.doc_id, coalesce(m, words.doc_id)) AS component_id
FROM words LEFT JOIN size USING (doc_id) LEFT JOIN low ON words.doc_id = low.u
"""

OP12 = """
WITH vec AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_dot_product(a.e, v.e)::BIGINT AS score
    FROM vec a JOIN vec v ON a.vec_id <> v.vec_id AND len(a.e) = len(v.e)
    WHERE a.vec_id % 50 = 0
),
positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
negative AS (
    SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
    FROM positive JOIN scored USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 3
"""

SQL: dict[str, str] = {
    "op1_warc": OP1,
    "op3_vp_search": OP3,
    "op5_near_vectors": OP5,
    "op6_ngram_join": OP6,
    "op8_substring_dedup": OP8,
    "op12_hard_negatives": OP12,
}
