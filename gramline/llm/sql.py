"""DuckDB SQL of the queries that SQL can express."""

ORACLE_SQL = {
    "op1_line_dedup": r"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
    SELECT row_id, doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM docs
),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
),
repeated AS (
    SELECT key, max(doc_id) AS last_id FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT row_id) >= 3
),
marked AS (
    SELECT k.*, r.key IS NOT NULL AND (k.doc_id IS NULL OR k.doc_id < r.last_id) AS gone
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row_id
""",
    "op8_exact_top_k": """
WITH whole AS (
    SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.v, v.v)::BIGINT AS score
    FROM whole q JOIN whole v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op12_embedding_duplicates": """
WITH RECURSIVE vectors AS (
    SELECT row_number() OVER () AS row_id, vec_id, label, embedding::DOUBLE[] AS v,
        label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS linkable
    FROM embeddings
),
links AS (
    SELECT a.row_id AS a, b.row_id AS b FROM vectors a JOIN vectors b
        ON a.label = b.label AND a.row_id <> b.row_id AND len(a.v) = len(b.v) AND a.linkable AND b.linkable
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
),
reached AS (
    SELECT row_id AS a, row_id AS b FROM vectors
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
),
component AS (SELECT r.a AS row_id, min(v.vec_id) AS component_id FROM reached r JOIN vectors v ON v.row_id = r.b GROUP BY r.a),
counts AS (SELECT a AS row_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vectors JOIN component USING (row_id) LEFT JOIN counts USING (row_id)
""",
    "op13_lexical_search": r"""
WITH words AS (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
docs AS (SELECT row_id, doc_id, len(terms) AS n, terms FROM words WHERE len(terms) > 0),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
items AS (
    SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM benchmark
),
asked AS (SELECT item, item_id, unnest(terms) AS term FROM items),
asked_times AS (SELECT item, item_id, term, count(*) AS times FROM asked GROUP BY ALL),
wanted AS (SELECT DISTINCT term FROM asked),
found AS (SELECT row_id, doc_id, n, unnest(terms) AS term FROM docs),
tf AS (SELECT row_id, doc_id, n, term, count(*)::BIGINT AS tf FROM found SEMI JOIN wanted USING (term) GROUP BY ALL),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tf, total GROUP BY term, n_docs
),
worth AS (
    SELECT row_id, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS worth
    FROM tf JOIN weights USING (term), total
),
scored AS (
    SELECT item, item_id, row_id, doc_id, sum(worth * times)::BIGINT AS score
    FROM worth JOIN asked_times USING (term) GROUP BY item, item_id, row_id, doc_id
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
