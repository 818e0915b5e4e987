"""What DuckDB should get for the queries of this subpackage that SQL can express."""

SQL = {
    "p2_found": r"""
        WITH t AS (SELECT DISTINCT doc_id, text FROM pdf_extractions WHERE text IS NOT NULL),
        w AS (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS w FROM t),
        g AS (SELECT doc_id, unnest(range(1, len(w) - 4)) AS i, w FROM w WHERE len(w) >= 6),
        r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(w, i, i + 5)) AS n FROM g),
        c AS (SELECT doc_id, count(DISTINCT i + k) AS repeated FROM r, range(6) s(k) WHERE n > 1 GROUP BY doc_id)
        SELECT doc_id FROM c JOIN w USING (doc_id) WHERE repeated >= 0.4 * len(w)""",
    "p6_found": r"""
        WITH t AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM pdf_extractions WHERE text IS NOT NULL),
        s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 2) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 20)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        o AS (SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL)
        SELECT doc_id_a, doc_id_b FROM o JOIN n x ON x.doc_id = doc_id_a JOIN n y ON y.doc_id = doc_id_b WHERE 2 * k >= x.n + y.n - k""",
    "p7_found": r"""
        WITH d AS (SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{N}]+', '', 'g') AS s FROM documents),
        i AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
        p AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, j, j + 9), '') AS p FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS j FROM i WHERE len(w) >= 10))
        SELECT DISTINCT doc_id, item_id FROM d JOIN p ON contains(d.s, p.p)""",
}
