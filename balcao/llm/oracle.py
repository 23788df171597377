"""SQL counterparts, where SQL can express the same result at the size of the check."""

OP4 = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) < 4 THEN w ELSE w[i:i + 3] END, ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM cut WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
), links AS (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * c >= 85 * (p.n + q.n - c)
), reach AS (
    SELECT DISTINCT a AS doc_id, a AS seen FROM links
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.seen
), least_seen AS (SELECT doc_id, min(seen) AS seen FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(m.seen, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least_seen m ON m.doc_id = d.doc_id
"""

ORACLE_SQL = {"op4_jaccard": OP4}
