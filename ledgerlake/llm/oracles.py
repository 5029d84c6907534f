"""DuckDB SQL for the operators that plain SQL can express, by brute force: all pairs, all windows.

The SQL holds whole tables of the size on which results are compared; it is no way to run them at scale.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: the smallest node that each node reaches over the pairs (a, b) of ``links``
REACH = """
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
        SELECT DISTINCT a AS node, a AS seen FROM both_ways
        UNION
        SELECT l.a, r.seen FROM both_ways l JOIN reach r ON r.node = l.b),
    roots AS (SELECT node, min(seen) AS root FROM reach GROUP BY node)
"""

JACCARD = rf"""
WITH RECURSIVE
    words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
            WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
        FROM words),
    numbered AS (SELECT doc_id, dense_rank() OVER (ORDER BY s) AS s FROM shingles),
    sizes AS (SELECT doc_id, count(*) AS n FROM numbered GROUP BY doc_id),
    shared AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
        FROM numbered x JOIN numbered y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
        WHERE 100 * c >= 80 * (p.n + q.n - c)),
    {REACH}
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(root, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes z ON z.doc_id = w.doc_id LEFT JOIN roots r ON r.node = w.doc_id
"""

REPEATS = """
WITH texts AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
    starts AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 99)) AS s, h FROM texts WHERE length(h) >= 200),
    windows AS (SELECT doc_id, s, substr(h, 2 * s + 1, 200) AS w FROM starts),
    later AS (SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, s) > 1),
    steps AS (
        SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS fresh
        FROM later),
    numbered AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM steps),
    spans AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM numbered GROUP BY doc_id, run),
    gaps AS (
        SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
    cut AS (
        SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS stop,
            string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
        FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT t.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(CASE WHEN stop IS NULL THEN h ELSE kept || substr(h, 2 * stop + 1) END)) AS kept_sha256
FROM texts t LEFT JOIN cut c ON c.doc_id = t.doc_id
"""

VECTORS = f"""
WITH RECURSIVE
    vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    fine AS (
        SELECT vec_id, list_transform(v, lambda x: CASE WHEN isfinite(x) THEN x ELSE 0.0 END) AS v
        FROM vectors
        WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(v, lambda x: x <> 0)) > 0),
    links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM fine x JOIN fine y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v)
        WHERE CASE WHEN len(x.v) = len(y.v) THEN list_cosine_similarity(x.v, y.v) END >= 0.9),
    {REACH},
    counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(root, vec_id) AS component_id,
    coalesce(root, vec_id) = vec_id AS kept
FROM vectors LEFT JOIN counts ON a = vec_id LEFT JOIN roots ON node = vec_id
"""

ORACLES: dict[str, str] = {"op4_jaccard_join": JACCARD, "op7_suffix_dedup": REPEATS, "op10_embedding_dedup": VECTORS}
