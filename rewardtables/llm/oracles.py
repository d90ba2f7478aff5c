"""The operators in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: smallest id reachable over both_ways(a, b), for every id that has a link
_COMPONENTS = """walk AS (
    SELECT a AS id, b AS seen FROM both_ways
    UNION
    SELECT w.id, l.b FROM walk w JOIN both_ways l ON l.a = w.seen
), near AS (SELECT id, least(id, min(seen)) AS low FROM walk GROUP BY id)"""

OP1 = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
      AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), both_ways AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q
    ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x) AND list_cosine_similarity(p.x, q.x) >= 0.9
), {_COMPONENTS}
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(low, vec_id) AS component_id,
    coalesce(low, vec_id) = vec_id AS kept
FROM embeddings
LEFT JOIN (SELECT a, count(*) AS n FROM both_ways GROUP BY a) ON a = vec_id
LEFT JOIN near ON id = vec_id
"""

OP3 = rf"""
WITH item AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
    SELECT DISTINCT item_id, n, w[i:i + n - 1] AS win FROM (
        SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
        FROM item WHERE len(w) > 0
    )
), doc AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), hit AS (
    SELECT doc_id, item_id, i, n FROM (
        SELECT doc_id, n, i, w[i:i + n - 1] AS win FROM (
            SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM doc, (SELECT DISTINCT n FROM win)
        )
    ) JOIN win USING (n, win)
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP4 = rf"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (
        SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0
    )
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), link AS (
    SELECT a, b FROM (
        SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS shared
        FROM shingle p JOIN shingle q ON p.s = q.s AND p.doc_id <> q.doc_id GROUP BY 1, 2
    ) JOIN size m ON m.doc_id = a JOIN size o ON o.doc_id = b
    WHERE 100 * shared >= 75 * (m.n + o.n - shared)
), both_ways AS (SELECT a, b FROM link), {_COMPONENTS}
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, doc_id) AS component_id,
    coalesce(low, doc_id) = doc_id AS kept
FROM documents LEFT JOIN size USING (doc_id) LEFT JOIN near ON id = doc_id
"""

OP6 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
    SELECT *, role IS NOT DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS same,
        length(text) + len(regexp_extract_all(text, '[\\<\[]')) AS text_size,
        length(role) + len(regexp_extract_all(role, '[\\<\[\n]')) AS role_size
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(text_size + CASE WHEN same THEN 5 ELSE 8 + role_size END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

OP7 = """
WITH doc AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), piece AS (
    SELECT doc_id, i, md5(substr(h, 2 * i + 1, 100)) AS s FROM (
        SELECT doc_id, h, unnest(range(0, strlen(h) // 2 - 49)) AS i FROM doc WHERE strlen(h) >= 100
    )
), first AS (SELECT s, min(doc_id) AS low FROM piece GROUP BY s
), gone AS (SELECT doc_id, i FROM piece JOIN first USING (s) WHERE low < doc_id
), run AS (
    SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (
        SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
            SELECT doc_id, i, (i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -99) > 50)::INT AS new
            FROM gone
        )
    ) GROUP BY doc_id, run
), edge AS (
    SELECT doc_id, a, b, lag(b) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM run
), cut AS (
    SELECT doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last,
        string_agg(substr(h, 2 * coalesce(before, 0) + 1, 2 * (a - coalesce(before, 0))), '' ORDER BY a) AS head
    FROM edge JOIN doc USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, strlen(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
    coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM doc LEFT JOIN cut USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    """Equivalent SQL by query name."""
    return {
        "op1_embedding_dedup": OP1,
        "op3_decontaminate": OP3,
        "op4_minhash_dedup": OP4,
        "op6_chat_format": OP6,
        "op7_suffix_dedup": OP7,
    }
