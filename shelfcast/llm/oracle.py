"""The queries of this package in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

MIXING_SQL = """
WITH RECURSIVE counts AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source
), sized AS (
  SELECT source, n, sum(sqrt(n)) OVER () AS every,
         greatest(1000, ceil(round(sum(sqrt(n)) OVER () / sqrt(min(n) OVER ()), 6))) AS parts
  FROM counts
), weights AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) AS i,
         greatest(1, round(parts * sqrt(n) / every))::BIGINT AS w
  FROM sized
), listed AS (
  SELECT list(w ORDER BY i) AS ws, sum(w)::BIGINT AS total FROM weights
), slots(t, done, pick) AS (
  SELECT 0::BIGINT, list_transform(ws, lambda w: 0::BIGINT), 0::BIGINT FROM listed
  UNION ALL
  SELECT t + 1, list_transform(done, lambda n, i: CASE WHEN i = best THEN n + 1 ELSE n END), best
  FROM (
    SELECT t, done, list_min(list_filter(
        list_transform(ws, lambda w, i: {
          'deadline': CASE WHEN done[i] * total // w <= t
                           THEN ((done[i] + 1) * total + w - 1) // w END,
          'i': i}),
        lambda c: c.deadline IS NOT NULL)).i AS best
    FROM slots, listed WHERE t < total
  )
), turns AS (
  SELECT t - 1 AS slot, pick AS i, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn
  FROM slots WHERE pick > 0
), ranked AS (
  SELECT doc_id, source,
         row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id) - 1 AS r
  FROM documents
)
SELECT doc_id, d.source, w AS weight, (r // 16)::BIGINT AS block,
       ((r // 16) // w * total + slot)::BIGINT AS slot,
       (((r // 16) // w * total + slot) * 16 + r % 16)::BIGINT AS position
FROM ranked d
JOIN weights g ON d.source IS NOT DISTINCT FROM g.source
CROSS JOIN listed
JOIN turns u ON u.i = g.i AND u.turn = (r // 16) % w
"""

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score,
         row_number() OVER (PARTITION BY q.vec_id
                            ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id)::INTEGER AS rank
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

NEAR_SQL = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN list_aggregate(w, 'string_agg', ' ')
                               ELSE list_aggregate(w[i:i+4], 'string_agg', ' ') END AS s,
         len(w) < 5 AS short
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM tokens WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.short = b.short AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) c ON c.doc_id = d.doc_id
LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

CHAT_SQL = r"""
WITH marked AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), told AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         regexp_replace(text, '(<)(\\*)(/?s>|</?SYS>>)|(\[)(\\*)(/?INST\]|OUT\]|/?ROLE\]|/TURN\]|AND\])',
                        '\1\4\\\2\5\3\6', 'g') AS safe,
         regexp_replace(role, '(<)(\\*)(/?s>|</?SYS>>)|(\[)(\\*)(/?INST\]|OUT\]|/?ROLE\]|/TURN\]|AND\])',
                        '\1\4\\\2\5\3\6', 'g') AS safe_role
  FROM marked
), placed AS (
  SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS opens,
         role IS DISTINCT FROM lead(role) OVER (PARTITION BY conv_id ORDER BY i) AS closes
  FROM told
), rendered AS (
  SELECT *, CASE WHEN NOT opens THEN '[AND]' WHEN role = 'system' THEN '<<SYS>>'
                 WHEN role = 'user' THEN '[INST] ' WHEN role = 'assistant' THEN '[OUT] '
                 ELSE '[ROLE] ' || safe_role || ' [/ROLE] ' END || safe
            || CASE WHEN NOT closes THEN '' WHEN role = 'system' THEN '<</SYS>>'
                    WHEN role = 'user' THEN ' [/INST]' WHEN role = 'assistant' THEN '</s>'
                    ELSE '[/TURN]' END AS piece
  FROM placed
), joined AS (
  SELECT conv_id, count(*) AS n_turns, count(*) FILTER (WHERE opens) AS n_blocks,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS turns,
         coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '') AS loss,
         '<s>' || string_agg(piece, '' ORDER BY i) AS formatted
  FROM rendered GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, length(formatted) AS formatted_chars, n_blocks,
       sha256(formatted) AS formatted_sha256
FROM joined
"""


def _means_round(i: int) -> str:
    """Assignment a{i} of every vector to the centroids c{i}, and the centroids after it."""
    return f"""
), d{i} AS (
  SELECT row, vec_id, q, k, list_sum(list_transform(list_zip(q, c), lambda p: (p[1] - p[2]) ** 2))::BIGINT AS d
  FROM v CROSS JOIN c{i}
), a{i} AS (
  SELECT row, any_value(vec_id) AS vec_id, any_value(q) AS q, arg_min(k, d * 100 + k) AS k, min(d) AS d
  FROM d{i} GROUP BY row
), m{i} AS (
  SELECT k, list(m ORDER BY place) AS c
  FROM (SELECT k, place, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m
        FROM (SELECT k, unnest(q) AS x, generate_subscripts(q, 1) AS place FROM a{i}) GROUP BY k, place)
  GROUP BY k
), c{i + 1} AS (
  SELECT c{i}.k, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (k)"""


MEANS_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), q) - 1 AS k, q AS c FROM v
  QUALIFY k < 16{"".join(_means_round(i) for i in range(4))}
)
SELECT vec_id, a3.k::INTEGER AS cluster, d AS distance,
       (sum(d) OVER (PARTITION BY a3.k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c3.k = a3.k
"""

SPELLING_SQL = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n)) AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[a-zÀ-ÿ]+')) AS run
  FROM documents
), grouped AS (
  SELECT run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h
  FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run
), summed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_transform(range(length(h) // 2), lambda i: 16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1)
                                                      + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1),
           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295)) AS crc
  FROM grouped, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN crc % 31 = 0
                       THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2)
                       ELSE run END AS word FROM summed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i
  WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON b.word = a.rest
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON b.word = a.rest
), best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1
), told AS (
  SELECT w.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form,
         CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), steps(word, root, next) AS (
  SELECT word, word, form FROM told
  UNION ALL SELECT s.word, t.word, t.form FROM steps s JOIN told t ON t.word = s.next
)
SELECT word, form, root, n, n_near, form_n FROM told JOIN steps USING (word) WHERE next IS NULL
"""
