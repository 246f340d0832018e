"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

OP3 = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (SELECT doc_id, h, length(h) // 2 AS n, unnest(range(0, (length(h) + 1999) // 2000)) AS k FROM b),
q AS (SELECT doc_id, n, k, substr(h, 2000 * k + 1, 2098) AS part FROM k),
p AS (SELECT doc_id, n, k, part, unnest(range(1, least(1000, n - 1000 * k) + 1)) AS j FROM q),
w AS (
    SELECT doc_id, 1000 * k + j AS i, CASE WHEN 1000 * k + j + 49 <= n THEN substr(part, 2 * j - 1, 100) END AS w,
           substr(part, 2 * j - 1, 2) AS c
    FROM p
),
m AS (SELECT w, min(doc_id) AS first FROM w WHERE w IS NOT NULL GROUP BY w),
f AS (SELECT doc_id, i, c, coalesce(doc_id > first, false) AS hit FROM w LEFT JOIN m USING (w)),
r AS (SELECT doc_id, i, c, coalesce(i - max(CASE WHEN hit THEN i END) OVER (PARTITION BY doc_id ORDER BY i) < 50, false) AS gone FROM f),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM r),
s AS (
    SELECT doc_id, count_if(gone) AS n_removed, count_if(opens) AS n_spans,
           string_agg(CASE WHEN gone THEN '' ELSE c END, '' ORDER BY i) AS kept
    FROM e GROUP BY doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM b LEFT JOIN s USING (doc_id)
"""

OP5 = r"""
WITH RECURSIVE
t AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
c AS (
    SELECT conv_id, turn, role, text,
           turn - CASE WHEN EXISTS (
               SELECT 1 FROM t p WHERE p.conv_id = t.conv_id AND p.turn = t.turn - 1 AND p.role IN ('system', 'user')
           ) THEN 1 ELSE 2 END AS before
    FROM t WHERE role IN ('system', 'user')
),
d AS (
    SELECT conv_id, turn, 0::BIGINT AS depth FROM c
    WHERE NOT EXISTS (SELECT 1 FROM c p WHERE p.conv_id = c.conv_id AND p.turn = c.before)
    UNION ALL
    SELECT c.conv_id, c.turn, d.depth + 1 FROM c JOIN d ON c.conv_id = d.conv_id AND c.before = d.turn
),
r AS (SELECT conv_id, turn - 1 AS turn, min(text) AS content, true AS answered FROM t WHERE role = 'assistant' GROUP BY ALL)
SELECT conv_id, turn, conv_id || '-' || turn AS call_id, depth,
       CASE WHEN answered THEN 'ok' ELSE 'no result' END AS status,
       '' AS problems,
       '{"after":' || CASE WHEN before >= 0 THEN '"' || conv_id || '-' || before || '"' ELSE 'null' END
       || ',"arguments":{' || CASE WHEN role = 'user'
          THEN '"prompt":' || to_json(text)::VARCHAR || ',"words":'
               || len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> ''))
          ELSE '"text":' || to_json(text)::VARCHAR END
       || '},"id":"' || conv_id || '-' || turn || '","result":' || coalesce(to_json(content)::VARCHAR, 'null')
       || ',"tool":"' || CASE WHEN role = 'user' THEN 'reply' ELSE 'instruct' END || '"}' AS line
FROM c JOIN d USING (conv_id, turn) LEFT JOIN r USING (conv_id, turn)
"""

OP6 = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""

OP8 = r"""
WITH RECURSIVE
w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'
    ), lambda x: x <> '') AS ws FROM documents
),
s AS (
    SELECT doc_id, CASE
        WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS grams
    FROM w
),
g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS n
    FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (SELECT a, b FROM shared WHERE 100 * n >= 75 * (na + nb - n)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT a AS node, a AS other FROM edges
    UNION
    SELECT reach.node, edges.b FROM reach JOIN edges ON reach.other = edges.a
),
comp AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
SELECT doc_id, len(grams)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id
FROM s LEFT JOIN comp ON s.doc_id = comp.node
"""

OP11 = r"""
WITH RECURSIVE
codes AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, i) ORDER BY i) AS tab
    FROM range(256) r(i)
),
runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{5,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
    FROM documents
),
u AS (SELECT w, count(*) AS k, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM runs GROUP BY doc_id, w),
b AS (SELECT w, k, list_transform(range(1, length(x), 2), lambda i: 16 * (instr('0123456789ABCDEF', x[i]) - 1) + instr('0123456789ABCDEF', x[i + 1]) - 1) AS bytes FROM u),
h AS (SELECT w, k, xor(4294967295, list_reduce(bytes, lambda c, o: xor(c // 256, tab[xor(c, o) % 256 + 1]), 4294967295::BIGINT)) AS h FROM b, codes),
c AS (
    SELECT CASE WHEN h % 97 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, sum(k)::BIGINT AS n
    FROM h GROUP BY 1
),
v AS (SELECT word, n FROM c WHERE length(word) >= 5 AND n >= 3),
d AS (SELECT word, n, length(word) AS l, unnest(range(1, length(word) + 1)) AS i FROM v),
cut AS (SELECT word, n, l, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM d),
near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (l, i, rest) WHERE a.word <> b.word
    UNION SELECT cut.word, cut.n, v.word, v.n FROM cut JOIN v ON v.word = rest
    UNION SELECT v.word, v.n, cut.word, cut.n FROM cut JOIN v ON v.word = rest
),
best AS (SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS place FROM near),
f AS (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form, CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
    FROM v LEFT JOIN best ON best.word = v.word AND place = 1
),
steps AS (
    SELECT word, coalesce(form, word) AS root FROM f
    UNION
    SELECT steps.word, f.form FROM steps JOIN f ON f.word = steps.root WHERE f.form IS NOT NULL
),
ends AS (SELECT steps.word, root FROM steps JOIN f ON f.word = root WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)
"""

ORACLES: dict[str, str] = {"op3_suffix_dedup": OP3, "op5_tool_calls": OP5, "op6_exact_dedup": OP6, "op8_jaccard_join": OP8, "op11_spelling_variants": OP11}
