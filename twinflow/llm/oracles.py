"""Expected results as DuckDB SQL, for the operators that SQL can express."""

# CRC-32 of the UTF-8 bytes of a text, by the byte table of its polynomial
_CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_of
)"""


def _crc32(text: str) -> str:
    bytes_ = (
        f"list_transform(regexp_extract_all(hex({text}), '..'), "
        "lambda h: (strpos('0123456789ABCDEF', h[1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2]) - 1)"
    )
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), "
        "lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295)"
    )


OP2 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END)) AS s
    FROM words
),
classes AS (SELECT s, min(doc_id) AS class_id FROM sets GROUP BY s),
shingles AS (SELECT class_id AS id, len(s) AS n, unnest(s) AS shingle FROM classes),
links AS (
    SELECT a.id AS a, b.id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.id <> b.id
    GROUP BY a.id, b.id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
),
reached AS (
    SELECT class_id AS id, class_id AS root FROM classes
    UNION
    SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.id
),
components AS (SELECT id, min(root) AS component_id FROM reached GROUP BY id)
SELECT doc_id, len(d.s) AS n_shingles, CASE WHEN len(d.s) = 0 THEN doc_id ELSE component_id END AS component_id,
    CASE WHEN len(d.s) = 0 THEN doc_id ELSE class_id END AS class_id
FROM sets d JOIN classes c ON c.s = d.s JOIN components k ON k.id = c.class_id
"""

OP11 = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
),
hashed AS (
    SELECT run, c, {_crc32("id || ':' || run")} AS h
    FROM (SELECT id, run, count(*) AS c FROM runs WHERE length(run) >= 7 GROUP BY id, run), crc_table
),
results AS (
    SELECT c, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word
    FROM hashed
),
words AS (SELECT word, sum(c)::BIGINT AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
places AS (SELECT word, n, unnest(range(length(word)))::INTEGER AS i FROM words),
cuts AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM places),
near AS (
    SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, w.word, w.n FROM cuts a JOIN words w ON a.rest = w.word
    UNION SELECT w.word, a.word, a.n FROM cuts a JOIN words w ON a.rest = w.word
),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form, CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word
),
chains AS (
    SELECT word, word AS at, form AS next FROM forms
    UNION ALL
    SELECT c.word, f.word, f.form FROM chains c JOIN forms f ON c.next = f.word
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chains c ON c.word = f.word AND c.next IS NULL
"""

OP12 = f"""
WITH {_CRC_TABLE},
docs AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key
    FROM documents
),
bids AS (
    SELECT row, key, shard, -1.0 / ln((('0x' || substr(md5(key || ':' || shard), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) AS bid
    FROM docs, range(17) AS s(shard)
),
won AS (
    SELECT row, arg_max(shard, {{'bid': bid, 'order': -shard}}) FILTER (shard < 16) AS shard, arg_max(shard, {{'bid': bid, 'order': -shard}}) AS grown_shard
    FROM bids GROUP BY row
)
SELECT doc_id, strlen(body) + 1 AS size, {_crc32("body")} AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY ('0x' || substr(md5(key), 1, 13))::BIGINT, doc_id NULLS FIRST, strlen(body), {_crc32("body")}) - 1 AS slot,
    grown_shard::INTEGER AS grown_shard
FROM docs JOIN won USING (row), crc_table
"""

OP13 = f"""
WITH {_CRC_TABLE},
turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("conv_id::VARCHAR")} % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), crc_table
),
rebuilt AS (
    SELECT c.conv_id, 0 AS own, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
),
sequences AS (
    SELECT c.conv_id, coalesce(list(md5(role) || md5(text) ORDER BY own, pos) FILTER (pos IS NOT NULL), []) AS seq,
        coalesce(list(strlen(text) ORDER BY own, pos) FILTER (pos IS NOT NULL), []) AS sizes
    FROM convs c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id
),
steps AS (SELECT conv_id, seq, sizes, unnest(range(len(seq) + 1)) AS depth FROM sequences),
nodes AS (
    SELECT seq[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(sizes[depth]), 0) AS bytes,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = depth), '')) AS ends_sha256
    FROM steps GROUP BY ALL
),
families AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN families f ON n.path = f.path),
above AS (SELECT *, unnest(range(depth + 1)) AS top FROM full_nodes),
sums AS (
    SELECT path[1:top] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
    FROM above GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s ON n.path = s.path LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""

ORACLES: dict[str, str] = {
    "op2_jaccard_join": OP2,
    "op11_spelling_variants": OP11,
    "op12_sharding": OP12,
    "op13_prefix_trie": OP13,
}
