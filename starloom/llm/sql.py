"""DuckDB SQL of the registered queries that SQL can state, each by another way than its operator."""

from __future__ import annotations

#: A byte's step of CRC-32, from its polynomial; and the CRC of the byte list of a row that has ``bytes``.
CRC_TABLE = "crc AS (SELECT list_transform(range(256), lambda x: list_reduce([x] || range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps)"


def crc32(byte_list: str) -> str:
    return f"xor(list_reduce([4294967295] || {byte_list}, lambda a, b: xor(a >> 8, steps[1 + (xor(a, b) & 255)])), 4294967295)"


def utf8_bytes(text: str) -> str:
    return f"list_transform(range(0, octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"


#: The trie by its definition: nodes from equal prefixes, subtree sums over the ancestors of each node.
PREFIX_TRIE = f"""
WITH {CRC_TABLE},
said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS ord FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, {crc32("list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM said), crc),
parts AS (SELECT c.conv_id, 0 AS own, s.ord, s.role, s.text FROM convs c JOIN said s ON s.conv_id = c.conv_id - c.conv_id % 5 AND s.ord <= h
    UNION ALL SELECT c.conv_id, 1, s.ord, s.role, s.text FROM convs c JOIN said s ON s.conv_id = c.conv_id AND s.ord > h),
turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, ord) AS depth, length(role) || ':' || role || length(text) || ':' || text AS said, octet_length(encode(text)) AS n_bytes FROM parts),
paths AS (SELECT conv_id, depth, n_bytes, sha256(string_agg(said, '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM turns
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
ends AS (SELECT conv_id, max(depth) AS len FROM paths GROUP BY 1),
nodes AS (SELECT node, any_value(depth) AS depth, any_value(n_bytes) AS n_bytes, min(conv_id) AS conv_id, count(*) AS n_convs, max(len) AS deepest,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len = depth), '')) AS ends_sha256 FROM paths JOIN ends USING (conv_id) GROUP BY 1),
above AS (SELECT p.node AS ancestor, n.* FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth),
sums AS (SELECT ancestor AS node, CAST(sum((n_convs - 1) * n_bytes) AS BIGINT) AS saved_tokens, count(*) FILTER (deepest = depth) AS n_leaves FROM above GROUP BY 1),
parents AS (SELECT n.node, p.node AS parent FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
kids AS (SELECT parent AS node, count(*) AS n_children FROM parents GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (node) LEFT JOIN kids USING (node) LEFT JOIN parents r USING (node) LEFT JOIN nodes up ON up.node = r.parent"""

#: The registered template adds 20 characters a turn, and a backslash a control string, escaped or not, of a role or text.
CHAT_FORMAT = r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
said AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS ord, length(role) + length(text) + 20
    + len(regexp_extract_all(role, '<\\*/?s>|\[\\*/?INST\]')) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?INST\]')) AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY ord)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY ord) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""

IMPORTANCE = f"""
WITH {CRC_TABLE},
texts AS (SELECT 'd' AS kind, row_number() OVER () AS k, doc_id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
split AS (SELECT kind, k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM texts),
feats AS (SELECT kind, k, unnest(ws || list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS f FROM split),
counts AS (SELECT f, count(*) FILTER (kind = 'd') AS nd, count(*) FILTER (kind = 'b') AS nb FROM feats GROUP BY f),
hashed AS (SELECT f, nd, nb, {crc32(utf8_bytes("f"))} % 10000 AS bucket FROM counts, crc),
sums AS (SELECT sum(nd) AS s_all, sum(nb) AS t_all FROM counts),
gains AS (SELECT bucket, CAST(floor(1000 * ln((sum(nb) + 1)::DOUBLE * (any_value(s_all) + 10000)::DOUBLE / ((sum(nd) + 1)::DOUBLE * (any_value(t_all) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM hashed, sums GROUP BY bucket),
weights AS (SELECT k, count(*) AS n_features, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM feats JOIN hashed USING (f) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY k),
scored AS (SELECT k, doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM split LEFT JOIN weights USING (k) WHERE kind = 'd'),
places AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank FROM scored LEFT JOIN places USING (k)"""

SQL = {"op11_prefix_trie": PREFIX_TRIE, "op12_chat_format": CHAT_FORMAT, "op13_importance": IMPORTANCE}
