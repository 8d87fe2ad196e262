"""The queries that SQL can express, in DuckDB SQL."""

_BITS = ", ".join(f"'{i:04b}'" for i in range(16))
#: Base 32 of a SHA-1: its 160 bits, five at a time.
_BASE32 = f"""array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (16 * substr(bits, (5 * i + 1)::INT, 1)::INT + 8 * substr(bits, (5 * i + 2)::INT, 1)::INT + 4 * substr(bits, (5 * i + 3)::INT, 1)::INT + 2 * substr(bits, (5 * i + 4)::INT, 1)::INT + substr(bits, (5 * i + 5)::INT, 1)::INT), 1)), '')"""

OP1 = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
 h AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p),
 b AS (SELECT *, array_to_string(list_transform(string_split(hex, ''), lambda c: [{_BITS}][instr('0123456789abcdef', c)]), '') AS bits,
   max(page_id) OVER (PARTITION BY hex) AS first_id FROM h)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM b
"""

#: CRC-32 (polynomial 0xEDB88320), byte by byte over a table made by the same rule.
_TABLE = "SELECT list(list_reduce(range(9), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n::BIGINT) ORDER BY n) AS t FROM range(256) r(n)"
OP3 = f"""
WITH crc AS ({_TABLE.replace("range(9)", "range(8)")}),
 d AS (SELECT doc_id, encode(coalesce(text, '')) AS body FROM documents),
 s AS (SELECT doc_id, octet_length(body)::BIGINT + 1 AS size,
   xor(list_reduce(list_transform(regexp_extract_all(hex(body), '..'), lambda x: (16 * (instr('0123456789ABCDEF', x[1]) - 1) + instr('0123456789ABCDEF', x[2]) - 1)::BIGINT),
     lambda c, x: xor(c >> 8, t[(xor(c & 255, x) + 1)::INT]), 4294967295::BIGINT), 4294967295) AS text_crc32 FROM d, crc),
 o AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - size AS before, sum(size) OVER () AS total FROM s),
 c AS (SELECT *, least(15, ((2 * before + size) * 16 // (2 * total)))::INTEGER AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
 NULL::INTEGER AS grown_shard FROM c
"""

OP9 = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
 e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
 r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON r.doc_id = e.a)
SELECT r.doc_id, any_value(coalesce(n.n, 0))::BIGINT AS n_shingles, min(r.c) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""

ORACLES: dict[str, str] = {"op1_warc": OP1, "op3_sharding": OP3, "op9_jaccard": OP9}
