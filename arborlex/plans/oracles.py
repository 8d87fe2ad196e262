"""The registered queries in DuckDB SQL."""

from arborlex.plans.fixtures import ALIASES, CURSOR, DYNAMIC, MERGES, SEEDS


def _values(rows, names: str) -> str:
    quoted = ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {quoted}) v({names}))"


SEED = _values([(f"L{i:03d}", n, f"About {n}") for i, n in enumerate(SEEDS, 1)], "id, name, definition")
DYN = _values([(i, n, f"About {n}") for i, n in DYNAMIC], "id, name, definition")
ALIAS = _values(ALIASES, "source, target")
MERGE = _values(MERGES, "source, target")
ENDS = _values([("L029", "L027"), ("L030", "L027"), ("L031", "L003")], "source, target")

NORM = "trim(regexp_replace(lower({0}), '\\s+', ' ', 'g'))"
TOP = """words AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS tok FROM documents),
 counted AS (SELECT doc_id, tok, count(*) AS n FROM words WHERE length(tok) >= 6 GROUP BY ALL),
 top AS (SELECT doc_id, tok, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, tok) - 1 AS pos FROM counted QUALIFY pos < 3),
 seqs AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS seq FROM documents)"""
PROPS = TOP + """,
 props AS (SELECT seq, doc_id::VARCHAR AS doc_id, pos, 'Topic ' || tok AS name, 'Documents about ' || tok AS definition FROM top JOIN seqs USING (doc_id)),
 keyed AS (SELECT *, 'G_' || sha256(lower(name) || chr(0) || lower(definition))[1:20] AS group_id FROM props)"""
GROUPS = PROPS + """,
 grp AS (SELECT group_id, arg_min(name, seq * 10 + pos) AS name, arg_min(definition, seq * 10 + pos) AS definition, count(*) AS support_count FROM keyed GROUP BY group_id)"""
LOG = """seqs AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS seq FROM documents),
 log AS (SELECT seq, doc_id::VARCHAR AS doc_id, 1 + seq // 256 AS taxonomy_version,
   unnest(list_distinct([printf('L%03d', doc_id % 24 + 1), printf('L%03d', doc_id % 7 + 25)] || CASE WHEN doc_id % 10 = 0 THEN ['L027', 'L029'] ELSE [] END)) AS label_id FROM seqs)"""
POOL = TOP + """,
 named AS (SELECT doc_id, string_agg(tok, ' ' ORDER BY pos) AS name FROM top GROUP BY doc_id),
 pool AS (SELECT 'G_' || sha256(name || chr(0) || lower('About ' || name))[1:20] AS group_id, name, count(*) AS support_count FROM named GROUP BY name),
 toks AS (SELECT DISTINCT group_id, unnest(string_split(name, ' ')) AS tok FROM pool),
 pairs AS (SELECT l.group_id AS left_id, r.group_id AS right_id, count(*) AS shared FROM toks l JOIN toks r USING (tok) WHERE l.group_id < r.group_id GROUP BY ALL),
 sizes AS (SELECT group_id, count(*) AS n FROM toks GROUP BY group_id)"""
ASSIGN = GROUPS + """,
 starts AS (SELECT group_id, substr(regexp_replace(name, '^Topic ', ''), 1, 4) AS start FROM grp),
 assign AS (SELECT group_id, start, min(group_id) OVER (PARTITION BY start) AS rep FROM starts)"""
USAGE = LOG + f""",
 used AS (SELECT coalesce(e.target, l.label_id) AS id, count(*) AS n FROM log l LEFT JOIN {ENDS} e ON e.source = l.label_id GROUP BY 1),
 dyn AS (SELECT d.*, coalesce(u.n, 0) AS usage_count FROM {DYN} d LEFT JOIN used u USING (id))"""

ORACLES = {
    "scan_documents": "SELECT doc_id::VARCHAR AS doc_id, length(text)::BIGINT AS chars FROM documents WHERE regexp_matches(text, '\\S')",
    "normalize_ids": "SELECT CASE WHEN doc_id % 10 = 0 THEN 'direct-' || doc_id WHEN doc_id % 3 = 1 THEN 'generic-' || doc_id WHEN doc_id % 3 = 2 THEN 'warc-' || doc_id ELSE 'direct-' || doc_id END AS doc_id FROM documents",
    "blank_filter": "SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'blank doc_id' ELSE 'blank text' END AS problem FROM documents WHERE doc_id % 11 = 0 OR doc_id % 10 = 3 OR NOT regexp_matches(text, '\\S')",
    "required_fields": "SELECT n_chars, CASE WHEN doc_id % 7 = 0 THEN 'text' ELSE 'doc_id or warc_record_id' END AS missing FROM documents WHERE doc_id % 7 = 0 OR doc_id % 5 = 0",
    "shard_modulo": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 8 AS rank FROM documents QUALIFY rank IN (0, 3)",
    "batch_chunks": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 512 AS batch FROM documents",
    "max_documents": "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100",
    "assign_seq": "SELECT doc_id, 1000 + row_number() OVER (ORDER BY doc_id) AS seq FROM documents",
    "duplicate_docs": "SELECT md5(text) AS text_hash, count(*) AS occurrences FROM documents GROUP BY 1 HAVING count(*) > 1",
    "name_tokens": f"WITH {TOP}, n AS (SELECT doc_id, string_agg(tok, ' & ' ORDER BY pos) AS name FROM top GROUP BY doc_id), t AS (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(replace(lower('The ' || name || ' of Art'), '&', ' and '), '[^a-z0-9]+')) AS tok FROM n) SELECT doc_id, string_agg(tok, ' ' ORDER BY tok) AS tokens FROM t WHERE tok NOT IN ('', 'a', 'an', 'and', 'for', 'in', 'of', 'on', 'or', 'the', 'to', 'with') GROUP BY doc_id",
    "truncate_text": "WITH t AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '') AS w FROM documents) SELECT doc_id, md5(CASE WHEN len(w) <= 50 THEN text ELSE array_to_string(w[1:50], ' ') || chr(10) || '[TRUNCATED]' END) AS text_hash FROM t",
    "proposal_ids": f"WITH {PROPS} SELECT doc_id, pos::INTEGER AS pos, 'P_' || sha256(doc_id || chr(0) || pos || chr(0) || name || chr(0) || definition)[1:20] AS proposal_id FROM props",
    "proposal_groups": f"WITH {GROUPS} SELECT group_id, name, definition, support_count FROM grp",
    "group_collisions": f"WITH {PROPS} SELECT group_id, count(DISTINCT lower(name) || chr(0) || lower(definition)) AS signatures FROM keyed GROUP BY 1 HAVING signatures > 1",
    "dup_proposals": f"WITH {TOP} SELECT DISTINCT doc_id::VARCHAR AS doc_id FROM top WHERE doc_id % 9 = 0",
    "label_validity": f"WITH {TOP}, n AS (SELECT doc_id, pos, CASE doc_id % 5 WHEN 0 THEN tok WHEN 1 THEN tok || '_x' WHEN 2 THEN tok || ' (a/b) ' WHEN 3 THEN repeat(tok, 20) ELSE '1' || tok END AS name FROM top) SELECT doc_id, pos::INTEGER AS pos, length(trim(name)) <= 80 AND regexp_full_match(trim(name), '[A-Za-z][A-Za-z0-9 .,()''&/+\\-:;]*') AS valid FROM n",
    "token_block_pairs": f"WITH {POOL} SELECT left_id, right_id FROM pairs",
    "overlap_score": f"WITH {POOL} SELECT left_id, right_id, round(CASE WHEN shared >= 2 THEN shared / least(l.n, r.n) ELSE 0 END, 6)::DOUBLE AS overlap FROM pairs JOIN sizes l ON l.group_id = left_id JOIN sizes r ON r.group_id = right_id",
    "eligible_candidates": f"WITH {GROUPS} SELECT group_id, support_count FROM grp WHERE support_count >= 2",
    "topk_promotion": f"WITH {GROUPS} SELECT group_id, support_count FROM grp WHERE support_count >= 2 ORDER BY support_count DESC, group_id LIMIT 16",
    "screening_chunks": f"WITH {GROUPS}, c AS (SELECT support_count, (row_number() OVER (ORDER BY group_id) - 1) // 50 AS chunk FROM grp) SELECT chunk, count(*) AS groups, sum(support_count)::BIGINT AS support FROM c GROUP BY chunk",
    "prompt_aliases": f"WITH {GROUPS} SELECT group_id, printf('P%03d', (row_number() OVER (ORDER BY group_id) - 1) % 50 + 1) AS prompt_id FROM grp",
    "seq_gaps": "WITH s AS (SELECT row_number() OVER (ORDER BY doc_id) AS seq FROM documents), k AS (SELECT seq FROM s WHERE seq <> 10) SELECT min(seq) AS first_seq, max(seq) AS latest_seq, count(*) AS records, count(DISTINCT seq) AS distinct_seqs, false AS contiguous FROM k",
    "unknown_labels": f"WITH {LOG} SELECT doc_id, label_id FROM log WHERE label_id = 'L031'",
    "alias_resolve": f"WITH {LOG} SELECT doc_id, label_id, coalesce(e.target, label_id) AS resolved FROM log LEFT JOIN {ENDS} e ON e.source = label_id",
    "usage_counts": f"WITH {USAGE} SELECT id, usage_count FROM dyn",
    "resume_pending": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "orphan_results": "SELECT DISTINCT doc_id * 7 AS doc_id FROM labels WHERE doc_id * 7 NOT IN (SELECT doc_id FROM documents)",
    "empty_evidence": f"WITH {TOP}, w AS (SELECT d.doc_id, (d.doc_id % 3 = 0) AND NOT EXISTS (SELECT 1 FROM top t WHERE t.doc_id = d.doc_id) AS empty_evidence FROM documents d) SELECT doc_id::VARCHAR AS doc_id, empty_evidence FROM w",
    "known_ids": f"SELECT id FROM {SEED} UNION SELECT id FROM {DYN} UNION SELECT source FROM {ALIAS}",
    "accumulate_support": f"WITH {PROPS}, a AS (SELECT group_id, count(*) AS n FROM keyed WHERE seq <= {CURSOR} GROUP BY 1), b AS (SELECT group_id, count(*) AS n FROM keyed WHERE seq > {CURSOR} GROUP BY 1) SELECT a.group_id, a.n + coalesce(b.n, 0) AS support_count FROM a LEFT JOIN b USING (group_id)",
    "groups_to_screen": f"WITH {PROPS}, b AS (SELECT group_id, count(*) AS support_count FROM keyed WHERE seq > {CURSOR} GROUP BY 1) SELECT * FROM b WHERE group_id NOT IN (SELECT group_id FROM keyed WHERE seq <= {CURSOR})",
    "coverage_mismatch": f"WITH {PROPS}, a AS (SELECT DISTINCT group_id FROM keyed WHERE seq <= {CURSOR}), b AS (SELECT DISTINCT group_id FROM keyed WHERE seq > {CURSOR}) SELECT coalesce(a.group_id, b.group_id) AS id, CASE WHEN b.group_id IS NULL THEN 'missing' ELSE 'unknown' END AS problem FROM a FULL JOIN b USING (group_id) WHERE a.group_id IS NULL OR b.group_id IS NULL",
    "active_labels": f"SELECT *, true AS immutable FROM {SEED} UNION ALL SELECT *, false FROM {DYN}",
    "seed_labels_check": f"SELECT count(*) AS labels, count(DISTINCT id) AS ids, count(DISTINCT lower(name)) AS names, true AS ok FROM {SEED}",
    "next_label_num": "SELECT 32::BIGINT AS next_number",
    "name_collisions": f"WITH {TOP} SELECT DISTINCT lower(name) AS name FROM {SEED} WHERE lower(name) IN (SELECT lower(tok) FROM top UNION SELECT 'politics')",
    "labels_for_prompt": f"SELECT string_agg(id || ' | ' || name || ': ' || definition, chr(10) ORDER BY id) AS prompt FROM (SELECT * FROM {SEED} UNION ALL SELECT * FROM {DYN})",
    "apply_merge": f"WITH {USAGE} SELECT d.id, (d.usage_count + coalesce(s.n, 0))::BIGINT AS usage_count, (2 + coalesce(s.c, 0) * 2)::BIGINT AS proposal_support_count, CASE WHEN s.c IS NULL THEN 2 ELSE 3 END::BIGINT AS last_modified_version FROM dyn d LEFT JOIN (SELECT m.target AS id, sum(x.usage_count) AS n, count(*) AS c FROM {MERGE} m JOIN dyn x ON x.id = m.source GROUP BY 1) s USING (id) WHERE d.id NOT IN (SELECT source FROM {MERGE})",
    "merge_aliases": f"SELECT a.source, coalesce(m.target, a.target) AS target FROM {ALIAS} a LEFT JOIN {MERGE} m ON m.source = a.target UNION ALL SELECT source, target FROM {MERGE}",
    "apply_revision": f"SELECT id, CASE id WHEN 'L027' THEN 'Space' ELSE name END AS name, CASE id WHEN 'L027' THEN 'About space' ELSE definition END AS definition, CASE id WHEN 'L027' THEN 3 ELSE 2 END::BIGINT AS last_modified_version FROM {DYN}",
    "promotion_support": f"WITH {ASSIGN} SELECT start AS name, sum(support_count)::BIGINT AS proposal_support_count FROM assign JOIN grp USING (group_id) GROUP BY start",
    "apply_screening": f"WITH {PROPS}, a AS (SELECT group_id, count(*) AS support_count FROM keyed WHERE seq <= {CURSOR} GROUP BY 1), b AS (SELECT group_id, count(*) AS support_count FROM keyed WHERE seq > {CURSOR} GROUP BY 1) SELECT * FROM a WHERE group_id NOT IN (SELECT group_id FROM b WHERE support_count % 3 <> 0) UNION ALL SELECT * FROM b WHERE support_count % 3 = 0 AND group_id NOT IN (SELECT group_id FROM a)",
    "apply_consolidation": f"WITH {ASSIGN} SELECT rep AS group_id, sum(support_count)::BIGINT AS support_count FROM assign JOIN grp USING (group_id) GROUP BY rep",
    "reviewed_pairs": f"WITH {ASSIGN}, h AS (SELECT substr(start, 1, 3) AS entry, group_id, rep FROM assign) SELECT DISTINCT l.group_id AS left_id, r.group_id AS right_id FROM h l JOIN h r USING (entry) WHERE l.group_id < r.group_id AND l.rep <> r.rep",
    "excluded_pairs_filter": f"WITH {POOL} SELECT left_id, right_id FROM pairs JOIN sizes l ON l.group_id = left_id JOIN sizes r ON r.group_id = right_id WHERE NOT (l.n = 3 AND r.n = 3 AND shared = 1)",
    "url_text": "SELECT page_id, md5(coalesce(url, '') || chr(10) || chr(10) || coalesce(html, '')) AS text_hash FROM pages",
    "compact_output": "SELECT page_id::VARCHAR AS doc_id, CASE WHEN length(html) >= 2000 THEN 'long' ELSE 'short' END AS predicted_label FROM pages",
    "argmax_label": "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS predicted FROM embeddings",
    "id2label": "SELECT vec_id, CASE WHEN label < 8 THEN 'class-' || label ELSE label::VARCHAR END AS name FROM embeddings",
    "threshold_label": "SELECT doc_id, regexp_replace(printf('%.3f', (doc_id % 1000) / 1000.0), '\\.?0+$', '') AS label FROM documents",
    "format_duration": "WITH s AS (SELECT doc_id, n_chars AS s FROM documents) SELECT doc_id, CASE WHEN s >= 3600 THEN printf('%dh %dm %ds', s // 3600, s % 3600 // 60, s % 60) WHEN s >= 60 THEN printf('%dm %ds', s // 60, s % 60) ELSE printf('%ds', s) END AS duration FROM s",
    "shard_reconcile": "SELECT (row_number() OVER (ORDER BY doc_id) - 1) % 8 AS rank, doc_id FROM documents",
    "count_lines": "SELECT count(*) AS lines FROM documents",
    "length_buckets": "WITH p AS (SELECT doc_id, length(text) AS n, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents) SELECT doc_id, place // 256 * 8 + (row_number() OVER (PARTITION BY place // 256 ORDER BY n, place) - 1) // 32 AS batch FROM p",
    "url_shards": "SELECT page_id, coalesce(url, '') AS url FROM pages QUALIFY (row_number() OVER (ORDER BY page_id) - 1) % 5 = 2 AND row_number() OVER (ORDER BY page_id) > 5",
    "normalize_text": f"SELECT doc_id, md5({NORM.format("'  The' || chr(9) || text || '  ' || chr(10) || text || ' '")}) AS normalized FROM documents",
    "repair_label": f"WITH {TOP} SELECT doc_id, pos::INTEGER AS pos, nullif(regexp_replace(CASE pos WHEN 1 THEN tok || 'x' ELSE tok END, '^[0-9]+', ''), '') AS name FROM top",
    "fix_output": f"WITH {TOP} SELECT doc_id, 'L001,L002' AS ids, string_agg(tok, ',' ORDER BY pos) AS names FROM top WHERE regexp_matches(tok, '^[a-z]') GROUP BY doc_id",
    "classify_documents": """WITH w AS (SELECT doc_id, list_distinct(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS w FROM documents), l AS (SELECT doc_id, (CASE WHEN list_contains(w, 'thtion') THEN ['L001'] ELSE [] END || CASE WHEN list_contains(w, 'the') THEN ['L002'] ELSE [] END || CASE WHEN list_contains(w, 'erble') OR list_contains(w, 'was') THEN ['L003'] ELSE [] END) AS l FROM w) SELECT row_number() OVER (ORDER BY doc_id::VARCHAR) AS seq, doc_id::VARCHAR AS doc_id, 1::BIGINT AS taxonomy_version, CASE WHEN len(l) = 0 THEN 'L005' ELSE array_to_string(l, ',') END AS labels FROM l""",
}
