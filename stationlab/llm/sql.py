"""DuckDB SQL for the queries of this subpackage that SQL can express."""

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

SQL = {
    "op5_typed_chat": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL
    SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), said AS (
    SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
           4 + 2 + 9
           + length(regexp_replace(role, '(\\|###|</turn>|<(?:image|audio|document):|[:\n])', '\\\1', 'g'))
           + length(regexp_replace(text, '(\\|###|</turn>|<(?:image|audio|document):)', '\\\1', 'g'))
           AS formatted
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
       sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
""",
    "op6_warc_salvage": """
WITH rows AS (
    SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n
    FROM pages
), judged AS (
    SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END
              AS first
    FROM rows
)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM judged
""",
    "op10_fair_queue_mix": rf"""
WITH thin AS (
    SELECT doc_id, source, CAST({WORDS} AS BIGINT) AS size,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash
    FROM documents
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM thin GROUP BY source
), numbered AS (
    SELECT source, source_size, source_size * 3 AS most,
           row_number() OVER (ORDER BY source IS NULL, source) AS rank
    FROM sizes
), weighted AS (
    SELECT *, (rank - 1) % 3 + 1 AS weight FROM numbered
), levels AS (
    SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER before, 0) AS DOUBLE)
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM weighted
    WINDOW before AS (ORDER BY CAST(most AS DOUBLE) / weight, rank
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT rank, source, source_size,
           CASE WHEN most <= level * weight THEN CAST(most AS DOUBLE)
                ELSE max(CASE WHEN most > level * weight THEN level END) OVER () * weight
           END AS target
    FROM levels
), served AS (
    SELECT thin.*, rank, source_size, target,
           row_number() OVER (PARTITION BY rank ORDER BY hash, doc_id, size) AS row,
           sum(size) OVER (PARTITION BY rank ORDER BY hash, doc_id, size
                           ROWS UNBOUNDED PRECEDING) AS done
    FROM thin JOIN targets ON thin.source IS NOT DISTINCT FROM targets.source
), copies AS (
    SELECT served.*, repeat,
           CASE WHEN target > 0
                THEN CAST(repeat * source_size + done AS DOUBLE) / target ELSE 0 END AS finish
    FROM served CROSS JOIN (SELECT unnest([0, 1, 2]) AS repeat)
), ordered AS (
    SELECT *, sum(size) OVER (ORDER BY finish, rank, repeat, row ROWS UNBOUNDED PRECEDING)
              <= (SELECT sum(size) FROM thin) AS taken
    FROM copies
)
SELECT any_value(doc_id) AS doc_id, any_value(size) AS size,
       any_value(source_size) AS source_size, any_value(target) AS target,
       CAST(sum(CASE WHEN taken THEN size ELSE 0 END) AS BIGINT) AS taken
FROM ordered GROUP BY rank, row
""",
    "op12_prefix_trie": """
WITH turns AS (
    SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id
                              ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS number
    FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
    SELECT conv, count(*) AS size, conv - conv % 100 AS family,
           xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
                   string_split(conv::VARCHAR, ''),
                   lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END),
               4294967295) % 6 AS h
    FROM turns GROUP BY conv
), convs AS (
    SELECT crc.*, least(h, coalesce(head.size, 0)) AS lent,
           least(h, coalesce(head.size, 0)) + greatest(crc.size - h, 0) AS length
    FROM crc LEFT JOIN (SELECT conv AS head, size FROM crc) head ON family = head
), rebuilt AS (
    SELECT conv, number - h + lent AS depth, role, text FROM turns JOIN convs USING (conv) WHERE number > h
    UNION ALL
    SELECT convs.conv, number, role, text FROM convs JOIN turns ON turns.conv = family AND number <= h
    UNION ALL
    SELECT conv, 0, '', '' FROM convs
), keyed AS (
    SELECT conv, depth, CAST(length(text) AS BIGINT) AS chars,
           string_agg(md5(length(role) || ':' || role || text), '') OVER
               (PARTITION BY conv ORDER BY depth ROWS UNBOUNDED PRECEDING) AS key
    FROM rebuilt
), paths AS (
    SELECT conv, depth, chars, count(*) OVER node AS n, min(conv) OVER node AS first
    FROM keyed WINDOW node AS (PARTITION BY depth, key)
), nodes AS (
    SELECT own.*, upper.first AS parent
    FROM paths own LEFT JOIN paths upper ON own.conv = upper.conv AND own.depth = upper.depth + 1
    WHERE own.conv = own.first
), children AS (
    SELECT parent AS conv, depth - 1 AS depth, count(*) AS n_children
    FROM nodes WHERE parent IS NOT NULL GROUP BY ALL
), below AS (
    SELECT paths.first AS conv, paths.depth,
           sum((nodes.n - 1) * nodes.chars) AS saved_tokens, sum((n_children IS NULL)::INT) AS n_leaves
    FROM nodes JOIN paths ON nodes.conv = paths.conv AND paths.depth <= nodes.depth
    LEFT JOIN children ON children.conv = nodes.conv AND children.depth = nodes.depth
    GROUP BY ALL
), ends AS (
    SELECT first AS conv, depth, string_agg(conv::VARCHAR, ',' ORDER BY conv) AS ids
    FROM paths JOIN convs USING (conv) WHERE depth = length GROUP BY ALL
)
SELECT conv AS conv_id, depth, parent AS parent_conv_id, n AS n_convs,
       coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN below USING (conv, depth)
LEFT JOIN children USING (conv, depth) LEFT JOIN ends USING (conv, depth)
""",
    "op13_block_names": r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(text) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY text)
""",
}
