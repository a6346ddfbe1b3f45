"""DuckDB SQL with the same rows as the registered queries, where SQL can express them."""

ORACLE_SQL = {
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM d
    """,
    "op4_chat_format": r"""
        WITH rows AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ),
        turns AS (
            SELECT *, length(regexp_replace(t,
                '([<\[])(\\*)(\||/?s>|</?SYS>>|/?INST\])', '\1\2\\\3', 'g')) AS n_escaped
            FROM rows
        ),
        found AS (
            SELECT conv_id,
                   count(*) AS n_turns,
                   string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn) AS told,
                   coalesce(string_agg(t, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
                   sum(length('<|im_start|>') + length(role) + 1 + n_escaped
                       + length('<|im_end|>') + 1) AS formatted_chars
            FROM turns GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars,
               sha256(loss) AS loss_sha256, cast(formatted_chars AS BIGINT) AS formatted_chars
        FROM found
    """,
    "op13_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ),
        b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ),
        bs AS (SELECT item_id, w, least(len(w), 10) AS l FROM b WHERE len(w) > 0),
        bw AS (
            SELECT DISTINCT item_id, l, array_to_string(w[s:s + l - 1], ' ') AS win
            FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM bs)
        ),
        dw AS (
            SELECT doc_id, p, l, array_to_string(w[p:p + l - 1], ' ') AS win
            FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p
                  FROM d, (SELECT DISTINCT l FROM bw))
        ),
        hits AS (SELECT dw.doc_id, dw.p, dw.l, bw.item_id FROM dw JOIN bw USING (l, win)),
        words_hit AS (
            SELECT doc_id, count(DISTINCT x) AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + l)) AS x FROM hits) GROUP BY doc_id
        ),
        items AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM hits GROUP BY doc_id
        )
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
}
