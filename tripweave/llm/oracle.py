"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: Words of a text, as a list.
WORDS = (
    "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
)
CONTROLS = (
    "((length(t) - length(replace(t, '### ', ''))) // 4"
    " + (length(t) - length(replace(t, '</turn>', ''))) // 7)"
)

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: The SHA-1 digest ``h`` in base 32, five bits a letter.
DIGEST = (
    "array_to_string(list_transform(range(32), lambda k: "
    f"'{BASE32}'[1 + ((('0x' || h[k // 4 * 5 + 1:k // 4 * 5 + 5])::BIGINT"
    " >> (15 - k % 4 * 5)) & 31)]), '')"
)

ORACLE: dict[str, str] = {
    "op2_line_dedup": """
        WITH docs AS (
          SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents
        ), pages AS (
          SELECT row_number() OVER () AS page, source, t
          FROM (SELECT DISTINCT source, coalesce(text, '') AS t FROM documents)
        ), used AS (
          SELECT DISTINCT page, source, regexp_replace(l,
            '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS l
          FROM (SELECT page, source, unnest(string_split(t, chr(10))) AS l FROM pages)
        ), totals AS (SELECT source, count(*) AS n FROM pages GROUP BY source
        ), found AS (
          SELECT used.source, list(l) AS gone FROM (
            SELECT source, l, count(*) AS c FROM used WHERE l <> '' GROUP BY source, l
          ) used JOIN totals ON used.source IS NOT DISTINCT FROM totals.source
          WHERE c >= 3 AND c > 0.07 * n GROUP BY used.source
        ), kept AS (
          SELECT doc_id, docs.source, text, ls, list_filter(ls, lambda x:
            NOT list_contains(coalesce(gone, []), regexp_replace(x,
              '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'))) AS ks
          FROM docs LEFT JOIN found ON docs.source IS NOT DISTINCT FROM found.source
        )
        SELECT doc_id, source, coalesce(len(ls) - len(ks), 0)::BIGINT AS n_dropped,
          CASE WHEN text IS NOT NULL THEN array_to_string(ks, chr(10)) END AS text
        FROM kept
    """,
    "op10_warc": f"""
        WITH p AS (
          SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
        ), k AS (SELECT *, max(page_id) OVER (PARTITION BY h, strlen(html)) AS keeper FROM p)
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {DIGEST} AS payload_digest,
          CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> keeper THEN keeper END AS refers_to
        FROM k
    """,
    "op4_chat_formatting": f"""
        WITH said AS (
          SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t
          FROM (
            SELECT conv_id, turn, role, text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
          )
        ), joined AS (
          SELECT conv_id, count(*) AS n_turns,
            string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t) AS turns,
            coalesce(string_agg(t, '' ORDER BY turn, t) FILTER (r = 'assistant'), '') AS loss,
            sum(length(r) + length(t) + 15 + {CONTROLS}) AS formatted_chars
          FROM said GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256,
          length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
          formatted_chars::BIGINT AS formatted_chars
        FROM joined
    """,
    "op8_quality_rules": f"""
        WITH parts AS (
          SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS ws,
            list_filter(string_split(coalesce(text, ''), chr(10)),
              lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
          FROM documents
        ), windows AS (
          SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS w
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM parts)
        ), found AS (
          SELECT doc_id, i FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows
          ) WHERE n > 1
        ), covered AS (
          SELECT doc_id, count(DISTINCT p) AS n
          FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM found) GROUP BY doc_id
        ), m AS (
          SELECT parts.doc_id, len(ws)::BIGINT AS n_words,
            length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
            len(ls)::BIGINT AS n_lines,
            (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
            coalesce(n, 0)::BIGINT AS n_repeat_words
          FROM parts LEFT JOIN covered ON parts.doc_id IS NOT DISTINCT FROM covered.doc_id
        ), b AS (
          SELECT *,
            (n_words < 10)::INT AS r0,
            (100 * n_repeat_words > 20 * n_words)::INT AS r1,
            (100 * n_symbols > 100 * n_words)::INT AS r2,
            (100 * n_dup_lines > 50 * n_lines)::INT AS r3,
            (word_chars < 2 * n_words)::INT AS r4,
            (word_chars > 30 * n_words)::INT AS r5
          FROM m
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
          r0 + r1 > 0 AS base_failed, r0 + r1 + r2 + r3 + r4 + r5 = 0 AS kept,
          (r0 + 2 * r1 + 4 * r2 + 8 * r3 + 16 * r4 + 32 * r5)::BIGINT AS failed_bits
        FROM b
    """,
}
