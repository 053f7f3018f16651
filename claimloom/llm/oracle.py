"""DuckDB SQL for the registered queries that SQL can express."""

# The base-32 alphabet is a fixed value.
SQL = {
    "op2_suffix_dedup": """
WITH docs AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS bytes, strlen(coalesce(text, '')) AS n_bytes FROM documents
), windows AS (
    SELECT doc_id, unnest(range(0, n_bytes - 99)) AS start, bytes FROM docs
), strings AS (
    SELECT doc_id, start, md5(substr(bytes, 2 * start + 1, 200)) AS string FROM windows
), later AS (
    SELECT doc_id, start FROM strings
    QUALIFY row_number() OVER (PARTITION BY string ORDER BY doc_id, start) > 1
), islands AS (
    SELECT doc_id, start, sum(fresh) OVER (PARTITION BY doc_id ORDER BY start) AS island
    FROM (SELECT *, (start > coalesce(lag(start) OVER (PARTITION BY doc_id ORDER BY start) + 100, -1))::INT AS fresh FROM later)
), spans AS (
    SELECT doc_id, min(start) AS low, max(start) + 100 AS high FROM islands GROUP BY doc_id, island
), gaps AS (
    SELECT doc_id, coalesce(lag(high) OVER same, 0) AS low, low AS high FROM spans WINDOW same AS (PARTITION BY doc_id ORDER BY low)
    UNION ALL
    SELECT d.doc_id, coalesce(s.high, 0), d.n_bytes FROM docs d
    LEFT JOIN (SELECT doc_id, max(high) AS high FROM spans GROUP BY doc_id) s USING (doc_id)
), kept AS (
    SELECT doc_id, string_agg(substr(bytes, 2 * low + 1, 2 * (high - low)), '' ORDER BY low) AS bytes
    FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept.bytes)) AS kept_sha256
FROM docs JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id) USING (doc_id)
""",
    "op5_exact_dedup": """
WITH digests AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, text_sha256
FROM digests
WINDOW same AS (PARTITION BY text_sha256)
""",
    "op8_zip_warc": """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM payloads
)
SELECT page_id,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to,
       payload_bytes,
       array_to_string([
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || hex[5 * (i // 4) + 1:5 * (i // 4) + 5])::BIGINT >> (15 - 5 * (i % 4))) & 31)]
           for i in range(32)
       ], '') AS payload_digest
FROM firsts
""",
    "op10_line_dedup": r"""
WITH lines AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS nr
    FROM documents
), boilerplate AS (
    SELECT line FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    GROUP BY line HAVING count(DISTINCT coalesce('=' || source, '')) >= 10
), marked AS (
    SELECT lines.*, boilerplate.line IS NOT NULL AS gone FROM lines LEFT JOIN boilerplate USING (line)
), cleaned AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (NOT gone), '') AS kept
    FROM marked GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN cleaned USING (doc_id)
""",
    "op12_conversation_repair": r"""
WITH RECURSIVE keys AS (
    SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place FROM conversations
), kinds AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(
               list_prepend(4294967295::BIGINT, [ascii(substr(place, i, 1))::BIGINT for i in range(1, length(place) + 1)]),
               lambda crc, byte: list_reduce(
                   list_prepend(xor(crc, byte), range(8)),
                   lambda x, bit: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))
           ), 4294967295::BIGINT) % 20 AS kind
    FROM keys
), damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM kinds
), turns AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS initial,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
           CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault
    FROM damaged
), inserts(st, k, st2, added) AS (
    VALUES ('N', 0, 'N', []::VARCHAR[]), ('S', 0, 'S', []), ('U', 0, 'U', []), ('A', 0, 'A', []),
           ('N', 1, 'U', ['user:']), ('S', 1, 'U', ['user:']), ('A', 1, 'U', ['user:']), ('U', 1, 'A', ['assistant:']),
           ('N', 2, 'A', ['user:', 'assistant:']), ('S', 2, 'A', ['user:', 'assistant:']),
           ('A', 2, 'A', ['user:', 'assistant:']), ('U', 2, 'U', ['assistant:', 'user:'])
), edits(st, op, wanted, st2, price) AS (
    VALUES ('N', 'D', NULL, 'N', 2), ('S', 'D', NULL, 'S', 2), ('U', 'D', NULL, 'U', 2), ('A', 'D', NULL, 'A', 2),
           ('N', 'K', 's', 'S', 0), ('N', 'K', 'u', 'U', 0), ('S', 'K', 'u', 'U', 0), ('A', 'K', 'u', 'U', 0), ('U', 'K', 'a', 'A', 0),
           ('N', 'R', NULL, 'U', 1), ('S', 'R', NULL, 'U', 1), ('A', 'R', NULL, 'U', 1), ('U', 'R', NULL, 'A', 1)
), steps AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS pos, 'N' AS st, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS written FROM turns
    UNION ALL
    SELECT * FROM (
        SELECT t.conv_id, t.pos, e.st2 AS st,
               s.cost + 5 * i.k + e.price + CASE WHEN e.op <> 'D' AND t.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
               s.audit || repeat('I', i.k) || e.op AS audit,
               s.written || i.added || CASE e.op WHEN 'D' THEN [] WHEN 'K' THEN [t.role || ':' || t.text]
                   ELSE [CASE e.st2 WHEN 'U' THEN 'user:' ELSE 'assistant:' END || t.text] END AS written
        FROM steps s
        JOIN turns t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.pos = s.pos + 1
        JOIN inserts i ON i.st = s.st
        JOIN edits e ON e.st = i.st2 AND (e.wanted IS NULL OR e.wanted = t.initial)
        WHERE e.op = 'D' OR t.fault IS NULL OR t.fault = 'truncated'
    ) QUALIFY row_number() OVER (PARTITION BY conv_id, st ORDER BY cost, audit) = 1
), closed AS (
    SELECT s.conv_id, s.cost + 5 * i.k AS cost, s.audit || repeat('I', i.k) AS audit, s.written || i.added AS written
    FROM steps s JOIN (SELECT conv_id, max(pos) AS pos FROM turns GROUP BY conv_id) t
      ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.pos = s.pos
    JOIN inserts i ON i.st = s.st AND i.st2 IN ('N', 'A')
), ends AS (
    SELECT * FROM closed QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1
), figures AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM turns) GROUP BY conv_id
)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(written, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id
""",
    "op13_collocations": r"""
WITH docs AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), pieces AS (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), worded AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), grams AS (
    SELECT lang, unnest([words[i:i + size - 1] for i in range(1, len(words) - size + 2)]) AS gram
    FROM worded, (VALUES (1), (2), (3)) sizes(size)
), counts AS (
    SELECT lang, gram, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE len(gram) = 1 GROUP BY lang
), candidates AS (
    SELECT lang, gram, f AS a FROM counts WHERE len(gram) > 1 AND f >= 10
), cuts AS (
    SELECT c.*, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
    FROM (SELECT *, unnest(range(1, len(gram))) AS k FROM candidates) c
    JOIN counts x ON x.lang = c.lang AND x.gram = c.gram[:k]
    JOIN counts y ON y.lang = c.lang AND y.gram = c.gram[k + 1:]
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.gram ORDER BY score, k) = 1
), inside AS (
    SELECT lang, gram, max(a) AS longest
    FROM (SELECT lang, unnest([gram[1:2], gram[2:3]]) AS gram, a FROM candidates WHERE len(gram) = 3) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(gram, ' ')) AS rank,
       array_to_string(gram, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
FROM cuts LEFT JOIN inside USING (lang, gram) JOIN totals USING (lang)
WHERE longest IS NULL OR 100 * longest < 50 * a
QUALIFY rank <= 2000
""",
}
