"""DuckDB SQL for the queries that SQL can express on whole tables."""

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = {
    "op7_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_NORM} AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm)""",
    "op8_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        q AS (SELECT page_id, html, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p)
        SELECT page_id, strlen(html) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (5 * (3 - i % 4))) & 31) + 1, 1)), '')
                   AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM q""",
    "op10_near_dedup": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) > 1
                THEN list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])
                ELSE words END) AS shingle FROM d),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (shingle)
            WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        link AS (
            SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * k >= 80 * (x.n + y.n - k)),
        reach(doc_id, seen) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT b, seen FROM reach JOIN link ON a = reach.doc_id),
        c AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op11_trie": """
        WITH t AS (
            SELECT conv_id, role || chr(10) || sha256(text) AS content, strlen(text) AS size,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS d
            FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
            WHERE conv_id IS NOT NULL),
        own AS (
            SELECT conv_id AS c, count(*) AS n, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(
                    range(1, strlen(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
                lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                    lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT)))) % 9 AS h
            FROM t GROUP BY conv_id),
        plan AS (SELECT o.*, least(o.h, coalesce(b.n, 0)) AS k FROM own o LEFT JOIN own b ON o.base = b.c),
        r AS (
            SELECT c, d, content, size FROM plan JOIN t ON t.conv_id = base AND d <= k
            UNION ALL SELECT c, d - h + k, content, size FROM plan JOIN t ON t.conv_id = c AND d > h),
        path AS (
            SELECT c, d, size, string_agg(sha256(content), ',') OVER (PARTITION BY c ORDER BY d) AS key,
                   d = max(d) OVER (PARTITION BY c) AS last FROM r
            UNION ALL SELECT c, 0, 0, '', c NOT IN (SELECT c FROM r) FROM plan),
        node AS (
            SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
            FROM path GROUP BY key, d),
        up AS (SELECT n.key, n.d, p.key AS over_key FROM node n JOIN path p ON p.c = n.conv_id AND p.d = n.d - 1),
        children AS (SELECT over_key AS key, count(*) AS n_children FROM up GROUP BY over_key),
        below AS (
            SELECT p.key, count(*) FILTER (k.key IS NULL) AS n_leaves, sum(n.saved)::BIGINT AS saved_tokens
            FROM node n JOIN path p ON p.c = n.conv_id AND p.d <= n.d LEFT JOIN children k ON k.key = n.key GROUP BY p.key)
        SELECT n.conv_id, n.d AS depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
               n_leaves, saved_tokens, n.ends_sha256
        FROM node n JOIN below USING (key) LEFT JOIN children USING (key) LEFT JOIN up USING (key)
            LEFT JOIN node o ON o.key = up.over_key""",
    "op12_substrings": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(
                coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
        starts AS (
            SELECT row, unnest(range(1, len(words) - 33)) AS pos, words FROM d WHERE len(words) >= 35),
        hashed AS (SELECT row, pos, sha256(array_to_string(words[pos:pos + 34], ' ')) AS hash FROM starts),
        deep AS (SELECT hash FROM hashed GROUP BY hash HAVING count(*) > 1),
        marked AS (SELECT row, pos FROM hashed WHERE hash IN (SELECT hash FROM deep)),
        w AS (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
        covered AS (
            SELECT w.row, w.pos, word, coalesce(max(m.pos) OVER (
                PARTITION BY w.row ORDER BY w.pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
            FROM w LEFT JOIN marked m ON w.row = m.row AND w.pos = m.pos),
        kept AS (
            SELECT row, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
                   string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
            FROM covered GROUP BY row)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (row)""",
    "op13_lexical": rf"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents),
        i AS (SELECT row_number() OVER () AS item, item_id, list_distinct({_TERMS}) AS terms FROM benchmark),
        size AS (SELECT row, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
        corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM size),
        tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY ALL),
        weight AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
                   FROM tf, corpus GROUP BY term, docs),
        m AS (SELECT row, doc_id, 10 + (90 * n * docs) // total AS m FROM size, corpus),
        scored AS (
            SELECT item, item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM (SELECT item, item_id, unnest(terms) AS term FROM i) JOIN tf USING (term) JOIN weight USING (term)
                JOIN m USING (row) GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, row)::INTEGER AS rank
                   FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
