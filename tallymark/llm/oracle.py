"""DuckDB text of the queries that SQL can express, by plain set operations."""

import string

# Only A-Z become small letters.
_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
OP10_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item, least(13, len(ws)) AS n, array_to_string(ws[j : j + least(13, len(ws)) - 1], ' ') AS k
       FROM (SELECT item, ws, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS j FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, p, n, array_to_string(ws[p : p + n - 1], ' ') AS k
       FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d CROSS JOIN lens WHERE len(ws) >= n)),
hits AS (SELECT dw.doc_id, dw.p, dw.n, bw.item FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
pos AS (SELECT DISTINCT doc_id, q FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits)),
hc AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
ic AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hc ON d.doc_id = hc.doc_id LEFT JOIN ic ON d.doc_id = ic.doc_id"""
OP9_MINHASH = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, ws[i] || ' ' || ws[i + 1] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM d WHERE len(ws) > 1)
        UNION ALL SELECT doc_id, ws[1] AS g FROM d WHERE len(ws) = 1)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT x, y FROM c JOIN n p ON p.doc_id = c.x JOIN n q ON q.doc_id = c.y WHERE 100 * c >= 80 * (p.n + q.n - c)),
l AS (SELECT x, y FROM e UNION ALL SELECT y AS x, x AS y FROM e),
r(id, other) AS (SELECT doc_id AS id, doc_id AS other FROM d UNION SELECT r.id, l.y AS other FROM r JOIN l ON l.x = r.other)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT id, min(other) AS component_id FROM r GROUP BY id) m ON m.id = d.doc_id"""


def _crc32(text: str) -> str:
    """CRC-32 of a short ASCII string."""
    code = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))"
    bits = "[CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0]"
    byte = f"list_reduce(list_concat([xor(c, b)], {bits}[1:8]), lambda x, z: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))"
    return f"xor(CAST(4294967295 AS BIGINT), list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {code}), lambda c, b: {byte}))"


_BLANK = "\\x20\\x09-\\x0D"
OP11_CONVERSATION_REPAIR = f"""
WITH RECURSIVE o AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS f FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS c FROM o WHERE f <> 0),
r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || ':' || text), c) AS p FROM d),
q AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) AS nth FROM r),
m AS MATERIALIZED (SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_BLANK}]') THEN 1 WHEN nth > 1 THEN 2
        WHEN NOT regexp_matches(text, '[.!?][{_BLANK}]*$') THEN 3 ELSE 0 END AS fault, substr(role, 1, 1) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS before FROM q),
b(conv_id, p, b0, b1, b2, b3) AS (
    SELECT DISTINCT conv_id, n + 1, 0, 6, 3, 0 FROM m
    UNION ALL
    SELECT conv_id, p, least(d0, 3 + least(d2, 3 + d3)), least(d1, 3 + least(d2, 3 + d3)), least(d2, 3 + d3), least(d3, 3 + d2)
    FROM (SELECT m.conv_id, m.p,
        least(4 + b0, e + 3 + b2, e + CASE i WHEN 's' THEN b1 WHEN 'u' THEN b2 ELSE 99 + b0 END) AS d0,
        least(4 + b1, e + 3 + b2, e + CASE i WHEN 'u' THEN b2 ELSE 99 + b0 END) AS d1,
        least(4 + b2, e + 3 + b3, e + CASE i WHEN 'a' THEN b3 ELSE 99 + b0 END) AS d2,
        least(4 + b3, e + 3 + b2, e + CASE i WHEN 'u' THEN b2 ELSE 99 + b0 END) AS d3
      FROM b JOIN (SELECT *, CASE WHEN fault IN (1, 2) THEN 1000000000 WHEN fault = 3 THEN 3 ELSE 0 END AS e FROM m) m
        ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.p = b.p - 1)),
v AS MATERIALIZED (SELECT b.conv_id, b.p, [b0, b1, b2, b3] AS v, m.role, m.text, m.i, m.n, m.fault IN (1, 2) AS gone, CASE WHEN fault = 3 THEN 3 ELSE 0 END AS e
    FROM b LEFT JOIN m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.p = b.p),
w AS MATERIALIZED (SELECT a.*, z.v AS nv FROM v a LEFT JOIN v z ON z.conv_id IS NOT DISTINCT FROM a.conv_id AND z.p = a.p + 1),
t(conv_id, p, s, audit, said, cost, step, done) AS (
    SELECT conv_id, CAST(1 AS BIGINT), 0, '', CAST([] AS VARCHAR[]), v[1], 0, false FROM v WHERE p = 1
    UNION ALL
    SELECT conv_id, CASE WHEN l IN ('D', 'K', 'R') THEN p + 1 ELSE p END,
        CASE l WHEN 'D' THEN s WHEN '' THEN s WHEN 'K' THEN CASE WHEN i = 's' THEN 1 WHEN i = 'u' THEN 2 ELSE 3 END ELSE nxt END,
        audit || l,
        CASE l WHEN 'I' THEN list_append(said, put || ':') WHEN 'K' THEN list_append(said, role || ':' || text)
               WHEN 'R' THEN list_append(said, put || ':' || text) ELSE said END,
        cost, step + 1, l = ''
    FROM (SELECT t.*, w.role, w.text, w.i, CASE WHEN s = 2 THEN 3 ELSE 2 END AS nxt, CASE WHEN s = 2 THEN 'assistant' ELSE 'user' END AS put,
            CASE WHEN w.nv IS NULL THEN CASE WHEN w.v[s + 1] = 0 THEN '' ELSE 'I' END
                 WHEN 4 + w.nv[s + 1] = w.v[s + 1] THEN 'D'
                 WHEN 3 + w.v[CASE WHEN s = 2 THEN 4 ELSE 3 END] = w.v[s + 1] THEN 'I'
                 WHEN NOT gone AND ((i = 's' AND s = 0) OR (i = 'u' AND s <> 2) OR (i = 'a' AND s = 2))
                    AND e + w.nv[CASE WHEN i = 's' THEN 2 WHEN i = 'u' THEN 3 ELSE 4 END] = w.v[s + 1] THEN 'K' ELSE 'R' END AS l
          FROM t JOIN w ON w.conv_id IS NOT DISTINCT FROM t.conv_id AND w.p = t.p WHERE NOT t.done)),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND (before || i) NOT IN ('su', 'ua', 'au')) AS illegal FROM m GROUP BY conv_id),
a AS (SELECT conv_id, cost, audit, sha256(array_to_string(said, chr(10))) AS sha FROM t WHERE done)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
    CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
    coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM o) o LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM o.conv_id"""
OP12_PREFIX_TRIE = f"""
WITH o AS (SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS t, length(coalesce(text, '')) AS n, turn
    FROM conversations WHERE conv_id IS NOT NULL),
p AS MATERIALIZED (SELECT conv_id, t, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) AS p FROM o),
c AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM p)),
r AS (SELECT c.conv_id, p.p, 0 AS own, t, n FROM c JOIN p ON p.conv_id = c.base AND p.p <= h
    UNION ALL SELECT c.conv_id, p.p, 1 AS own, t, n FROM c JOIN p ON p.conv_id = c.conv_id AND p.p > h),
s AS (SELECT conv_id, list(t ORDER BY own, p) AS ts, list(n ORDER BY own, p) AS ns FROM r GROUP BY conv_id),
m AS MATERIALIZED (SELECT conv_id, d, md5(array_to_string(ts[1:d], '')) AS k, md5(array_to_string(ts[1:d - 1], '')) AS up, ns[d] AS n, d = len(ts) AS last
    FROM (SELECT *, unnest(range(1, len(ts) + 1)) AS d FROM s)
    UNION ALL SELECT c.conv_id, 0, md5(''), NULL, 0, s.conv_id IS NULL FROM c LEFT JOIN s ON s.conv_id = c.conv_id),
g AS MATERIALIZED (SELECT k, any_value(up) AS up, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
    string_agg(CASE WHEN last THEN conv_id END, ',' ORDER BY conv_id) AS ends FROM m GROUP BY k),
k AS (SELECT up, count(*) AS n_children FROM g GROUP BY up),
w AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN k ON k.up = g.k),
a AS (SELECT m.k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * w.n) AS saved
    FROM w JOIN m ON m.conv_id = w.conv_id AND m.d <= w.d GROUP BY m.k)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, z.conv_id AS parent_conv_id, CAST(w.n_convs AS BIGINT) AS n_convs, CAST(w.n_children AS BIGINT) AS n_children,
    CAST(a.n_leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM w JOIN a ON a.k = w.k LEFT JOIN g z ON z.k = w.up"""
_FIVE = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, {10 * (i // 8) + 1}, 10) AS BIGINT) >> {5 * (7 - i % 8)}) & 31 AS INTEGER), 1)"
    for i in range(32)
)
OP13_WARC = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
n AS (SELECT *, row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS nth,
    first_value(page_id) OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS top FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_FIVE} AS payload_digest,
    CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN nth > 1 THEN top END AS refers_to, true AS intact
FROM n"""
