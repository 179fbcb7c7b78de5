"""The same results in SQL, where SQL can express them."""

#: Conversations rebuilt by list operations, nodes by grouping list prefixes; CRC-32 is worked out bit by bit.
OP11 = """
WITH filled AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
    SELECT conv_id, role, text, row_number() OVER (
        PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, to_base64(unhex(substr(sha256(octet_length(encode(role)) || ':' || role || text), 1, 36)))) AS pos
    FROM filled
), own AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS t FROM turns GROUP BY conv_id
), hosted AS (
    SELECT o.conv_id, o.t, coalesce(x.t, []) AS host,
           xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(o.conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, byte: list_reduce(
                   [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda bits, unused: xor(bits >> 1, 3988292384 * (bits & 1))))) % 6 AS h
    FROM own o LEFT JOIN own x ON x.conv_id = o.conv_id - o.conv_id % 100
), built AS (
    SELECT conv_id, list_concat(host[1:h], t[h + 1:]) AS t FROM hosted
), prefixes AS (
    SELECT conv_id, d, t[1:d] AS prefix, len(t) = d AS whole, t[d].text AS last
    FROM (SELECT conv_id, t, unnest(range(len(t) + 1)) AS d FROM built)
), nodes AS (
    SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(length(any_value(last)), 0) AS chars,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (whole), '')) AS ends_sha256
    FROM prefixes GROUP BY d, prefix
), kids AS (
    SELECT prefix[1:d - 1] AS prefix, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), counted AS (
    SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (prefix)
), above AS (
    SELECT prefix[1:up] AS prefix, n_children, (n_convs - 1) * chars AS saved
    FROM (SELECT *, unnest(range(d + 1)) AS up FROM counted)
), below AS (
    SELECT prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY prefix
)
SELECT c.conv_id, c.d::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, b.n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN below b USING (prefix) LEFT JOIN counted p ON c.d > 0 AND p.prefix = c.prefix[1:c.d - 1]
"""

#: A character class of RE2 as the contract states it; whole-number division of 128-bit numbers.
OP13 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*)::HUGEINT AS total FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), langs AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n_lang FROM kept GROUP BY lang
), uses AS (
    SELECT lang, source, term, count(*)::HUGEINT AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
    SELECT g.lang, g.source, coalesce(s.n_group, 0)::HUGEINT AS n_group
    FROM (SELECT DISTINCT lang, source FROM docs) g
    LEFT JOIN (SELECT lang, source, sum(n) AS n_group FROM uses GROUP BY lang, source) s USING (lang, source)
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n, 1 + (1000000000 * (coalesce(u.n, 0) + 2)) // (g.n_group + 2 * l.v) AS p,
           1 + (1000000000 * (k.total + 2)) // (l.n_lang + 2 * l.v) AS of_lang
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN uses u USING (lang, source, term)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - of_lang) * (p - of_lang)) // (p + of_lang) FROM shares WHERE n > 0 AND p > of_lang
)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM rows
QUALIFY part = 'pair' OR rank <= 10
"""

ORACLE: dict[str, str] = {"op11_prefix_ranges": OP11, "op13_source_pairs": OP13}
