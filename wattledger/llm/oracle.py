"""SQL that each query must equal, where SQL can say it; written from the definitions."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op2_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), whole AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text)
                 FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(length(role) + length(text) + length('<|turn|><|end|>') + 1
            + length(role || text) - length(replace(role || text, '\', ''))
            + length(role) - length(replace(role, chr(10), ''))
            + length(regexp_replace(role || chr(10) || text,
                                    '<\||</?s>|\[/?INST\]', '\0~', 'g'))
            - length(role) - length(text) - 1) AS formatted_chars
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
    sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM whole
"""

ORACLE_SQL["op6_url_filter"] = r"""
WITH rules(host, path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), parts AS (
    SELECT row_number() OVER () AS n, page_id,
        CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), read AS (
    SELECT n, page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM parts
), split AS (
    SELECT n, page_id,
        translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM read
), best AS (
    SELECT s.n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
        arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM split s JOIN rules r
      ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
    GROUP BY s.n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN best USING (n)
"""

ORACLE_SQL["op3_vector_search"] = r"""
WITH good AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), asking AS (
    SELECT vec_id, min(v) AS v FROM good WHERE vec_id % 50 = 0 GROUP BY vec_id
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)
        / (sqrt(list_inner_product(q.v, q.v)) * sqrt(list_inner_product(c.v, c.v))) AS score
    FROM asking q JOIN good c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score
FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""

ORACLE_SQL["op8_exact_topk"] = r"""
WITH good AS (
    SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), asking AS (
    SELECT vec_id, min(v) AS v FROM good WHERE vec_id % 50 = 0 GROUP BY vec_id
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM asking q JOIN good c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score
FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""

ORACLE_SQL["op11_hard_negatives"] = r"""
WITH good AS (
    SELECT DISTINCT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v,
        CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), anchors AS (
    SELECT vec_id, min({'label': label, 'v': v}) AS own FROM good
    WHERE vec_id % 50 = 0 GROUP BY vec_id
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.own.label AS same,
        list_inner_product(a.own.v, c.v)::BIGINT AS score
    FROM anchors a JOIN good c ON c.vec_id <> a.vec_id AND len(c.v) = len(a.own.v)
), positives AS (
    SELECT anchor_id, vec_id, score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
    (row_number() OVER w)::INTEGER AS rank, n.vec_id AS negative_id,
    p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n
  ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY rank <= 3
"""

ORACLE_SQL["op12_prefix_trie"] = r"""
WITH digits AS (
    -- CRC-32, a byte at a time: 0 to 255 is the byte, -1 a step of one bit.
    SELECT DISTINCT conv_id, flatten([
        [4294967295], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
            lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))]) AS steps
    FROM conversations WHERE conv_id IS NOT NULL
), known AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295::BIGINT, list_reduce(
        list_transform(steps, lambda s: s::BIGINT), lambda crc, s: CASE WHEN s >= 0
            THEN xor(crc, s) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END)) % 9 AS h
    FROM digits
), turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(
            length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')),
            1, 32), strlen(coalesce(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
    SELECT k.conv_id, 0 AS part, t.place, t.role, t.text
    FROM known k JOIN turns t ON t.conv_id = k.base AND t.place <= k.h
    UNION ALL
    SELECT k.conv_id, 1, t.place, t.role, t.text
    FROM known k JOIN turns t ON t.conv_id = k.conv_id AND t.place > k.h
), lists AS (
    SELECT k.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.part, r.place)
        FILTER (WHERE r.part IS NOT NULL), []) AS own
    FROM known k LEFT JOIN rebuilt r USING (conv_id) GROUP BY k.conv_id
), members AS (
    SELECT conv_id, len(own) AS turns, unnest(range(len(own) + 1)) AS depth, own FROM lists
), nodes AS (
    SELECT depth, own[:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
        max(turns) = depth AS childless,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
            FILTER (WHERE turns = depth), '')) AS ends_sha256,
        CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(own[:depth][depth].text) END AS saved
    FROM members GROUP BY depth, prefix
), ancestors AS (
    SELECT prefix[:d] AS top, d, childless, saved, depth
    FROM (SELECT *, unnest(range(depth + 1)) AS d FROM nodes)
), subtrees AS (
    SELECT top, d, count(*) FILTER (WHERE depth = d + 1) AS n_children,
        count(*) FILTER (WHERE childless) AS n_leaves, sum(saved) AS saved_tokens
    FROM ancestors GROUP BY top, d
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
    s.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n
JOIN subtrees s ON s.d = n.depth AND s.top = n.prefix
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[:n.depth - 1]
"""

ORACLE_SQL["op13_line_dedup"] = r"""
WITH lines AS (
    SELECT n, doc_id, generate_subscripts(l, 1) AS place, unnest(l) AS line
    FROM (SELECT row_number() OVER () AS n, doc_id,
            string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, min(doc_id) AS first_id FROM keyed
    WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
    SELECT k.*, coalesce(k.doc_id <> r.first_id, false) AS gone
    FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY n, doc_id
"""
