"""Check SQL of the queries that SQL can express."""

MIXING = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         CAST('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15) AS BIGINT) AS h
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, (2 * source_size)::DOUBLE AS most, (2 * source_size)::DOUBLE / weight AS ratio,
         sum(source_size) OVER ()::DOUBLE * 1.5 AS asked, sum(weight) OVER () AS all_w
  FROM per
), levels AS (
  SELECT *, (asked - coalesce(sum(most) OVER before, 0.0)) / (all_w - coalesce(sum(weight) OVER before, 0.0)) AS level
  FROM filled WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0 ELSE least(most, (SELECT max(level) FROM levels WHERE level <= ratio) * weight) END::DOUBLE AS target
  FROM levels
), placed AS (
  SELECT s.*, t.source_size, t.target, floor(t.target / greatest(t.source_size, 1))::BIGINT AS full_passes,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), parts AS (
  SELECT *, target - full_passes * source_size AS part, start + size <= target - full_passes * source_size AS whole FROM placed
), gaps AS (
  SELECT source, first(part) - coalesce(sum(CASE WHEN whole THEN size END), 0) AS gap FROM parts GROUP BY source
), picks AS (
  SELECT p.source, min({'off': abs(p.size - g.gap), 'start': p.start}) AS pick
  FROM parts p JOIN gaps g ON p.source IS NOT DISTINCT FROM g.source
  WHERE NOT p.whole AND p.size > 0 AND abs(p.size - g.gap) < g.gap GROUP BY p.source
)
SELECT p.doc_id, p.size, p.source_size, p.target,
       (p.size * (p.full_passes + CASE WHEN p.whole AND p.part > 0 OR p.start = k.pick.start AND p.size > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM parts p LEFT JOIN picks k ON p.source IS NOT DISTINCT FROM k.source
"""

WARC = r"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hexed FROM pages
), coded AS (
  SELECT page_id, payload_bytes, list_aggregate(list_transform(range(1, 41, 5), lambda i: list_aggregate(list_transform([15, 10, 5, 0],
           lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(hexed, i, 5) AS BIGINT) >> b) & 31) + 1, 1)), 'string_agg', '')),
         'string_agg', '') AS payload_digest
  FROM hashed
), classed AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM coded
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM classed
"""

PREFIX_TRIE = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, list(said ORDER BY pos) AS own,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
             lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384))), 4294967295) % 6 AS h
  FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS said
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 100
), prefixes AS (
  SELECT conv_id, d AS depth, said[1:d] AS path, len(said) = d AS at_end, CASE WHEN d = 0 THEN 0 ELSE length(said[d].text) END AS chars
  FROM rebuilt, unnest(range(0, len(said) + 1)) AS u(d)
), nodes AS (
  SELECT depth, sha256(path::VARCHAR) AS node, sha256(path[1:depth - 1]::VARCHAR) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
         max(path) AS path, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (at_end), '') AS ends
  FROM prefixes GROUP BY ALL
), above AS (
  SELECT n.*, sha256(n.path[1:a]::VARCHAR) AS top, a AS top_depth FROM nodes n, unnest(range(0, n.depth + 1)) AS u(a)
), parents AS (
  SELECT up, depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up, depth
), sums AS (
  SELECT a.top, a.top_depth, sum((a.n_convs - 1) * a.chars)::BIGINT AS saved_tokens, sum(CASE WHEN p.up IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves
  FROM above a LEFT JOIN parents p ON p.up = a.node AND p.depth = a.depth + 1 GROUP BY ALL
)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(p.n_children, 0)::BIGINT AS n_children, s.n_leaves, s.saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM nodes n JOIN sums s ON s.top = n.node AND s.top_depth = n.depth
LEFT JOIN nodes m ON n.depth > 0 AND m.node = n.up AND m.depth = n.depth - 1
LEFT JOIN parents p ON p.up = n.node AND p.depth = n.depth + 1
"""
