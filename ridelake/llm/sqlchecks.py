"""SQL checks of the conversation operators."""

from __future__ import annotations

#: The CRC-32 of an ASCII string, from its table of 256 entries made by rule; used as {crc('...')} with crc_table in FROM.
_CRC_TABLE = """bits(n, v, k) AS (
  SELECT n, n, 0 FROM range(256) AS r(n)
  UNION ALL SELECT n, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY n) AS crc_of FROM bits WHERE k = 8)"""


def _crc(text: str) -> str:
    bytes_ = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    step = "lambda a, b: xor(a // 256, crc_of[xor(a % 256, b) + 1])"
    return f"xor(4294967295, list_reduce({bytes_}, {step}, 4294967295::BIGINT))"


def _way(label: str, cost: str, edit: str) -> str:
    """A way one edit longer: ways are six digits of cost and then the audit, so the least text is the best way."""
    return f"(lpad((left({label}, 6)::INT + {cost})::VARCHAR, 6, '0') || substr({label}, 7) || '{edit}')"


def _least(*ways: str) -> str:
    return f"least({', '.join(ways)})"


_R2 = _least(*(_way(w, "2 + more", "R") for w in ("w0", "w1", "w3")))
_K2 = _least(*(_way(w, "more", "K") for w in ("w0", "w1", "w3")))

REPAIR = rf"""
WITH RECURSIVE {_CRC_TABLE},
drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS draw
  FROM conversations, crc_table),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, range(2) AS r(copy) WHERE draw <> 0 AND (copy = 0 OR draw = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM rows_)),
judged AS (
  SELECT *, left(role, 1) AS mine, CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS met
  FROM placed),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (met NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id),
walk(conv_id, i, w0, w1, w2, w3) AS (
  SELECT conv_id, 0::BIGINT, '000000', NULL::VARCHAR, '000002I', '000004II' FROM faults
  UNION ALL
  SELECT conv_id, i, v0, v1, {_least("v2", *(_way(v, "2", "I") for v in ("v0", "v1", "v3")))},
    {_least("v3", _way(_least("v2", *(_way(v, "2", "I") for v in ("v0", "v1"))), "2", "I"))}
  FROM (
    SELECT conv_id, i, {_way("w0", "3", "D")} AS v0,
      {_least(_way("w1", "3", "D"), f"CASE WHEN stays AND mine = 's' THEN {_way('w0', 'more', 'K')} END")} AS v1,
      {_least(_way("w2", "3", "D"), f"CASE WHEN stays THEN {_R2} END", f"CASE WHEN stays AND mine = 'u' THEN {_K2} END")} AS v2,
      {_least(_way("w3", "3", "D"), f"CASE WHEN stays THEN {_way('w2', '2 + more', 'R')} END",
              f"CASE WHEN stays AND mine = 'a' THEN {_way('w2', 'more', 'K')} END")} AS v3
    FROM (
      SELECT j.conv_id, j.i, mine, fault IN ('none', 'truncated') AS stays, (fault = 'truncated')::INT AS more, w0, w1, w2, w3
      FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1))),
best AS (
  SELECT f.*, left(least(w0, w3), 6)::BIGINT AS cost, substr(least(w0, w3), 7) AS audit
  FROM faults f JOIN walk w ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = f.n),
edits AS (
  SELECT conv_id, p, substr(audit, p::INT, 1) AS edit FROM best, unnest(range(1, length(audit) + 1)) AS r(p)),
numbered AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i,
    count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS k
  FROM edits),
out_ AS (
  SELECT n.conv_id, n.k, n.edit, j.role, j.text, n.edit = 'K' AND n.k = 1 AND j.mine = 's' AS leads
  FROM numbered n LEFT JOIN judged j ON n.edit <> 'I' AND j.conv_id IS NOT DISTINCT FROM n.conv_id AND j.i = n.i
  WHERE n.edit <> 'D'),
due AS (SELECT *, CASE WHEN (k + bool_or(leads) OVER (PARTITION BY conv_id)::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END AS due FROM out_),
repaired AS (
  SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role ELSE due END || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS body
  FROM due GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""

TRIE = rf"""
WITH RECURSIVE {_CRC_TABLE},
turns AS (
  SELECT conv_id, md5(length(role)::VARCHAR || ':' || role || text) AS name, length(text) AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
sizes AS (SELECT DISTINCT name, size FROM turns),
convs AS (SELECT DISTINCT conv_id, {_crc("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
steps AS (
  SELECT c.conv_id, 0 AS part, place, name FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND place <= h
  UNION ALL SELECT c.conv_id, 1, place, name FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND place > h),
members AS (
  SELECT conv_id, coalesce(path, '') AS path
  FROM convs LEFT JOIN (SELECT conv_id, string_agg(name, '' ORDER BY part, place) AS path FROM steps GROUP BY conv_id) USING (conv_id)),
through AS (
  SELECT conv_id, left(path, (32 * d)::INT) AS node, d, length(path) = 32 * d AS ends
  FROM members, unnest(range(0, length(path) // 32 + 1)) AS r(d)),
nodes AS (
  SELECT node, d, min(conv_id) AS first, count(*) AS n, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends
  FROM through GROUP BY node, d),
kids AS (SELECT left(node, (32 * (d - 1))::INT) AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
own AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children, coalesce((n - 1) * size, 0) AS saved
  FROM nodes LEFT JOIN kids USING (node) LEFT JOIN sizes ON name = right(node, 32)),
sums AS (
  SELECT left(node, (32 * up)::INT) AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM own, unnest(range(0, d + 1)) AS r(up) GROUP BY 1)
SELECT o.first AS conv_id, o.d::BIGINT AS depth, p.first AS parent_conv_id, o.n AS n_convs, o.n_children::BIGINT AS n_children,
  n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(o.ends) AS ends_sha256
FROM own o JOIN sums USING (node) LEFT JOIN nodes p ON o.d > 0 AND p.node = left(o.node, (32 * (o.d - 1))::INT)
"""
