"""DuckDB SQL of the longer queries of this subpackage."""

from __future__ import annotations

#: The byte table of CRC-32 (a list of 256 numbers), made bit by bit.
CRC = """crc AS (SELECT list_transform(range(256), lambda c: list_reduce([c, 1, 1, 1, 1, 1, 1, 1, 1],
        lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t)"""

REPAIR = """
WITH RECURSIVE """ + CRC + """,
c0 AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
            lambda x: ord(x)::BIGINT)), lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8))) % 20 AS kind FROM conversations, crc),
c1 AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM c0 WHERE kind <> 0),
c2 AS (SELECT *, rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS shown,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM c1),
c3 AS (SELECT *, substr(role, 1, 1) AS r, CASE WHEN shown = '' THEN 'b'
          WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
          WHEN right(shown, 1) IN ('.', '!', '?') THEN 'f' ELSE 't' END AS fault,
        lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p FROM c2),
-- the cheapest, then least edits that end in no turn, system, user, assistant: struct(cost, edits, repaired lines)
dp AS (
  SELECT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': '', 't': ''} AS s0, {'c': 1000000000::BIGINT, 'a': '', 't': ''} AS s1,
         {'c': 1000000000::BIGINT, 'a': '', 't': ''} AS s2, {'c': 1000000000::BIGINT, 'a': '', 't': ''} AS s3
  FROM (SELECT DISTINCT conv_id FROM c3)
  UNION ALL
  SELECT conv_id, i, {'c': s0.c + 3, 'a': s0.a || 'D', 't': s0.t},
    list_min([{'c': s1.c + 3, 'a': s1.a || 'D', 't': s1.t}] ||
      CASE WHEN keep AND r = 's' THEN [{'c': s0.c + cut, 'a': s0.a || 'K', 't': s0.t || chr(10) || own}] ELSE [] END),
    list_min([{'c': s2.c + 3, 'a': s2.a || 'D', 't': s2.t}] || CASE WHEN NOT keep THEN [] ELSE
      flatten(list_transform([{'s': s0, 'd': 0, 'e': '', 'x': ''}, {'s': s1, 'd': 0, 'e': '', 'x': ''}, {'s': s3, 'd': 0, 'e': '', 'x': ''},
          {'s': s2, 'd': 2, 'e': 'I', 'x': chr(10) || 'assistant:'}], lambda y:
        [{'c': y.s.c + y.d + 2 + cut, 'a': y.s.a || y.e || 'R', 't': y.s.t || y.x || chr(10) || 'user:' || text}] ||
        CASE WHEN r = 'u' THEN [{'c': y.s.c + y.d + cut, 'a': y.s.a || y.e || 'K', 't': y.s.t || y.x || chr(10) || own}] ELSE [] END)) END),
    list_min([{'c': s3.c + 3, 'a': s3.a || 'D', 't': s3.t}] || CASE WHEN NOT keep THEN [] ELSE
      flatten(list_transform([{'s': s2, 'd': 0, 'e': '', 'x': ''}, {'s': s0, 'd': 2, 'e': 'I', 'x': chr(10) || 'user:'},
          {'s': s1, 'd': 2, 'e': 'I', 'x': chr(10) || 'user:'}, {'s': s3, 'd': 2, 'e': 'I', 'x': chr(10) || 'user:'}], lambda y:
        [{'c': y.s.c + y.d + 2 + cut, 'a': y.s.a || y.e || 'R', 't': y.s.t || y.x || chr(10) || 'assistant:' || text}] ||
        CASE WHEN r = 'a' THEN [{'c': y.s.c + y.d + cut, 'a': y.s.a || y.e || 'K', 't': y.s.t || y.x || chr(10) || own}] ELSE [] END)) END)
  FROM (SELECT d.conv_id, c3.i, s0, s1, s2, s3, r, text, role || ':' || text AS own, fault NOT IN ('b', 'd') AS keep,
               CASE WHEN fault = 't' THEN 1 ELSE 0 END AS cut
        FROM dp d JOIN c3 ON c3.conv_id IS NOT DISTINCT FROM d.conv_id AND c3.i = d.i + 1)),
done AS (SELECT conv_id, list_min([s0, {'c': s1.c + 4, 'a': s1.a || 'II', 't': s1.t || chr(10) || 'user:' || chr(10) || 'assistant:'},
           {'c': s2.c + 2, 'a': s2.a || 'I', 't': s2.t || chr(10) || 'assistant:'}, s3]) AS s
         FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS last FROM dp) WHERE last = 1),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
        count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
        count(*) FILTER (WHERE i > 1 AND p || r NOT IN ('su', 'ua', 'au')) AS illegal FROM c3 GROUP BY 1)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(s.c, 0) AS cost, coalesce(s.a, '') AS audit, sha256(coalesce(substr(s.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id"""

VARIANTS = """
WITH RECURSIVE """ + CRC + """,
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM r GROUP BY 1, 2),
h AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, len(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
             lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8))) AS h FROM g, crc),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
      FROM h GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2),
b AS (SELECT word, n, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM b a JOIN b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
      UNION SELECT b.word, w.word, w.n FROM b JOIN w ON w.word = b.l || b.r
      UNION SELECT w.word, b.word, b.n FROM b JOIN w ON w.word = b.l || b.r),
k AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS top, max(near_n) AS top_n FROM p GROUP BY 1),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 10 * w.n THEN top END AS form,
             CASE WHEN top_n >= 10 * w.n THEN top_n END AS form_n FROM w LEFT JOIN k USING (word)),
z AS (SELECT word, word AS root, 0 AS d FROM f UNION ALL SELECT z.word, f.form, d + 1 FROM z JOIN f ON f.word = z.root WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, arg_max(root, d) AS root FROM z GROUP BY 1) USING (word)"""
