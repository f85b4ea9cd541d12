"""SQL for the text queries that SQL can express."""

from __future__ import annotations

from gridloom.llm.line_dedup import MIN_WORDS
from gridloom.llm.quotes import ANNOUNCES, BLANK, LINE_WORDS, QUOTE

WORDS = r"'[^ \t-\r]+'"
QUOTED, ANNOUNCED, EMPTY = QUOTE.replace("\\\\", "\\"), ANNOUNCES.replace("\\\\", "\\"), BLANK.replace("\\\\", "\\")

LINE_DEDUP = f"""WITH parts AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
lines AS (SELECT doc_id, i, p[i] AS line, len(regexp_extract_all(p[i], {WORDS})) AS n FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM parts)),
w AS (SELECT doc_id, i, line, n, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS at FROM lines WHERE n > 0),
onward AS (SELECT a.doc_id, a.at AS s, b.at AS e, sum(b.n) OVER (PARTITION BY a.doc_id, a.at ORDER BY b.at) AS total FROM w a JOIN w b ON a.doc_id = b.doc_id AND b.at BETWEEN a.at AND a.at + {MIN_WORDS - 1}),
upto AS (SELECT a.doc_id, b.at AS s, a.at AS e, sum(b.n) OVER (PARTITION BY a.doc_id, a.at ORDER BY b.at DESC) AS total FROM w a JOIN w b ON a.doc_id = b.doc_id AND b.at BETWEEN a.at - {MIN_WORDS - 1} AND a.at),
runs AS (SELECT doc_id, s, min(e) AS e FROM onward WHERE total >= {MIN_WORDS} GROUP BY doc_id, s UNION SELECT doc_id, max(s), e FROM upto WHERE total >= {MIN_WORDS} GROUP BY doc_id, e),
texts AS (SELECT r.doc_id, r.s, r.e, string_agg(w.line, chr(10) ORDER BY w.at) AS t FROM runs r JOIN w ON w.doc_id = r.doc_id AND w.at BETWEEN r.s AND r.e GROUP BY r.doc_id, r.s, r.e),
later AS (SELECT doc_id, s, e FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS k FROM texts) WHERE k > 1),
gone AS (SELECT DISTINCT w.doc_id, w.i FROM later l JOIN w ON w.doc_id = l.doc_id AND w.at BETWEEN l.s AND l.e),
counts AS (SELECT l.doc_id, count(*) FILTER (WHERE l.n > 0) AS n_lines, count(g.i) AS n_deleted, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS kept FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT c.doc_id, n_lines, n_deleted, CASE WHEN n_deleted = 0 THEN p.text ELSE coalesce(kept, '') END AS text FROM counts c JOIN parts p ON p.doc_id = c.doc_id"""

THREADS = f"""WITH RECURSIVE m AS (SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
lines AS (SELECT conv_id, turn, i, p[i] AS line FROM (SELECT conv_id, turn, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS p FROM m))),
bodies AS (SELECT conv_id, turn, i, line, len(regexp_replace(regexp_extract(line, '{QUOTED}'), '[^>]', '', 'g')) AS level, lower(trim(regexp_replace(regexp_replace(line, '{QUOTED}', ''), '[ \\t-\\r]+', ' ', 'g'), ' ')) AS body FROM lines),
starts AS (SELECT *, CASE WHEN level <> lag(level) OVER o OR lag(body) OVER o = '' OR lag(level) OVER o IS NULL THEN 1 ELSE 0 END AS first_ FROM bodies WINDOW o AS (PARTITION BY conv_id, turn ORDER BY i)),
numbered AS (SELECT *, sum(first_) OVER (PARTITION BY conv_id, turn ORDER BY i) AS passage FROM starts),
units AS (SELECT conv_id, turn, level, string_agg(body, ' ' ORDER BY i) AS body FROM numbered WHERE body <> '' GROUP BY conv_id, turn, level, passage
  UNION ALL SELECT conv_id, turn, level, body FROM numbered WHERE body <> '' AND len(string_split(body, ' ')) >= {LINE_WORDS}),
originals AS (SELECT conv_id, body, min(turn) AS original FROM units WHERE level = 0 GROUP BY conv_id, body),
linked AS (SELECT u.conv_id, u.turn, u.level, o.original, row_number() OVER (PARTITION BY u.conv_id, u.turn ORDER BY u.level, o.original DESC) AS k FROM units u JOIN originals o ON o.conv_id = u.conv_id AND o.body = u.body WHERE u.level > 0 AND o.original < u.turn),
replies AS (SELECT conv_id, turn, original AS parent_turn FROM linked WHERE k = 1),
up AS (SELECT conv_id, turn, parent_turn AS root, 1 AS depth FROM replies UNION ALL SELECT u.conv_id, u.turn, r.parent_turn, u.depth + 1 FROM up u JOIN replies r ON r.conv_id = u.conv_id AND r.turn = u.root),
ends AS (SELECT conv_id, turn, arg_max(root, depth) AS root_turn, max(depth) AS depth FROM up GROUP BY conv_id, turn),
flags AS (SELECT *, regexp_matches(line, '{QUOTED}') AS q, lead(regexp_matches(line, '{QUOTED}'), 1, false) OVER o AS q1, lead(regexp_matches(line, '{QUOTED}'), 2, false) OVER o AS q2, lead(regexp_matches(line, '{EMPTY}'), 1, false) OVER o AS e1 FROM lines WINDOW o AS (PARTITION BY conv_id, turn ORDER BY i)),
bare AS (SELECT conv_id, turn, bool_or(q) AS quotes, regexp_replace(regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT q AND NOT (regexp_matches(line, '{ANNOUNCED}') AND (q1 OR (e1 AND q2)))), ''), '\\A(?:[ \\t-\\r]*\\n)+', ''), '[ \\t-\\r]+\\z', '') AS text FROM flags GROUP BY conv_id, turn)
SELECT m.conv_id, m.turn, m.role, CASE WHEN b.quotes THEN b.text ELSE m.text END AS text, r.parent_turn, coalesce(e.root_turn, m.turn) AS root_turn, coalesce(e.depth, 0) AS depth
FROM m JOIN bare b ON b.conv_id = m.conv_id AND b.turn = m.turn LEFT JOIN replies r ON r.conv_id = m.conv_id AND r.turn = m.turn LEFT JOIN ends e ON e.conv_id = m.conv_id AND e.turn = m.turn"""

ORACLES = {"op7_quotes": THREADS.replace("\\\\", "\\"), "op9_line_dedup": LINE_DEDUP}
