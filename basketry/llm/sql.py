"""DuckDB SQL for the ``opN_*`` queries whose contract SQL can state.

Each statement follows the contract by the plainest way (all windows, all
shared shingles, whole prefixes), not the operator's method, so the two have
nothing in common but the result. Repeats and shingles are compared by md5.
Rows are told apart by their number, since ids may repeat. Long texts are cut
into overlapping pieces before their windows are listed, which keeps
substrings short. Ids are taken to be known, as in the given tables."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _runs(repeats: str, size: int) -> str:
    """CTEs ``spans`` (r, a, b) and ``gaps`` (r, f, t, b): maximal runs covered
    by windows of ``size`` that begin at ``repeats`` (r, s), and what precedes each."""
    return f"""
begun AS (SELECT r, s, CASE WHEN s - lag(s) OVER (PARTITION BY r ORDER BY s) <= {size} THEN 0 ELSE 1 END AS fresh FROM {repeats}),
numbered AS (SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS g FROM begun),
spans AS (SELECT r, min(s) AS a, max(s) + {size} AS b FROM numbered GROUP BY r, g),
gaps AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS f, a AS t, b FROM spans)"""


OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT r, h, unnest(range(0, greatest(length(h) // 2 - 199, 0), 1000)) AS base FROM d),
pieces AS (SELECT r, base, substr(h, 2 * base + 1, 2 * 1199) AS piece, least(1000, length(h) // 2 - 199 - base) AS n FROM starts),
places AS (SELECT r, base, piece, unnest(range(0, n)) AS i FROM pieces),
windows AS (SELECT r, base + i AS s, md5(substr(piece, 2 * i + 1, 400)) AS k FROM places),
twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
repeats AS (SELECT r, s FROM windows JOIN twice USING (k)),
{_runs('repeats', 200)},
cut AS (SELECT r, sum(b - t) AS n_removed, count(*) AS n_spans, max(b) AS behind,
               string_agg(substr(h, 2 * f + 1, 2 * (t - f)), '' ORDER BY f) AS before
        FROM gaps JOIN d USING (r) GROUP BY r)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN behind IS NULL THEN h ELSE before || substr(h, 2 * behind + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents),
starts AS (SELECT r, words, unnest(range(0, len(words) - 4, 100)) AS base FROM d WHERE len(words) >= 5),
pieces AS (SELECT r, words[base + 1:base + 104] AS piece, least(100, len(words) - 4 - base) AS n FROM starts),
places AS (SELECT r, piece, unnest(range(1, n + 1)) AS i FROM pieces),
sets AS (SELECT DISTINCT r, md5(array_to_string(piece[i:i + 4], ' ')) AS k FROM places
         UNION SELECT r, md5(array_to_string(words, ' ')) FROM d WHERE len(words) BETWEEN 1 AND 4),
sizes AS (SELECT r, count(*) AS n FROM sets GROUP BY r),
common AS (SELECT x.r AS a, y.r AS b, count(*) AS n FROM sets x JOIN sets y ON x.k = y.k AND x.r < y.r GROUP BY ALL),
links AS (SELECT a, b FROM common c JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (WITH RECURSIVE reached(a, b) AS (
            SELECT r, r FROM d UNION SELECT reached.a, both_ways.b FROM reached JOIN both_ways ON reached.b = both_ways.a)
          SELECT a AS r, min(doc_id) AS component_id FROM reached JOIN d ON d.r = reached.b GROUP BY reached.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN reach USING (r) LEFT JOIN sizes USING (r)
"""

OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
starts AS (SELECT r, doc_id, words, unnest(range(0, greatest(len(words) - 49, 0), 200)) AS base FROM d),
pieces AS (SELECT r, doc_id, base, words[base + 1:base + 249] AS piece, least(200, len(words) - 49 - base) AS n FROM starts),
places AS (SELECT r, doc_id, base, piece, unnest(range(0, n)) AS i FROM pieces),
windows AS (SELECT r, doc_id, base + i AS s, md5(array_to_string(piece[i + 1:i + 50], ' ')) AS k FROM places),
least_id AS (SELECT k, min(doc_id) AS first_id FROM windows GROUP BY k),
repeats AS (SELECT r, s FROM windows JOIN least_id USING (k) WHERE doc_id > first_id),
{_runs('repeats', 50)},
cut AS (SELECT r, sum(b - t) AS n_removed, max(b) AS behind, flatten(list(words[f + 1:t] ORDER BY f)) AS before
        FROM gaps JOIN d USING (r) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN behind IS NULL THEN words ELSE before || words[behind + 1:] END, ' ')) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

# unsigned crc32 of a decimal id, bit by bit
_CRC32 = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, unused: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)), 4294967295::UBIGINT)"""

OP11 = f"""
WITH own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
                    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS head, ({_CRC32} % 9)::BIGINT AS h FROM (SELECT DISTINCT conv_id FROM own)),
taken AS (SELECT c.conv_id, 0 AS part, place, role, text FROM convs c JOIN own o ON o.conv_id = c.head AND o.place <= c.h
          UNION ALL SELECT c.conv_id, 1, place, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.place > c.h),
rebuilt AS (SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS bytes,
                   list(md5(role) || md5(text)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS said
            FROM taken WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)),
prefixes AS (SELECT conv_id, depth, bytes, md5(array_to_string(said, '')) AS k,
                    CASE WHEN depth = 1 THEN 'root' ELSE md5(array_to_string(said[:-2], '')) END AS up FROM rebuilt
             UNION ALL SELECT conv_id, 0, 0, 'root', NULL FROM convs),
lasts AS (SELECT conv_id, max(depth) AS turns FROM prefixes GROUP BY conv_id),
nodes AS (SELECT depth, k, any_value(up) AS up, min(p.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
                 coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (WHERE turns = depth), '') AS ends
          FROM prefixes p JOIN lasts USING (conv_id) GROUP BY depth, k),
children AS (SELECT depth - 1 AS depth, up AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, k)),
below AS (SELECT p.depth, p.k, sum(saved) AS saved_tokens, sum((n_children = 0)::INT) AS n_leaves
          FROM known n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.depth, p.k)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM known n JOIN below USING (depth, k) LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.k = n.up
"""

# a control string (or one with the other opening bracket) that gets one more backslash
_CONTROL = r"[<\[]\\*(?:\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)"

OP12 = rf"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (SELECT *, length('<|im_start|><|im_sep|><|im_end|>') + length(role) + length(text)
                  + len(regexp_extract_all(role, '{_CONTROL}')) + len(regexp_extract_all(text, '{_CONTROL}')) AS chars FROM turns),
whole AS (SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
                 string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
                 coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss
          FROM marked GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       chars::BIGINT AS formatted_chars
FROM whole
"""

OP13 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{UNIT}') AS units,
                  sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS draw FROM documents),
drawn AS (SELECT *, len(units) AS n, list_transform([1, 9, 17, 25], lambda place: ('0x' || substr(draw, place, 8))::BIGINT) AS h FROM d),
cuts AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
                     WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s FROM cuts)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
