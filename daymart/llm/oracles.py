"""SQL texts for the operators that SQL can express; the others are tested against brute force."""

_GAP = r"[\x20\x09-\x0D]+"

#: Lines on at least 8 sites go, unless they hold over half of the document's words.
_LINES = rf"""
WITH lines AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents WHERE text IS NOT NULL),
trimmed AS (
    SELECT *, regexp_replace(line, '^{_GAP}|{_GAP}$', '', 'g') AS bare,
           len(list_filter(string_split_regex(line, '{_GAP}'), lambda x: x <> '')) AS words
    FROM lines),
spread AS (
    SELECT bare FROM trimmed WHERE words >= 3 AND source IS NOT NULL
    GROUP BY bare HAVING count(DISTINCT source) >= 8),
marked AS (SELECT *, words >= 3 AND bare IN (SELECT bare FROM spread) AS gone FROM trimmed),
pages AS (
    SELECT doc_id, sum(words) AS total, coalesce(sum(words) FILTER (gone), 0) AS spread_words, count(*) AS n_lines,
           count(*) FILTER (gone) AS n_gone, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS rest
    FROM marked GROUP BY doc_id)
SELECT d.doc_id,
       CASE WHEN n_gone > 0 AND spread_words <= 0.5 * total THEN coalesce(rest, '') ELSE d.text END AS text,
       coalesce(n_lines, 0) AS n_lines,
       CASE WHEN n_gone > 0 AND spread_words <= 0.5 * total THEN n_gone ELSE 0 END AS n_removed
FROM documents d LEFT JOIN pages USING (doc_id)
"""

#: All pairs that share a shingle, counted; then everything reachable.
_NEAR = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_GAP}'), lambda x: x <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
    FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
    SELECT doc_id, doc_id AS r FROM documents
    UNION
    SELECT l.b AS doc_id, reach.r FROM reach JOIN links l ON l.a = reach.doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""



def _edit(state: str, cost: str, edit: str) -> str:
    """A state of the programme over edits, its cost in ten digits and then its edits, with one edit more."""
    return f"lpad(CAST(CAST(left({state}, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || substr({state}, 11) || '{edit}'"


_CRC = """xor(4294967295, list_reduce(
        list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, b: list_reduce(
            list_concat([xor(crc, b)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, CAST(3988292384 AS BIGINT) * (v & 1)))))"""

#: Forward over the rows: for each state of the automaton the least pair of cost and edits.  s0: nothing yet, s1: system, s2: user, s3: assistant.
_TURNS = rf"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
    FROM conversations),
harmed AS (SELECT *, {_CRC} % 20 AS harm FROM named),
damaged AS (
    SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
           CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN harm = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM harmed WHERE harm <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
           left(role, 1) AS r, regexp_replace(text, '{_GAP}$', '') AS bare
    FROM damaged),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM placed),
faults AS (
    SELECT *, bare = '' AS blank, bare <> '' AND nth > 1 AS repeated,
           bare <> '' AND nth = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS cut
    FROM ranked),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
           count(*) FILTER (repeated) AS duplicate, count(*) FILTER (cut) AS truncated,
           count(*) FILTER (prev IS NOT NULL AND prev || r NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id),
walk AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '0000000000' AS s0, CAST(NULL AS VARCHAR) AS s1, CAST(NULL AS VARCHAR) AS s2, CAST(NULL AS VARCHAR) AS s3
    FROM conversations
    UNION ALL
    SELECT conv_id, i, {_edit("s0", "4", "D")}, least({_edit("s1", "4", "D")}, k1), least({_edit("s2", "4", "D")}, k2), least({_edit("s3", "4", "D")}, k3)
    FROM (
        SELECT conv_id, i, s0, s1, s2, s3, CASE WHEN ok AND r = 's' THEN {_edit("s0", "extra", "K")} END AS k1,
               CASE WHEN ok THEN least(
                   CASE WHEN r = 'u' THEN least({", ".join(_edit(s, "extra", "K") for s in ("s0", "s1", "s3"))}) END,
                   {", ".join(_edit(s, "3 + extra", "R") for s in ("s0", "s1", "s3"))}) END AS k2,
               CASE WHEN ok THEN least(CASE WHEN r = 'a' THEN {_edit("s2", "extra", "K")} END, {_edit("s2", "3 + extra", "R")}) END AS k3
        FROM (
            SELECT conv_id, i, r, ok, extra, s0, s1, s2, least(s3, {_edit("s2", "3", "I")}) AS s3
            FROM (
                SELECT w.conv_id, f.i, f.r, NOT f.blank AND NOT f.repeated AS ok, CASE WHEN f.cut THEN 3 ELSE 0 END AS extra, s0, s1,
                       least(s2, {", ".join(_edit(s, "3", "I") for s in ("s0", "s1", "s3"))}) AS s2, s3
                FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1)))),
ended AS (SELECT conv_id, arg_max(s0, i) AS s0, max_by(coalesce(s1, ''), i) AS s1, max_by(coalesce(s2, ''), i) AS s2, max_by(coalesce(s3, ''), i) AS s3
          FROM walk GROUP BY conv_id),
chosen AS (
    SELECT conv_id, least(s0, s3, {_edit("least(s2, " + _edit("s0", "3", "I") + ", " + _edit("s1", "3", "I") + ")", "3", "I")}) AS best
    FROM (SELECT conv_id, s0, nullif(s1, '') AS s1, nullif(s2, '') AS s2, nullif(s3, '') AS s3 FROM ended)),
repaired AS (SELECT conv_id, CAST(left(best, 10) AS BIGINT) AS cost, substr(best, 11) AS audit FROM chosen),
edits AS (
    SELECT conv_id, k, edit, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER w AS i, sum(CASE WHEN edit <> 'D' THEN 1 ELSE 0 END) OVER w AS e
    FROM (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS k FROM repaired WHERE audit <> '')
    WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
told AS (
    SELECT e.*, f.role, f.text, max(CASE WHEN e.e = 1 AND edit = 'K' AND f.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS headed
    FROM edits e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i AND e.edit <> 'I'),
texts AS (
    SELECT conv_id, sha256(string_agg(
        CASE WHEN edit = 'K' THEN role ELSE CASE WHEN (e - headed) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':'
        || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS digest
    FROM told WHERE edit <> 'D' GROUP BY conv_id)
SELECT r.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, cost, audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM repaired r LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM r.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM r.conv_id
"""

ORACLES: dict[str, str] = {"op2_line_spread": _LINES, "op10_minhash_join": _NEAR, "op13_turn_repair": _TURNS}
