"""Longer SQL twins of the queries, for DuckDB. They share no step with the operators."""

from __future__ import annotations

#: Characters that separate words.
BLANKS = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def before(letter: str, cost: object, rest: str) -> str:
    """A way written as nine digits of cost and its letters, with one edit put before it."""
    return f"(lpad(CAST(CAST(substr({rest}, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({rest}, 10))"


def row_edits(state: str, keeps: str, follows: str) -> str:
    """Cheapest way from ``state`` over one row; strings compare like (cost, letters)."""
    return (f"CASE WHEN forced THEN {before('D', 4, state)} ELSE least({before('D', 4, state)}, "
            f"CASE {keeps} END, {before('R', '3 + stays', follows)}) END")


KEEP_USER = f"WHEN ini = 'u' THEN {before('K', 'stays', 'w.u')}"
AFTER = {
    "z": row_edits("w.z", f"{KEEP_USER} WHEN ini = 's' THEN {before('K', 'stays', 'w.s')}", "w.u"),
    "s": row_edits("w.s", KEEP_USER, "w.u"),
    "u": row_edits("w.u", f"WHEN ini = 'a' THEN {before('K', 'stays', 'w.a')}", "w.a"),
    "a": row_edits("w.a", KEEP_USER, "w.u"),
}

OP13_SQL = f"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT CAST(range AS BIGINT) AS n FROM range(256))
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), coded AS (
  SELECT named.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS INTEGER)])), 4294967295) % 20 AS code FROM named, tab
), hurt AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM coded
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS k, rtrim(text, {BLANKS}) AS bare, left(role, 1) AS ini
  FROM hurt
), seen AS (
  SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS again,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY k) AS previous FROM placed
), judged AS (
  SELECT *, blank OR again AS forced, CASE WHEN NOT blank AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS stays FROM seen
), ways AS (
  SELECT conv_id, max(k) AS k, '000000000' AS z, '000000006II' AS s, '000000003I' AS u, '000000000' AS a FROM judged GROUP BY conv_id
  UNION ALL
  SELECT conv_id, k - 1, least(z, {before('I', 3, 'u')}, {before('I', 3, before('I', 3, 'a'))}), least(s, {before('I', 3, 'u')}, {before('I', 3, before('I', 3, 'a'))}),
    least(u, {before('I', 3, 'a')}), least(a, {before('I', 3, 'u')})
  FROM (SELECT w.conv_id, w.k, {', '.join(f'{sql} AS {name}' for name, sql in AFTER.items())}
        FROM ways w JOIN judged j ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND w.k = j.k)
), best AS (SELECT conv_id, CAST(substr(z, 1, 9) AS BIGINT) AS cost, substr(z, 10) AS audit FROM ways WHERE k = 0
), letters AS (
  SELECT conv_id, unnest(range(1, length(audit) + 1)) AS i, substr(audit, i, 1) AS l FROM best
), edits AS (
  SELECT conv_id, i, l, count(*) FILTER (l <> 'I') OVER f AS k, count(*) FILTER (l <> 'D') OVER f AS o FROM letters WINDOW f AS (PARTITION BY conv_id ORDER BY i)
), lines AS (
  SELECT e.*, j.role, j.text, max(CASE WHEN o = 1 AND l = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS lead
  FROM edits e LEFT JOIN judged j ON e.conv_id IS NOT DISTINCT FROM j.conv_id AND e.k = j.k AND l IN ('K', 'R') WHERE l <> 'D'
), repaired AS (
  SELECT conv_id, string_agg(CASE WHEN l = 'K' THEN role WHEN (o - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN l = 'I' THEN '' ELSE text END,
    chr(10) ORDER BY i) AS whole FROM lines GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
    count(*) FILTER (stays > 0) AS truncated, count(*) FILTER (previous || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id
)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON c.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""

#: Bytes are pairs of hexadecimal digits; texts are cut into chunks first, as a place far inside
#: a long text is slow to reach.
OP8_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), chunks AS (
  SELECT doc_id, c, substr(h, 2000 * c + 1, 2098) AS part
  FROM (SELECT doc_id, h, unnest(range(CAST(ceil(length(h) / 2000) AS BIGINT))) AS c FROM d)
), strings AS (
  SELECT doc_id, 1000 * c + i AS pos, substr(part, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, c, part, unnest(range(greatest(0, least(1000, length(part) // 2 - 49)))) AS i FROM chunks)
), first AS (
  SELECT s, min(doc_id) AS home FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)
), starts AS (
  SELECT DISTINCT doc_id, pos FROM strings JOIN first USING (s) WHERE home < doc_id
), breaks AS (
  SELECT *, CASE WHEN pos <= lag(pos) OVER w + 50 THEN 0 ELSE 1 END AS fresh FROM starts WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), numbered AS (
  SELECT doc_id, pos, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS nth FROM breaks
), spans AS (
  SELECT doc_id, nth, min(pos) AS a, max(pos) + 50 AS b FROM numbered GROUP BY doc_id, nth
), pieces AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans
), removed AS (
  SELECT p.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM pieces p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id
)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN last IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN removed r ON r.doc_id = d.doc_id
"""
