"""DuckDB text of the queries that SQL can express on whole tables."""

from __future__ import annotations

from catalytics.llm import licenses, quality

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT *, translate(trim(line, {_WS}), {_LOWER}) AS key FROM l),
rep AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, coalesce(k.doc_id < rep.keeper, false) AS gone FROM k LEFT JOIN rep USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id"""


def _canonical(text: str) -> str:
    t = f"regexp_replace(translate(coalesce({text}, ''), {_LOWER}), {_q(licenses.COPYRIGHT_LINE)}, '', 'g')"
    t = f"translate({t}, {_q(licenses.TYPOGRAPHIC)}, {_q(' ' * len(licenses.TYPOGRAPHIC))})"
    t = f"regexp_replace({t}, {_q(licenses.FOLDED)}, ' ', 'g')"
    t = f"' ' || replace({t}, chr(10), ' ' || chr(10) || ' ') || ' '"
    t = f"({t})"
    for a, b in licenses.SPELLINGS:
        t = f"replace({t}, {_q(f' {a} ')}, {_q(f' {b} ')})"
    return f"trim(regexp_replace({t}, ' +', ' ', 'g'), ' ')"


def _flat(t: str) -> str:
    return f"trim(regexp_replace({t}, '[ \\n]+', ' ', 'g'), ' ')"


_KNOWN = ", ".join(f"({_q(k)}, {_q(v)})" for k, v in licenses.KNOWN.items())

OP2 = f"""
WITH known AS (SELECT DISTINCT license, sha256({_flat('t')}) AS digest FROM
  (SELECT license, {_canonical('text')} AS t FROM (VALUES {_KNOWN}) v(license, text))),
d AS (SELECT doc_id, {_canonical('text')} AS t FROM documents),
u AS (SELECT doc_id, {_flat('t')} AS whole,
             list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS ls,
             list_filter(list_transform(regexp_split_to_array(t, '\\n *\\n[ \\n]*'),
               lambda x: CASE WHEN contains(trim(x, ' '), chr(10)) THEN {_flat("trim(x, ' ')")} ELSE '' END), lambda x: x <> '') AS bs FROM d),
p AS (SELECT doc_id, unnest(CASE WHEN len(ls) > 1 THEN
        list_concat(ls, CASE WHEN len(bs) > 1 THEN bs ELSE [] END) ELSE [] END) AS part FROM u),
w AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS license FROM u
      JOIN known ON known.digest = sha256(whole) WHERE whole <> '' GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_notices, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM p
      JOIN known ON known.digest = sha256(part) GROUP BY doc_id)
SELECT u.doc_id, sha256(whole) AS canonical_sha256, w.license, coalesce(n.n_notices, 0) AS n_notices,
       coalesce(n.notices, '') AS notices
FROM u LEFT JOIN w USING (doc_id) LEFT JOIN n USING (doc_id)"""

_WORDS = r"'[^\x20\x09-\x0D]+'"

OP3 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, chr(0)) AS host,
                  regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
wi AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
win AS (SELECT doc_id, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM wi WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, w, w1, w2 FROM win WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
hit AS (SELECT DISTINCT win.doc_id, unnest([i, i + 1, i + 2]) AS p FROM win JOIN rep
        ON win.doc_id = rep.doc_id AND win.w = rep.w AND win.w1 = rep.w1 AND win.w2 = rep.w2),
nr AS (SELECT doc_id, count(*) AS n_repeat_words FROM hit GROUP BY doc_id),
ln AS (SELECT doc_id, host, md5(text) AS content, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln
        WHERE trim(line, {_WS}) <> '' GROUP BY doc_id),
nl AS (SELECT doc_id, host, content, len(ws) AS n, array_to_string(ws, ' ') AS key FROM
       (SELECT *, regexp_extract_all(translate(line, {_LOWER}), {_WORDS}) AS ws FROM ln)
       WHERE octet_length(encode(array_to_string(ws, ' '))) >= {quality.MIN_LINE_CHARS}),
hold AS (SELECT host, key, count(DISTINCT content) AS holders FROM nl GROUP BY ALL),
hs AS (SELECT host, count(DISTINCT md5(text)) AS host_docs FROM d GROUP BY host),
common AS (SELECT host, key FROM hold JOIN hs USING (host)
           WHERE holders > greatest({quality.MIN_HOLDERS}, host_docs * {quality.HOST_SHARE})),
lost AS (SELECT doc_id, count(*) AS n_removed_lines, sum(n) AS lost FROM nl JOIN common USING (host, key) GROUP BY doc_id),
s AS (SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed_lines, 0) AS n_removed_lines,
             len(ws) - coalesce(lost, 0) AS remaining_words
      FROM d LEFT JOIN nr USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost USING (doc_id)),
b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND remaining_words >= {quality.MIN_REMAINING} * n_words AS kept FROM b"""

OP10 = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wn AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i + 1, i + n), ' ') AS g FROM
       (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(greatest(len(w) - 9, 1))) AS i FROM bw WHERE len(w) > 0)),
sz AS (SELECT DISTINCT n FROM wn),
dg AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i + 1, i + n), ' ') AS g FROM
       (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM dw CROSS JOIN sz WHERE len(w) >= n)),
m AS (SELECT DISTINCT dg.doc_id, dg.i, dg.n, wn.item_id FROM dg JOIN wn ON dg.n = wn.n AND dg.g = wn.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
      (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""

ORACLES: dict[str, str] = {"op1_line_dedup": OP1, "op2_license_scan": OP2, "op3_quality_rules": OP3,
                           "op10_decontamination": OP10}
