"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .quality_rules import BASE_MAX_REPEAT_PERCENT, BASE_MIN_WORDS, RULES, STOP_WORDS, WINDOW

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = r"[\x20\x09-\x0D]"

OP6 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format('text')}, '{_SPACE}+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
  GROUP BY 1, 2 HAVING 100 * count(*) >= 90 * (min(x.n) + min(y.n) - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id FROM n JOIN reach r ON r.a = n.doc_id GROUP BY 1, 2
"""


def _rule_sql() -> str:
    tests = [f"({r.value}) {op} {bound!r}" for r in RULES for op, bound in ((">=", r.low), ("<=", r.high)) if bound is not None]
    return " AND ".join(tests)


_STOP = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words}))

OP8 = rf"""
WITH t AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM t),
win AS (SELECT k, list_transform(range(1, len(words) - {WINDOW - 2}), lambda i: array_to_string(words[i:i + {WINDOW - 1}], ' ')) AS g
  FROM w WHERE len(words) >= {WINDOW}),
dup AS (SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY k, g) AS c FROM (
  SELECT k, unnest(g) AS g, unnest(range(len(g))) AS p FROM win)) WHERE c > 1),
rep AS (SELECT k, count(DISTINCT p + o) AS n_repeat_words FROM dup, range({WINDOW}) AS r(o) GROUP BY k),
st AS (SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  coalesce(rep.n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
  len(list_filter(words, lambda w: lower(rtrim(w, '.,;:!?')) IN ({_STOP}))) AS n_stop_words,
  len(regexp_extract_all(text, '\p{{Lu}}')) AS n_upper,
  len(list_filter(lines, lambda l: regexp_matches(l, '^{_SPACE}*[-*•]'))) AS n_bullet_lines,
  len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…){_SPACE}*$'))) AS n_ellipsis_lines
  FROM w LEFT JOIN rep USING (k)),
b AS (SELECT *, n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_MAX_REPEAT_PERCENT} * n_words AS base_failed FROM st)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND ({_rule_sql()}) AS kept FROM b
"""

_CONFLICT = r"(contains(t, '<s>') OR contains(t, '</s>') OR contains(t, '[INST]') OR contains(t, '[/INST]') OR contains(t, '<<') OR contains(t, '<\') OR contains(t, '[\') OR contains(t, '\\'))"

OP7 = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
s AS (SELECT *, length(t) + CASE WHEN {_CONFLICT} THEN len(regexp_extract_all(t, '[<\[\\]')) ELSE 0 END
  + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 ELSE 18 END AS shown FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(shown))::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""

OP10 = rf"""
WITH iw AS (SELECT DISTINCT item_id::VARCHAR AS item, regexp_extract_all({_LOWER.format('text')}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
iwin AS (SELECT DISTINCT item, least(10, len(w)) AS z, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS g
  FROM iw, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS r(p) WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER.format('text')}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
dlist AS (SELECT k, z, list_transform(range(1, len(w) - z + 2), lambda i: array_to_string(w[i:i + z - 1], ' ')) AS g
  FROM d, (SELECT DISTINCT z FROM iwin) WHERE len(w) >= z),
dwin AS (SELECT k, z, unnest(g) AS g, unnest(range(len(g))) AS p FROM dlist),
m AS (SELECT k, dwin.z, p, item FROM dwin JOIN iwin USING (z, g)),
hit AS (SELECT k, count(DISTINCT p + o) AS n_hit FROM m, unnest(range(z)) AS r(o) GROUP BY k),
its AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item FROM m) GROUP BY k)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (k) LEFT JOIN its USING (k)
"""


_BLANKS = r"\x20\x09-\x0D"


def _edited(state: str, cost: int, initials: str, kept: bool = False) -> str:
    """A state of OP12's search, ten digits of cost and the edits so far, after one more piece; an
    undeleted row costs more if it is truncated."""
    more = f"{cost} + CASE x.f WHEN 'truncated' THEN 3 ELSE 0 END" if kept else str(cost)
    return f"(lpad(CAST(CAST(left({state}, 10) AS BIGINT) + {more} AS VARCHAR), 10, '0') || substr({state}, 11) || '{initials}')"


OP12 = rf"""
WITH keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
checked AS (  -- crc32 of the key, bit by bit
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(substr(key, CAST(i AS INTEGER), 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM checked WHERE kind <> 0),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again FROM damaged),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_BLANKS}]') THEN 'blank' WHEN again THEN 'duplicate'
    WHEN regexp_extract(text, '([^{_BLANKS}])[{_BLANKS}]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS place,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again), 1) || left(role, 1) AS two FROM seen),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal,
    list({{'s': CAST([] AS VARCHAR[]), 'r': left(role, 1), 'f': fault}} ORDER BY place) AS turns FROM faults GROUP BY conv_id),
-- Least "cost, edits so far" for each state of the repaired part: empty, after s, after u, after a.
searched AS (
  SELECT *, list_reduce(list_prepend({{'s': ['0000000000', NULL, NULL, NULL], 'r': '', 'f': ''}}, turns), lambda done, x: {{
    's': list_transform([[done.s[1], done.s[2],
        list_min([done.s[3], {_edited('done.s[1]', 3, 'I')}, {_edited('done.s[2]', 3, 'I')}, {_edited('done.s[4]', 3, 'I')}]),
        list_min([done.s[4], {_edited('done.s[1]', 6, 'II')}, {_edited('done.s[2]', 6, 'II')}, {_edited('done.s[3]', 3, 'I')}])]],
      lambda p: [{_edited('p[1]', 4, 'D')},
        list_min([{_edited('p[2]', 4, 'D')}, CASE WHEN x.r = 's' AND x.f IN ('', 'truncated') THEN {_edited('p[1]', 0, 'K', True)} END]),
        list_min(list_concat([{_edited('p[3]', 4, 'D')}], CASE WHEN x.f IN ('', 'truncated') THEN list_concat([{_edited('p[1]', 3, 'R', True)}, {_edited('p[2]', 3, 'R', True)}, {_edited('p[4]', 3, 'R', True)}],
          CASE WHEN x.r = 'u' THEN [{_edited('p[1]', 0, 'K', True)}, {_edited('p[2]', 0, 'K', True)}, {_edited('p[4]', 0, 'K', True)}] ELSE [] END) ELSE [] END)),
        list_min(list_concat([{_edited('p[4]', 4, 'D')}], CASE WHEN x.f IN ('', 'truncated') THEN list_concat([{_edited('p[3]', 3, 'R', True)}],
          CASE WHEN x.r = 'a' THEN [{_edited('p[3]', 0, 'K', True)}] ELSE [] END) ELSE [] END))])[1],
    'r': x.r, 'f': x.f}}).s AS ends FROM figures),
least AS (SELECT *, list_min([ends[1], {_edited('ends[2]', 6, 'II')}, {_edited('ends[3]', 3, 'I')}, ends[4]]) AS best FROM searched),
edits AS (
  SELECT conv_id, unnest(range(1, length(best) - 9)) AS pos, substr(best, 11) AS audit, substr(audit, CAST(pos AS INTEGER), 1) AS edit FROM least),
numbered AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER w AS place, count(*) FILTER (edit <> 'D') OVER w AS shown FROM edits
    WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
placed AS (
  SELECT n.conv_id, n.pos, n.edit, n.shown, f.role, f.text, max(CASE WHEN n.shown = 1 AND n.edit = 'K' AND left(f.role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY n.conv_id) AS begun
    FROM numbered n LEFT JOIN faults f ON n.conv_id IS NOT DISTINCT FROM f.conv_id AND n.place = f.place),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (shown - begun) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS whole
    FROM placed WHERE edit <> 'D' GROUP BY conv_id)
SELECT o.conv_id, coalesce(l.gaps, 0) AS gaps, coalesce(l.blank, 0) AS blank, coalesce(l.duplicate, 0) AS duplicate, coalesce(l.truncated, 0) AS truncated,
  coalesce(l.illegal, 0) AS illegal, coalesce(CAST(left(l.best, 10) AS BIGINT), 0) AS cost, coalesce(substr(l.best, 11), '') AS audit, sha256(coalesce(r.whole, '')) AS repaired_sha256
  FROM (SELECT DISTINCT conv_id FROM conversations) o
  LEFT JOIN least l ON o.conv_id IS NOT DISTINCT FROM l.conv_id LEFT JOIN repaired r ON o.conv_id IS NOT DISTINCT FROM r.conv_id
"""
