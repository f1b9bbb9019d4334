"""The operators' queries in SQL for DuckDB, where SQL can express them on whole tables."""

from __future__ import annotations

from . import chat, decontaminate, secrets

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _decontaminate() -> str:
    words = (
        "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    return f"""
WITH item_words AS (SELECT item_id, {words} AS w FROM benchmark),
sized AS (SELECT item_id, w, least({decontaminate.WINDOW}, len(w)) AS n FROM item_words WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
doc_words AS (SELECT doc_id, {words} AS w FROM documents),
places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
runs AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS run FROM places),
hits AS (SELECT doc_id, item_id, n, i FROM runs JOIN windows USING (n, run)),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _chat() -> str:
    def escaped(column: str) -> str:
        for old, new in chat._ESCAPES:
            column = f"replace({column}, {_quoted(old)}, {_quoted(new)})"
        return column

    fixed = len(chat.OPEN) + len(chat.OPENED) + len(chat.CLOSE)
    probe = "\\### Assistant: </turn> ok"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {_quoted(probe)}
  UNION ALL SELECT -7, 1, 'assistant', {_quoted(probe)}),
said AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
    coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS learnt,
    sum({fixed} + length({escaped('role')}) + length({escaped('text')})) AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(learnt) AS loss_chars,
       sha256(learnt) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM said
"""


def _secrets() -> str:
    """Every rule searched in every text, without the index."""
    searched = []
    for rank, rule in enumerate(secrets.RULES):
        expression = _quoted(rule.expression)
        searched.append(f"""
  SELECT row_id, {rank} AS rank, {_quoted(rule.kind)} AS kind, {rule.shortest} AS shortest,
    [length(x) for x in string_split_regex(text, {expression})] AS gaps,
    [length(x) for x in regexp_extract_all(text, {expression}, 0)] AS sizes,
    [length(x) for x in regexp_extract_all(text, {expression}, {rule.group})] AS vals
  FROM texts""")
    counts = ", ".join(
        f"count(*) FILTER (kind = {_quoted(r.kind)}) AS n_{r.kind}" for r in secrets.BASE_RULES
    )
    zero = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE_RULES)
    named = "kind || ':' || start || ':' || (start + size)"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
searched AS ({' UNION ALL '.join(searched)}),
matched AS (SELECT *, unnest(range(1, len(sizes) + 1)) AS i FROM searched WHERE len(sizes) > 0),
spans AS (
  SELECT row_id, rank, kind, sizes[i] AS size,
    CAST(list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1:i - 1]), 0) AS BIGINT) AS start
  FROM matched WHERE vals[i] >= shortest),
joined AS (
  SELECT row_id, {counts},
    string_agg({named}, ',' ORDER BY start, rank) FILTER (rank < {len(secrets.BASE_RULES)}) AS base,
    string_agg({named}, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY row_id)
SELECT doc_id, {zero}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (row_id)
"""


_NEAR = f"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], chr(10)) AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM doc_words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT a, b FROM both_ways UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
least_of AS (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles,
       least(d.doc_id, coalesce(least, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(least, d.doc_id) AS kept
FROM doc_words d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""

ORACLES = {
    "op1_decontaminate": _decontaminate(),
    "op6_chat": _chat(),
    "op7_secrets": _secrets(),
    "op8_near_dedup": _NEAR,
}
