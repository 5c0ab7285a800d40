"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from fieldledger.llm.quality_rules import LineRules

_SPACE = r"[\x20\x09-\x0D]+"
_RULES = LineRules()
_TRIMMED = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = f"list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}'), lambda w: w <> '')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM cut),
keyed AS (SELECT doc_id, pos, line, {_LOWER.format(f"trim(line, {_TRIMMED})")} AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
judged AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.last AS gone
  FROM keyed k LEFT JOIN common c USING (key)
)
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '{_SPACE}'), lambda w: w <> '') AS ws
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' '))) END AS s
  FROM words
),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS n, b.n AS m, count(*) AS k
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (SELECT x, y FROM shared WHERE 100 * k >= 80 * (n + m - k)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM sets s JOIN reach r ON r.x = s.doc_id GROUP BY ALL
"""

# With the links of each document.
JACCARD_LINKS = JACCARD.replace("AS component_id", "AS component_id, count(DISTINCT l.y) AS n_links").replace(
    "reach r ON r.x = s.doc_id", "reach r ON r.x = s.doc_id LEFT JOIN links l ON l.x = s.doc_id"
)

SUBSTRINGS = f"""
WITH words AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
placed AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS pos FROM words WHERE len(ws) >= 35),
windows AS (SELECT doc_id, pos, array_to_string(list_slice(ws, pos, pos + 34), ' ') AS w FROM placed),
twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(pos, pos + 35)))) AS gs FROM windows WHERE w IN (SELECT w FROM twice)
  GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gs), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN gs IS NULL THEN array_to_string(ws, ' ') ELSE array_to_string(
    list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(gs, i)), lambda i: ws[i]), ' ') END) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""

_CHARS = f"length(regexp_replace(line, '{_SPACE}', '', 'g'))"
_SYMBOLS = "length(regexp_replace({}, '[^#*$%&|<>]+', '', 'g'))"
_N_LINE_WORDS = f"len(list_filter(string_split_regex(line, '{_SPACE}'), lambda w: w <> ''))"
_MARKS = "length(regexp_replace(line, '[^|>*·•»]+', '', 'g'))"
_SHOUTS = "length(regexp_replace(line, '[^!]+', '', 'g'))"

QUALITY_RULES = f"""
WITH words AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
placed AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS pos FROM words WHERE len(ws) >= 8),
windows AS (SELECT doc_id, pos, array_to_string(list_slice(ws, pos, pos + 7), ' ') AS w FROM placed),
repeats AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows),
covered AS (
  SELECT doc_id, count(DISTINCT i) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(pos, pos + 8)) AS i FROM repeats WHERE n > 1) GROUP BY doc_id
),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words),
judged AS (
  SELECT doc_id, line, {_CHARS} AS chars,
    100 * {_SYMBOLS.format("line")} > {_RULES.symbol_share} * {_CHARS}
    OR ({_N_LINE_WORDS} >= {_RULES.min_words} AND 100 * {_SHOUTS} > {_RULES.shout_marks} * {_N_LINE_WORDS})
    OR ({_MARKS} >= {_RULES.separators} AND 3 * {_MARKS} >= {_N_LINE_WORDS})
    OR NOT regexp_matches(line, '[\\p{{L}}\\p{{N}}]')
    OR regexp_matches(line, '(?i){"|".join(_RULES.boilerplate)}') AS fails
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
),
by_line AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
    coalesce(sum(chars) FILTER (WHERE fails), 0)::BIGINT AS lost FROM judged GROUP BY doc_id
),
counts AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
    {_SYMBOLS.format("text")}::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN by_line USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * lost <= {_RULES.max_lost} * word_chars AS kept
FROM counts
"""

# Inner products of whole numbers are exact in doubles at these sizes.
_VECTORS = """
WITH v AS (
  SELECT *, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""

TOP_K = f"""
{_VECTORS},
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

HARD_NEGATIVES = f"""
{_VECTORS},
moved AS (
  SELECT vec_id, w, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM v WHERE label IS NOT NULL
),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.w, r.w)::BIGINT AS score
  FROM moved a JOIN moved r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id
),
positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
