"""SQL that the native queries agree with."""

from __future__ import annotations

from matchloom.llm.quality_rules import CAPITALS, RiskParams, settings
from matchloom.llm.url_filters import LOWER, RULES, UPPER

_PARAMS = RiskParams()
_RULES = list(_PARAMS.grid)
_SETTINGS = settings(_PARAMS.grid)
_REJECTED = ", ".join(
    f"count(*) FILTER (base_failed OR {' OR '.join(f'{rule} > {cutoff!r}' for rule, cutoff in setting.items())}) AS setting_{n}"
    for n, setting in enumerate(_SETTINGS)
)
_CUTOFFS = ", ".join(
    "CASE " + " ".join(f"WHEN setting_{n} <= most THEN {s[rule]!r}" for n, s in reversed(list(enumerate(_SETTINGS)))) + f" END AS {rule}"
    for rule in _RULES
)
_ABOVE = " OR ".join(f"coalesce(s.{rule} > c.{rule}, false)" for rule in _RULES)

QUALITY_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM d),
win AS (SELECT rid, i, words[i:i + 4] AS g FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT rid, sum(least(5, coalesce(i - before, 5)))::BIGINT AS n
  FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM rep) GROUP BY rid),
n AS (
  SELECT w.rid, doc_id, stratum, len(words)::BIGINT AS n_words, len(lines) AS n_lines,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
    length(text) - length(regexp_replace(text, '!', '', 'g')) AS n_marks,
    length(text) - length(regexp_replace(text, '[{CAPITALS[0]}-{CAPITALS[-1]}]', '', 'g')) AS n_capitals
  FROM w LEFT JOIN cov ON w.rid = cov.rid),
s AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN n_symbols::DOUBLE / n_words ELSE 0 END AS symbol_share,
    CASE WHEN n_words > 0 THEN n_marks::DOUBLE / n_words ELSE 0 END AS mark_share,
    CASE WHEN word_chars > 0 THEN n_capitals::DOUBLE / word_chars ELSE 0 END AS capital_share,
    CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END AS repeat_share,
    CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS line_share,
    CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END AS word_length
  FROM n),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING max(quality) = 1),
counts AS (SELECT stratum, count(*) AS n, {_REJECTED} FROM s JOIN good USING (doc_id) GROUP BY stratum),
chance AS (
  SELECT stratum, i, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
    + i * ln({_PARAMS.risk}) + (n - i) * ln(1 - {_PARAMS.risk}))) OVER (PARTITION BY stratum ORDER BY i) AS total
  FROM (SELECT stratum, n, unnest(range(0, floor(n * {_PARAMS.risk})::BIGINT + 1)) AS i FROM counts)),
allowed AS (
  SELECT stratum, coalesce(max(CASE WHEN total <= {_PARAMS.level} / (SELECT count(*) FROM counts) THEN i END), -1) AS most
  FROM chance GROUP BY stratum),
c AS (SELECT counts.stratum, {_CUTOFFS} FROM counts JOIN allowed ON counts.stratum = allowed.stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR {_ABOVE}) AS kept
FROM s LEFT JOIN c ON s.stratum = c.stratum
"""

LINE_DEDUP = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS a FROM documents),
r AS (
  SELECT doc_id, i, trim(a[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS x
  FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM l)),
w AS (
  SELECT doc_id, i AS i0, x AS x0, lead(i, 1) OVER o AS i1, lead(x, 1) OVER o AS x1, lead(i, 2) OVER o AS i2, lead(x, 2) OVER o AS x2
  FROM r WHERE x <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
p AS (
  SELECT doc_id, i0, i1, i2, row_number() OVER (PARTITION BY x0, x1, x2 ORDER BY doc_id, i0) AS nth
  FROM w WHERE i2 IS NOT NULL),
c AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest([i0, i1, i2]) AS i FROM p WHERE nth > 1) GROUP BY doc_id)
SELECT l.doc_id, coalesce(len(gone), 0)::BIGINT AS n_removed,
  CASE WHEN gone IS NULL THEN text
    ELSE array_to_string([a[i] FOR i IN range(1, len(a) + 1) IF NOT list_contains(gone, i)], chr(10)) END AS text
FROM l LEFT JOIN c ON l.doc_id = c.doc_id
"""

_RULE_ROWS = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in RULES)

URL_FILTERS = f"""
WITH rules(verdict, host, path) AS (VALUES {_RULE_ROWS}),
p AS (
  SELECT row_number() OVER () AS rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)),
f AS (
  SELECT rid, r.host || r.path AS rule, verdict
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(r.host || r.path) DESC, r.host || r.path DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN f ON p.rid = f.rid
"""

_CRC_STEP = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
_CRC = """xor(list_reduce(list_prepend(4294967295, [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
    lambda c, b: xor(c // 256, crc_table[xor(c, b) % 256 + 1])), 4294967295)"""

CONVERSATION_TRIE = f"""
WITH k AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: {_CRC_STEP})) AS crc_table),
o AS (
  SELECT conv_id, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS x, length(coalesce(text, '')) AS n,
    turn FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, x, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) AS place FROM o),
ids AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t), k),
sizes AS (SELECT conv_id AS base, max(place) AS there FROM t WHERE place < 6 GROUP BY ALL),
r AS (
  SELECT ids.conv_id, place AS depth, x, n FROM ids JOIN t ON t.conv_id = base AND place <= h
  UNION ALL
  SELECT ids.conv_id, place - h + least(h, coalesce(there, 0)), x, n FROM ids JOIN t ON t.conv_id = ids.conv_id AND place > h
    LEFT JOIN sizes ON sizes.base = ids.base
  UNION ALL SELECT conv_id, 0, '', 0 FROM ids),
p AS (SELECT conv_id, depth, n, string_agg(x, '') OVER (PARTITION BY conv_id ORDER BY depth) AS key, max(depth) OVER (PARTITION BY conv_id) AS last FROM r),
nodes AS (
  SELECT key, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = last) AS ends
  FROM p GROUP BY key),
kids AS (SELECT substr(key, 1, greatest(length(key) - 32, 0)) AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
below AS (
  SELECT p.key, count(*) FILTER (kids.key IS NULL) AS n_leaves, sum((n_convs - 1) * nodes.n) AS saved
  FROM nodes LEFT JOIN kids ON kids.key = nodes.key JOIN p ON p.conv_id = nodes.conv_id AND p.depth <= nodes.depth GROUP BY p.key)
SELECT a.conv_id, a.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id, a.n_convs::BIGINT AS n_convs,
  coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(a.ends, '')) AS ends_sha256
FROM nodes a JOIN below ON below.key = a.key LEFT JOIN kids ON kids.key = a.key
LEFT JOIN nodes parent ON a.depth > 0 AND parent.key = substr(a.key, 1, length(a.key) - 32)
"""

FILL_MIDDLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (
  SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || substr(x, 1, 8))::BIGINT % (length(t) + 1) AS a, ('0x' || substr(x, 9, 8))::BIGINT % (length(t) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(x, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || substr(x, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (SELECT *, least(a, b) AS lo, greatest(a, b) AS hi FROM h),
s AS (SELECT *, substr(t, 1, lo) AS p, substr(t, lo + 1, hi - lo) AS m, substr(t, hi + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM s
"""
