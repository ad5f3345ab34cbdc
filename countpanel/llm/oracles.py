"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from countpanel.llm.licenses import PHRASES, TEMPLATES, _run
from countpanel.llm.urls import LOWER, RULES, UPPER, TreeParams

WORDS = r"'[^\x20\x09-\x0D]+'"

#: Each rule's condition, by bit.
RULE_SQL = {
    "few_words": "n_words < 50", "repeated_trigrams": "100 * n_repeat_words > 50 * n_words", "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "n_dup_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines", "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 12 * n_words", "upper_case": "100 * n_upper > 30 * n_words",
    "few_distinct_words": "100 * n_unique < 15 * least(n_words, 400)"}
MASK = " + ".join(f"CASE WHEN {c} THEN {1 << bit} ELSE 0 END" for bit, c in enumerate(RULE_SQL.values()))

QUALITY = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {WORDS}) AS words FROM documents),
places AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
windows AS (
  SELECT doc_id, i, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3
  FROM places WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
again AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, w2, w3) > 1 AS twice FROM windows WHERE w3 IS NOT NULL),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again WHERE twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
by_line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words) AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(covered.n, 0) AS n_repeat_words,
    len(list_filter(words, lambda x: regexp_full_match(x, '[A-Z][A-Z][\x00-\x60\x7B-\x7F]*'))) AS n_upper,
    len(list_distinct(words)) AS n_unique
  FROM w LEFT JOIN by_line USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, mask = 0 AS kept, CAST(mask AS BIGINT) AS mask,
  CASE mask {" ".join(f"WHEN {1 << bit} THEN '{rule}'" for bit, rule in enumerate(RULE_SQL))} END AS kept_without
FROM (SELECT *, {MASK} AS mask FROM m)
"""


def _licenses() -> str:
    """Phrases by consecutive words, templates by brute force over all runs of
    words of texts that hold enough of the template at all."""
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    phrases = ", ".join(f"({[w for w in p.split()]!r}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(f"({sorted(set(t.split()))!r}, '{label}', {_run(t, 0.8)})" for t, label in TEMPLATES)
    return f"""
WITH w AS (SELECT doc_id, {lower} AS lower, regexp_extract_all({lower}, {word}) AS words FROM documents),
phrases(phrase, label) AS (VALUES {phrases}),
templates(own, label, run) AS (VALUES {templates}),
starts AS (SELECT doc_id, words, unnest(range(len(words))) AS i FROM w),
places AS (SELECT doc_id, i, label FROM starts, phrases
           WHERE words[i + 1] = phrase[1] AND words[i + 1 : i + len(phrase)] = phrase),
base AS (SELECT doc_id, count(*) AS n, min(i) AS first, max(i) AS last, list(DISTINCT label) AS labels
         FROM places GROUP BY doc_id),
able AS (SELECT doc_id, words, own, label, run FROM w, templates WHERE len(list_intersect(list_distinct(words), own)) / len(own) >= 0.8),
runs AS (SELECT doc_id, own, label, words[i + 1 : i + run] AS block FROM (SELECT *, unnest(range(len(words))) AS i FROM able)),
held AS (SELECT doc_id, label, len(list_intersect(list_distinct(block), own)) / len(own) AS containment FROM runs),
found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(containment) AS best FROM held
          WHERE containment >= 0.8 GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base,
  CAST(first AS BIGINT) AS first_word, CAST(last AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, found.labels))), ','), '') AS labels,
  CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
"""


LICENSES = _licenses()

SUBSTRINGS = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i + 1 : i + 35], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(len(words) - 34)) AS i FROM w WHERE len(words) >= 35)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY win) AS n FROM windows) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM again),
places AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS p FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM places ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def _urls(params: TreeParams = TreeParams()) -> str:
    """Rules by CASE, the template tree level by level over all pages."""
    fits = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.rule}'"
        for r in sorted(RULES, key=lambda r: (-len(r.rule), r.rule)))
    verdicts = " ".join(f"WHEN '{r.rule}' THEN '{r.verdict}'" for r in RULES)
    levels = []
    for k in range(params.depth + 1):
        wildcard = "*" if k < params.depth else "**"
        z = [f"abs(s_{c} - typical_{c}) / sqrt((s_{c} * n + typical_{c} * n + 1) / (2 * n + 2)"
             f" * (1 - (s_{c} * n + typical_{c} * n + 1) / (2 * n + 2)) * 2 / n)" for c in ("bad", "good")]
        levels.append(f"""
a{k} AS (SELECT *, segments[{k + 1}] AS seg FROM t{k}),
b{k} AS (SELECT *, count(*) OVER b AS n, avg(bad) OVER b AS s_bad, avg(good) OVER b AS s_good
  FROM a{k} WINDOW b AS (PARTITION BY host, template, seg)),
c{k} AS (SELECT *, seg IS NOT NULL AND n >= {params.min_count} AS frequent FROM b{k}),
d{k} AS (SELECT *, quantile_cont(s_bad, 0.5) FILTER (WHERE frequent) OVER node AS typical_bad,
    quantile_cont(s_good, 0.5) FILTER (WHERE frequent) OVER node AS typical_good
  FROM c{k} WINDOW node AS (PARTITION BY host, template)),
t{k + 1} AS (SELECT page_id, host, path, rule, bad, good, segments, CASE WHEN seg IS NULL THEN template
    WHEN frequent AND greatest({', '.join(z)}) >= {params.z} THEN template || '/' || seg ELSE template || '/{wildcard}' END AS template
  FROM d{k})""")
    return rf"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, CASE {fits} END AS rule FROM u),
t0 AS (
  SELECT page_id, host, path, rule, CASE WHEN (CASE rule {verdicts} END) = 'block' THEN 1.0 ELSE 0.0 END AS bad,
    CASE WHEN (CASE rule {verdicts} END) = 'allow' THEN 1.0 ELSE 0.0 END AS good,
    list_filter(string_split(path, '/'), lambda s: s <> '') AS pieces,
    CASE WHEN len(pieces) > {params.depth} THEN list_append(pieces[1 : {params.depth}], array_to_string(pieces[{params.depth + 1} :], '/'))
      ELSE pieces END AS segments, '' AS template
  FROM r),{','.join(levels)},
f AS (SELECT *, template AS whole FROM t{params.depth + 1}),
p AS (SELECT host, whole, (sum(bad) + {params.strength * params.prior}) / (sum(bad) + sum(good) + {params.strength}) AS purity
  FROM f GROUP BY host, whole)
SELECT page_id, host, path, rule, coalesce(CASE rule {verdicts} END,
    CASE WHEN purity >= {params.reject_at} THEN 'block' ELSE 'allow' END) AS verdict,
  whole AS template, round(purity, 9) AS purity
FROM f JOIN p USING (host, whole)
"""


URLS = _urls()

NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p
JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
