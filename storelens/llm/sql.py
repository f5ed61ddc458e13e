"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

import math

from .licenses import CONTAINMENT, LOWER, PHRASES, TEMPLATES, UPPER

TOP_K = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
  AS rank, vec_id, score
FROM scored QUALIFY rank <= 5"""

MIXING = r"""WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, source, length(t) AS n, md5(t) AS h,
    CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM d),
keyed AS (
  SELECT doc_id, source, size,
    -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || h), 1, 13) AS BIGINT) + 0.5)
        / 4503599627370496.0)
    / least(1.0, greatest(0.25, CASE WHEN size > 0
        THEN 1.0 / (1.0 + abs(CAST(n AS DOUBLE) / CAST(size AS DOUBLE) - 6.0) / 6.0) ELSE 1.0 END)) AS key FROM m),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM keyed GROUP BY source),
room AS (
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
    sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM s),
flagged AS (
  SELECT *, 3.0::DOUBLE * source_size <= CAST(total - taken AS DOUBLE) / CAST(rest AS DOUBLE) * weight AS limited
  FROM room),
targets AS (
  SELECT source, source_size, CASE WHEN limited THEN 3.0::DOUBLE * source_size
    ELSE CAST(total - coalesce(sum(3 * source_size) FILTER (limited) OVER (), 0) AS DOUBLE)
      / CAST(sum(weight) FILTER (NOT limited) OVER () AS DOUBLE) * weight END AS target FROM flagged),
mixed AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS FIRST, k.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, CAST(epochs + CASE WHEN CAST(2 * ahead + size AS DOUBLE) < 2.0 * (target - epochs * source_size)
    THEN 1 ELSE 0 END AS BIGINT) AS copies FROM mixed)
SELECT doc_id, size, source_size, target, copies, CAST(copies * size AS BIGINT) AS taken FROM counted"""


def _starts(phrase: str) -> str:
    parts = phrase.split()
    tests = " AND ".join(f"words[i + {k}] = '{part}'" for k, part in enumerate(parts, 1))
    return f"list_filter(range(greatest(len(words) - {len(parts) - 1}, 0)), lambda i: {tests})"


def license_scan(containment: float = CONTAINMENT) -> str:
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    templates = []
    for text, label in TEMPLATES.items():
        words = sorted(set(text.split()))
        least = math.ceil(containment * len(words) - 1e-9)
        reach = math.floor(len(text.split()) / containment + 1e-9)
        templates.append(f"('{label}', {words!r}, {least}, {reach})")
    starts = [f"{_starts(phrase)} AS s{i}" for i, phrase in enumerate(PHRASES)]
    every = " || ".join(f"s{i}" for i in range(len(PHRASES)))
    base = " || ".join(f"CASE WHEN len(s{i}) > 0 THEN ['{label}'] ELSE [] END" for i, label in enumerate(PHRASES.values()))
    return f"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
w AS (SELECT r, doc_id, regexp_extract_all(t, {word}) AS words FROM d),
s AS (SELECT r, doc_id, len(words) AS n_words, {', '.join(starts)} FROM w),
b AS (SELECT r, doc_id, n_words, {every} AS places, {base} AS base FROM s),
templates(label, tokens, least, reach) AS (VALUES {', '.join(templates)}),
lines AS (
  SELECT r, list_distinct(regexp_extract_all(line, {word})) AS line
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)),
paragraphs AS (
  SELECT r, regexp_extract_all(paragraph, {word}) AS words
  FROM (SELECT r, unnest(string_split_regex(t, '\n[ \t\r]*\n')) AS paragraph FROM d)),
passages AS (
  SELECT r, label, least, len(tokens) AS n, list_max(list_transform(range(1, greatest(len(words) - reach + 1, 1) + 1),
    lambda i: len(list_filter(tokens, lambda w: list_contains(words[i:i + reach - 1], w))))) AS held
  FROM paragraphs JOIN templates ON len(list_intersect(list_distinct(words), tokens)) >= least),
matched AS (
  SELECT r, label, len(list_intersect(line, tokens)) / len(tokens) AS share
  FROM lines JOIN templates ON len(list_intersect(line, tokens)) >= least
  UNION ALL SELECT r, label, held / n FROM passages WHERE held >= least),
found AS (SELECT r, list(label) AS more, max(share) AS share FROM matched GROUP BY r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
  CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM b LEFT JOIN found USING (r)"""
