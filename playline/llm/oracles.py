"""Operators said again in DuckDB's SQL, over whole tables: plain joins and windows, no shared method."""

from __future__ import annotations

from playline.llm.quality import FEWEST_WORDS, GRAM_LIMITS, LINE_LIMIT

#: All 50-byte strings of all documents, as hexadecimal digits.
SUFFIX_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), places AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM texts)
), first AS (
  SELECT s, min(doc_id) AS first_id FROM places GROUP BY s HAVING count(DISTINCT doc_id) > 1
), starts AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
  FROM places JOIN first USING (s) WHERE first_id < doc_id
), runs AS (
  SELECT doc_id, min(i) AS low, max(i) + 50 AS high
  FROM (SELECT *, sum(CASE WHEN i <= before + 50 THEN 0 ELSE 1 END)
               OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts)
  GROUP BY doc_id, run
), gaps AS (
  SELECT *, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS from_byte FROM runs
), cut AS (
  SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans, max(high) AS last,
    string_agg(substr(h, 2 * from_byte + 1, 2 * (low - from_byte)), '' ORDER BY low) AS kept
  FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""


def _repetition() -> str:
    sizes = [3, *GRAM_LIMITS]
    twice = ", ".join(
        f"i <= n - {n - 1} AND count(*) OVER (PARTITION BY r, array_to_string(ws[i : i + {n - 1}], ' '),"
        f" i <= n - {n - 1}) > 1 AS twice{n}"
        for n in sizes
    )
    inside = ", ".join(
        f"bool_or(twice{n}) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        f" AS inside{n}"
        for n in sizes
    )
    chars = ", ".join(f"sum(length(word)) FILTER (inside{n}) AS c{n}" for n in GRAM_LIMITS)
    shown = ", ".join(f"CAST(coalesce(c{n}, 0) AS BIGINT) AS dup_{n}gram_chars" for n in GRAM_LIMITS)
    few = " AND ".join(
        f"dup_{n}gram_chars <= CAST({limit} AS DOUBLE) * word_chars" for n, limit in GRAM_LIMITS.items()
    )
    return rf"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), words AS (
  SELECT r, ws, len(ws) AS n, unnest(range(1, len(ws) + 1)) AS i FROM texts
), grams AS (SELECT r, i, ws[i] AS word, {twice} FROM words),
covered AS (SELECT r, word, {inside} FROM grams),
counts AS (
  SELECT r, sum(length(word)) AS word_chars, count(*) FILTER (inside3) AS n_repeat_words, {chars}
  FROM covered GROUP BY r
), split AS (SELECT r, string_split(t, chr(10)) AS ls FROM texts),
lines AS (
  SELECT r, ls[i] AS line, row_number() OVER (PARTITION BY r, ls[i] ORDER BY i) > 1 AS later
  FROM (SELECT r, ls, unnest(range(1, len(ls) + 1)) AS i FROM split)
), again AS (
  SELECT r, count(*) AS n_dup_lines,
    sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) AS dup_line_chars
  FROM lines WHERE later AND regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), measured AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(dup_line_chars, 0) AS BIGINT) AS dup_line_chars, {shown}
  FROM texts LEFT JOIN counts USING (r) LEFT JOIN again USING (r)
), judged AS (
  SELECT *, n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT *, NOT base_failed AND dup_line_chars <= CAST({LINE_LIMIT} AS DOUBLE) * word_chars AND {few} AS kept
FROM judged
"""


REPETITION = _repetition()

#: Equal sets are joined once; pairs of different ones by all their shingles.
JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_sort(list_distinct(
    [array_to_string(ws[i : i + 4], ' ') for i in range(1, greatest(len(ws) - 4, 1) + 1)])) END AS s
  FROM words
), named AS (
  SELECT doc_id, s, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY s) END AS set_id
  FROM sets
), shingles AS (
  SELECT doc_id AS id, len(s) AS n, unnest(s) AS shingle FROM named WHERE doc_id = set_id AND len(s) > 0
), links AS (
  SELECT a.id AS a, b.id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id AS id, doc_id AS other FROM named WHERE doc_id = set_id
  UNION SELECT id, b FROM reached JOIN links ON other = a
), smallest AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM named JOIN smallest ON set_id = id
"""

#: Base32 of a SHA-1 digest: five hexadecimal digits are four letters.
WARC = r"""
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, payload, sha1(payload) AS h FROM payloads
), named AS (
  SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY payload) AS first_id,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST(1 + ((CAST('0x' || substr(h, CAST(5 * (k // 4) + 1 AS INT), 5) AS BIGINT)
                 >> CAST(15 - 5 * (k % 4) AS INT)) & 31) AS INT), 1) for k in range(0, 32)], '') AS payload_digest
  FROM digests
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM named
"""
