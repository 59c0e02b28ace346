"""DuckDB SQL for the queries that SQL can express."""

from shelfmark.llm.collocations import COVER_PERCENT, LONGEST, SCALE, THRESHOLD, TOP
from shelfmark.llm.licenses import BAND, BASE, COVERAGE, GRAM, MORE, STRETCH

# SHA-1 in hexadecimal digits, as base 32: eight characters from each ten digits
WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM payloads),
named AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(hex, ((i // 8) * 10 + 1)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest
  FROM digests),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM named)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM firsts"""

# the same votes with the words themselves instead of their hashes
LICENSES = f"""
WITH templates(template, label, is_base, phrase) AS (VALUES {", ".join(
    f"({n}, '{label}', {str(n < len(BASE)).lower()}, '{text}')" for n, (label, text) in enumerate((*BASE, *MORE)))}),
grams AS (
  SELECT template, label, is_base, len(w)::INT AS n_words, t::INT AS t, w[t + 1 : t + {GRAM}] AS gram
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM templates), LATERAL (SELECT unnest(range(len(w) - {GRAM - 1})) AS t)),
texts AS (
  SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
rolled AS (
  SELECT DISTINCT doc_id, text, i::INT AS d, words[i + 1 : i + {GRAM}] AS gram
  FROM texts, LATERAL (SELECT unnest(range(len(words) - {GRAM - 1})) AS i)),
votes AS (SELECT *, d - t AS diagonal FROM rolled JOIN grams USING (gram)),
diagonals AS (
  SELECT doc_id, text, template, label, is_base, n_words, diagonal, list(DISTINCT t) AS found, min(d) AS low, max(d) AS high
  FROM votes GROUP BY ALL),
marked AS (
  SELECT *, len(found) = n_words - {GRAM - 1} AS exact,
    coalesce(diagonal - lag(diagonal) OVER by_template > least({BAND}, n_words - {GRAM - 1}), true) AS far
  FROM diagonals WINDOW by_template AS (PARTITION BY doc_id, text, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(far::INT) OVER (PARTITION BY doc_id, text, template ORDER BY diagonal) AS span FROM marked),
spans AS (
  SELECT doc_id, text, template, label, is_base, n_words, len(list_distinct(flatten(list(found)))) / (n_words - {GRAM - 1})::DOUBLE AS coverage,
    max(high) + {GRAM} - min(low) AS length, count(*) FILTER (exact) AS n_places,
    min(diagonal) FILTER (exact) AS first_place, max(diagonal) FILTER (exact) AS last_place
  FROM numbered GROUP BY doc_id, text, template, label, is_base, n_words, span),
kept AS (SELECT * FROM spans WHERE n_places > 0 OR (coverage >= {COVERAGE} AND length <= n_words * {STRETCH})),
found AS (
  SELECT doc_id, text, coalesce(sum(n_places) FILTER (is_base), 0)::BIGINT AS n_base,
    min(first_place) FILTER (is_base)::BIGINT AS first_word, max(last_place) FILTER (is_base)::BIGINT AS last_word,
    list(DISTINCT label) FILTER (is_base AND n_places > 0) AS base, list(DISTINCT label) AS every, max(coverage) AS score
  FROM kept GROUP BY doc_id, text)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words, coalesce(f.n_base, 0)::BIGINT AS n_base, f.first_word, f.last_word,
  coalesce(array_to_string(list_sort(f.base), ','), '') AS base_labels, coalesce(array_to_string(list_sort(f.every), ','), '') AS labels,
  coalesce(f.score, 0)::DOUBLE AS score
FROM texts t LEFT JOIN found f ON t.doc_id IS NOT DISTINCT FROM f.doc_id AND t.text IS NOT DISTINCT FROM f.text"""

# all phrases of up to four words, counted as they stand
COLLOCATIONS = f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts)),
grams AS (
  SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, k
  FROM pieces, (SELECT unnest(range(1, {LONGEST + 1})) AS k) sizes, LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)),
counts AS (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
found AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= {THRESHOLD}),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM found),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.w, c.a, c.cut, x.f AS l, y.f AS r, ({SCALE}::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1 : c.k], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (
  SELECT lang, a AS longer, array_to_string(w[i : i + m - 1], ' ') AS phrase
  FROM found, (SELECT unnest(range(2, {LONGEST})) AS m) sizes, LATERAL (SELECT unnest(range(1, k - m + 2)) AS i) WHERE m < k),
most AS (SELECT lang, phrase, max(longer) AS longer FROM parts GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN most m USING (lang, phrase)
  WHERE m.longer IS NULL OR 100::HUGEINT * m.longer < {COVER_PERCENT}::HUGEINT * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l,
  r::BIGINT AS r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {TOP}"""

ORACLES: dict[str, str] = {"op4_warc": WARC, "op8_license_scan": LICENSES, "op11_collocations": COLLOCATIONS}
