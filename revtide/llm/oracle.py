"""SQL for the text queries that SQL can express; doc_id and page_id are unique in the sample tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, concat(words[i], ' ', words[i + 1], ' ', words[i + 2]) AS three
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS place
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, three) AS times FROM windows) WHERE times > 1)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, host, text, len(parts) AS n, array_to_string(parts, ' ') AS line FROM (
    SELECT doc_id, host, text, regexp_extract_all(translate(line, '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}+') AS parts
    FROM (SELECT doc_id, host, text, unnest(lines) AS line FROM d))),
over_limit AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT text) AS texts FROM lines GROUP BY host, line)
  JOIN (SELECT host, count(DISTINCT text) AS host_texts FROM lines GROUP BY host) USING (host)
  WHERE texts > greatest(20, host_texts * CAST(0.05 AS DOUBLE))),
lost AS (SELECT doc_id, sum(n) AS n FROM lines JOIN over_limit USING (host, line) GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         CAST(coalesce(l.n, 0) AS BIGINT) AS removed_words
  FROM d LEFT JOIN repeated r USING (doc_id) LEFT JOIN lost l USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT removed_words * 100 > n_words * 50 AS kept
FROM counted
"""

# Base 32: the 160 bits of the checksum, five at a time.
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
bits AS (
  SELECT page_id, payload,
         array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(instr('0123456789abcdef', sha1(payload)[i]) - 1), 4, '0')), '') AS b
  FROM p)
SELECT page_id, strlen(payload) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST(concat('0b', substr(b, 5 * i + 1, 5)) AS INTEGER)]), '') AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to,
       CASE WHEN page_id = max(page_id) OVER same THEN strlen(payload) ELSE 0 END AS block_bytes,
       TRUE AS intact
FROM bits WINDOW same AS (PARTITION BY payload)
"""

#: Phrases of up to five words by language, counted one by one.
PHRASES = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), pieces AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs)
), words AS (
  SELECT lang, piece, unnest(w) AS w1, unnest(range(len(w))) AS i FROM pieces
), runs AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4, lead(w1, 4) OVER p AS w5
  FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)
), places AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM runs
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM runs WHERE w5 IS NOT NULL
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM places GROUP BY ALL
), n AS (
  SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 100
), cuts AS (
  SELECT *, lang || chr(1) || array_to_string(w[1:cut], ' ') AS left_key,
         lang || chr(1) || array_to_string(w[cut + 1:], ' ') AS right_key
  FROM (SELECT *, unnest(generate_series(1, size - 1)) AS cut FROM candidates)
), parts AS MATERIALIZED (
  SELECT lang || chr(1) || phrase AS key, f FROM f WHERE f >= 100
), scored AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.w, x.f AS l, y.f AS r, n.n, c.cut,
         (1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts AS c JOIN n USING (lang) JOIN parts AS x ON x.key = c.left_key JOIN parts AS y ON y.key = c.right_key
), least AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_parts AS (
  SELECT lang, a, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, size - k + 1)) AS i FROM candidates, (VALUES (2), (3), (4)) AS v(k) WHERE k < size)
), kept AS (
  SELECT * FROM least AS p WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts AS q WHERE q.lang = p.lang AND q.phrase = p.phrase AND 100 * q.a >= 100 * p.a)
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

#: Scores of all documents for all questions, term by term.
RANKED = rf"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), size AS (
  SELECT doc_id, sum(tf) AS n FROM tf GROUP BY doc_id
), total AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, docs
), factors AS (
  SELECT doc_id, CAST(10 + (90 * n * docs) // terms AS BIGINT) AS m FROM size, total
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN factors USING (doc_id)
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
