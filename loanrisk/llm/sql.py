"""DuckDB SQL for the rows of queries of this package, written apart from the operators, in the most direct form."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# lower() of DuckDB also folds other letters, so A-Z are translated one by one.
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

#: N-gram Jaccard join: all pairs that share a shingle, then what can be reached over links.
JACCARD_JOIN = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) >= 4 THEN list_transform(range(1, len(words) - 2), lambda k: array_to_string(words[k : k + 3], ' '))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS held
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * held >= 85 * (x.size + y.size - held)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT doc_id, b FROM reached JOIN links ON other = a
)
SELECT doc_id, CAST(coalesce(any_value(size), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

#: Ranked lexical search: every item's ten best documents.
LEXICAL_SEARCH = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), i AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), total AS (
  SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0
), held AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total
), scores AS (
  SELECT item_id, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_terms))))) AS BIGINT)
      AS score
  FROM i JOIN weights USING (term) JOIN held USING (term), total GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""

#: Importance resampling: features hashed by CRC-32, whose table follows from its polynomial.
RESAMPLING = rf"""
WITH RECURSIVE steps(byte, step, value) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT byte, step + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END
  FROM steps WHERE step < 8
), crc_table AS (
  SELECT list(value ORDER BY byte) AS entries FROM steps WHERE step = 8
), texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), words AS (
  SELECT side, id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts
), features AS (
  SELECT side, id, unnest(list_concat(words, list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])))
    AS feature
  FROM words
), counted AS (
  SELECT side, id, feature, count(*) AS times FROM features GROUP BY ALL
), hashed AS (
  SELECT feature, xor(list_reduce(
    list_concat([4294967295], list_transform(range(0, len(hex(feature)) // 2),
      lambda k: CAST('0x' || substr(hex(feature), CAST(2 * k + 1 AS INTEGER), 2) AS BIGINT))),
    lambda crc, byte: xor(crc >> 8, entries[(xor(crc, byte) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM counted), crc_table
), placed AS (
  SELECT side, id, bucket, CAST(sum(times) AS BIGINT) AS times FROM counted JOIN hashed USING (feature) GROUP BY ALL
), sums AS (
  SELECT CAST(coalesce(sum(times) FILTER (side = 'd'), 0) AS BIGINT) AS s_all,
         CAST(coalesce(sum(times) FILTER (side = 'b'), 0) AS BIGINT) AS t_all FROM placed
), gained AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1) * (s_all + 10000)) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM (SELECT bucket, CAST(coalesce(sum(times) FILTER (side = 'd'), 0) AS BIGINT) AS s,
               CAST(coalesce(sum(times) FILTER (side = 'b'), 0) AS BIGINT) AS t FROM placed GROUP BY bucket), sums
), weighed AS (
  SELECT id, CAST(sum(times) AS BIGINT) AS n, CAST(sum(times * gain) AS BIGINT) AS total
  FROM placed JOIN gained USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT w.id AS doc_id, len(words) AS n_words, coalesce(n, 0) AS n_features,
         CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE 0 END AS weight,
         CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || w.id), 1, 8) AS BIGINT) + 0.5) / 4294967296)))
           AS BIGINT) AS noise
  FROM words w LEFT JOIN weighed USING (id) WHERE side = 'd'
), ranked AS (
  SELECT *, weight + noise AS score,
         row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id) AS place FROM scored
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN n_words >= 20 AND place <= (25 * (SELECT count(*) FROM scored WHERE n_words >= 20)) // 100 THEN place END
         AS rank
FROM ranked
"""
