"""SQL twins of the queries that SQL can express, for another engine."""

from __future__ import annotations

# The reflected CRC-32 (polynomial 3988292384), byte by byte with its table.
_LOOKUP = """lookup AS (
  SELECT list(list_reduce([k, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda v, s: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END) ORDER BY k) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS k))"""

SHARDS = f"""WITH {_LOOKUP},
hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
codes AS (
  SELECT doc_id, len(h) // 2 + 1 AS size,
    list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2),
      lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))) AS x FROM hexed),
sized AS (
  SELECT doc_id, size, xor(list_reduce(x,
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS text_crc32
  FROM codes, lookup),
summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(size) OVER () AS total FROM sized),
cut AS (SELECT *, CAST((2 * upto - size) * 8 // (2 * total) AS INTEGER) AS shard FROM summed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32,
  'bytes' AS law, shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM cut"""

NEAR_DOCUMENTS = r"""WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
sets AS (
  SELECT doc_id, CASE
      WHEN len(words) >= 5 THEN list_distinct(list_transform(range(1, len(words) - 3),
        lambda i: array_to_string(words[i:i + 4], ' ')))
      WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS grams
  FROM split),
tokens AS (SELECT doc_id, unnest(grams) AS gram FROM sets),
sizes AS (SELECT doc_id, len(grams) AS n FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM tokens a JOIN tokens b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * i >= 75 * (x.n + y.n - i)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a, b FROM edges
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles,
  least(s.doc_id, coalesce(m.least, s.doc_id)) AS component_id
FROM sizes s LEFT JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) m ON s.doc_id = m.a"""

SPELLING = rf"""WITH RECURSIVE {_LOOKUP},
split AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
own AS (SELECT doc_id, run, count(*) AS n FROM split WHERE length(run) >= 6 GROUP BY ALL),
hexed AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM own),
codes AS (
  SELECT run, n, list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2),
    lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))) AS x FROM hexed),
hashed AS (
  SELECT run, n, xor(list_reduce(x,
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS h FROM codes, lookup),
spelt AS (
  SELECT CASE WHEN h % 199 = 0
      THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
      ELSE run END AS word, n FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6
  GROUP BY word HAVING sum(n) >= 5),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM places),
near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b
    ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM less a JOIN words b ON a.rest = b.word),
placed AS (
  SELECT near.word, other, w.n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, other) AS place
  FROM near JOIN words w ON other = w.word),
best AS (
  SELECT w.word, w.n, coalesce(p.n_near, 0) AS n_near,
    CASE WHEN p.n >= 5 * w.n THEN other END AS form, CASE WHEN p.n >= 5 * w.n THEN p.n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM placed WHERE place = 1) p ON w.word = p.word),
path AS (
  SELECT word, coalesce(form, word) AS root FROM best
  UNION SELECT p.word, b.form FROM path p JOIN best b ON p.root = b.word WHERE b.form IS NOT NULL),
roots AS (
  SELECT p.word, p.root FROM path p JOIN best b ON p.root = b.word WHERE b.form IS NULL)
SELECT b.word, b.form, r.root, b.n, CAST(n_near AS BIGINT) AS n_near, form_n
FROM best b JOIN roots r ON b.word = r.word"""

NEAR_VECTORS = """WITH RECURSIVE numbered AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (
  SELECT r, vec_id, v FROM numbered
  WHERE vec_id IS NOT NULL AND len(v) > 0 AND len(v) = len(list_filter(v, lambda x: isfinite(x)))
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
edges AS (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON len(a.v) = len(b.v) AND a.r <> b.r
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= 0.9 END),
reach AS (
  SELECT a, b FROM edges
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a, min(vec_id) AS least FROM reach JOIN good ON b = r GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM edges GROUP BY a),
joined AS (
  SELECT vec_id, coalesce(n, 0) AS n_links,
    CASE WHEN least < vec_id THEN least ELSE vec_id END AS component_id
  FROM numbered LEFT JOIN least l ON r = l.a LEFT JOIN counted c ON r = c.a)
SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(n_links AS BIGINT) AS n_links,
  CAST(component_id AS BIGINT) AS component_id, coalesce(vec_id = component_id, true) AS kept
FROM joined"""

# All columns of the periodic runs but their list, so it is compared in the tests only.
# A run of smallest period q holds 2**k words, q <= 2**k <= 2q, from its start, and they
# stand next exactly q words on. So the distances to the next occurrence of 1, 2, 4, ..
# words are all periods that a text can have; each is then laid over the whole text.
PERIODIC_RUNS = rf"""WITH RECURSIVE {_LOOKUP},
hexed AS (
  SELECT row_number() OVER () AS r, doc_id,
    hex(encode(coalesce(CAST(doc_id AS VARCHAR), ''))) AS h,
    list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'),
      lambda w: w <> '') AS words FROM documents),
codes AS (
  SELECT r, doc_id, words, list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2),
    lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))) AS x FROM hexed),
hashed AS (
  SELECT r, doc_id, words, len(words) AS n, xor(list_reduce(x,
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS h FROM codes, lookup),
placed AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM hashed),
cut AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
docs AS (
  SELECT r, doc_id, n, CASE WHEN a IS NULL THEN words
    ELSE list_transform(range(0, n),
      lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS words FROM cut),
tokens AS (SELECT r, unnest(range(0, n)) AS i, unnest(words) AS w FROM docs),
grams AS (
  SELECT CAST(1 AS BIGINT) AS size, r, i, hash(w) AS g FROM tokens
  UNION ALL SELECT 2 * x.size, x.r, x.i, hash(x.g, y.g)
  FROM grams x JOIN grams y ON x.r = y.r AND y.i = x.i + x.size),
steps AS (SELECT size, r, lead(i) OVER (PARTITION BY size, r, g ORDER BY i) - i AS q FROM grams),
periods AS (SELECT DISTINCT r, q FROM steps WHERE size BETWEEN q AND 2 * q),
same AS (
  SELECT p.r, p.q, x.i, x.i - row_number() OVER (PARTITION BY p.r, p.q ORDER BY x.i) AS island
  FROM periods p JOIN tokens x ON p.r = x.r JOIN tokens y ON p.r = y.r AND y.i = x.i + p.q
  WHERE x.w = y.w),
stretches AS (
  SELECT r, q, min(i) AS s, count(*) + q AS size FROM same GROUP BY r, q, island
  HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT r, s, size, min(q) AS q FROM stretches GROUP BY r, s, size),
best AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY CAST(size AS DOUBLE) / q DESC, s, q) AS place
  FROM runs),
listed AS (
  SELECT r, count(*) AS n_runs,
    string_agg(s || ',' || size || ',' || q || chr(10), '' ORDER BY s, q) AS lines
  FROM runs GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(s + q, s + size)) AS i FROM runs),
kept AS (
  SELECT r, string_agg(w, ' ' ORDER BY i) AS words FROM tokens ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.s AS BIGINT) AS start,
  CAST(b.size AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
  CAST(1000 * b.size // b.q AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.words, '')) AS collapsed_sha256
FROM docs d LEFT JOIN (SELECT * FROM best WHERE place = 1) b ON d.r = b.r
  LEFT JOIN listed l ON d.r = l.r LEFT JOIN kept k ON d.r = k.r"""

ORACLE = {
    "op4_sharding": SHARDS,
    "op7_ngram_join": NEAR_DOCUMENTS,
    "op10_embedding_dedup": NEAR_VECTORS,
    "op12_spelling_variants": SPELLING,
}
