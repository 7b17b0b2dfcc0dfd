"""DuckDB SQL of the registered queries that SQL can express.

Each is written from the result's definition and shares only fixed parameters
(seeds, block and shard sizes) with the Spark code.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def draw(seed: int, text: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', '{seed}', {text})), 1, 15))::BIGINT"


ID = "coalesce(CAST(doc_id AS VARCHAR), '')"

#: Seats by highest quotients, as a list of every seat's quotient; per source, then per shard.
MIXING = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         CAST(len({WORDS}) AS BIGINT) AS size, {draw(11, ID)} AS d1, {draw(13, ID)} AS d2
  FROM documents),
src AS (
  SELECT key, count(*) AS n_docs, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY key) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY key),
fill AS (  -- share the rest by weight until no target is above its cap
  SELECT 0 AS round, key, source_size, weight, n_docs, FALSE AS stops FROM src
  UNION ALL
  SELECT round + 1, key, source_size, weight, n_docs,
         stops OR 3.0::DOUBLE * source_size <= weight * CAST(rest AS DOUBLE) / open_weight
  FROM (SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) FILTER (stops) OVER (), 0) AS rest,
               sum(weight) FILTER (NOT stops) OVER () AS open_weight FROM fill)
  WHERE round < 64),
target AS (
  SELECT key, n_docs, source_size, CAST(sum(source_size) OVER () AS BIGINT) AS all_size,
         CASE WHEN stops THEN CAST(3 * source_size AS DOUBLE) ELSE weight *
           CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) FILTER (stops) OVER (), 0) AS DOUBLE)
           / sum(weight) FILTER (NOT stops) OVER () END AS target
  FROM fill WHERE round = 64),
seat AS (
  SELECT key, count(*) AS seats FROM (
    SELECT key, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, key) AS r, all_size
    FROM target, unnest(range(CAST(target / 4 AS BIGINT) + 2 + CAST(all_size / 400 AS BIGINT))) AS u(k) WHERE target > 0)
  WHERE r <= CAST(round(all_size / 4) AS BIGINT) GROUP BY key),
dealt AS (
  SELECT s.*, t.source_size, t.target, d1 % CAST(ceil(t.n_docs / 2000) AS BIGINT) AS shard
  FROM sized s JOIN target t USING (key)),
shard AS (
  SELECT key, shard, CAST(sum(size) AS BIGINT) AS shard_size FROM dealt GROUP BY key, shard),
quota AS (
  SELECT key, shard, count(*) AS quota FROM (
    SELECT key, shard, seats, row_number() OVER (PARTITION BY key ORDER BY shard_size::DOUBLE / (2 * k + 1) DESC, shard) AS r
    FROM shard JOIN seat USING (key), unnest(range(seats)) AS u(k) WHERE shard_size > 0)
  WHERE r <= seats GROUP BY key, shard),
plan AS (
  SELECT key, shard, shard_size, n_blocks, least(coalesce(quota, 0), 3 * n_blocks) AS quota,
         {draw(12, "key, CAST(shard AS VARCHAR)")} % greatest(n_blocks, 1) AS first_block
  FROM (SELECT *, CAST(ceil(shard_size / 4) AS BIGINT) AS n_blocks FROM shard) LEFT JOIN quota USING (key, shard)),
line AS (
  SELECT d.*, p.* EXCLUDE (key, shard), quota // greatest(n_blocks, 1) AS turns, quota % greatest(n_blocks, 1) AS extra,
         CAST(sum(size) OVER (PARTITION BY key, shard ORDER BY d2, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM dealt d JOIN plan p USING (key, shard))
SELECT doc_id, size, source_size, target,
       CAST(turns * size
       + greatest(least(start + size, (first_block + extra) * 4, shard_size) - greatest(start, first_block * 4), 0)
       + greatest(least(start + size, (first_block + extra - n_blocks) * 4, shard_size) - start, 0) AS BIGINT) AS taken
FROM line
"""

#: Links from counts of common shingles; then the smallest id that can be reached.
MINHASH = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, [translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FOR x IN {WORDS}] AS words
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) = 1 THEN words[1] ELSE words[i] || ' ' || words[i + 1] END AS s
  FROM w, unnest(range(1, greatest(len(words), 2))) AS u(i) WHERE len(words) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN size x ON x.doc_id = a.doc_id JOIN size y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, min(reach.b) AS component_id, min(reach.b) = w.doc_id AS kept
FROM w LEFT JOIN size USING (doc_id) JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id, n
"""

#: A window is repeated if its words start earlier anywhere.
LZ_DEDUP = f"""
WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
win AS (
  SELECT doc_id, s, list_slice(words, s, s + 19) AS win FROM w, unnest(range(1, len(words) - 18)) AS u(s)),
again AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, s + k AS i FROM again, unnest(range(20)) AS u(k)),
word AS (SELECT doc_id, i, words[i] AS word FROM w, unnest(range(1, len(words) + 1)) AS u(i)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

#: Every anchor with every row; exact inner products of whole numbers.
HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS alike,
         CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT * FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, p.other_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.alike AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""

ORACLE_SQL: dict[str, str] = {
    "op2_lz_dedup": LZ_DEDUP,
    "op7_source_mix": MIXING,
    "op9_minhash": MINHASH,
    "op12_hard_negatives": HARD_NEGATIVES,
}
