"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from hitloom.llm.sharding import LIMIT_BYTES

# A bucket is split while it is over the limit, so the shard of a row is the shallowest
# of its prefixes that fits or holds one row.
OP9 = f"""
WITH rows AS (
    SELECT doc_id AS key, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS hash
    FROM documents
), prefixes AS (
    SELECT key, n_bytes, d.depth,
           right(lpad(bin(hash), 60, '0'), 60)[1:d.depth] AS shard
    FROM rows, (SELECT unnest(range(0, 61))::INTEGER AS depth) d
), buckets AS (
    SELECT depth, shard, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS n
    FROM prefixes GROUP BY depth, shard
), first AS (
    SELECT key, n_bytes, min(p.depth) AS depth
    FROM prefixes p JOIN buckets b ON p.depth = b.depth AND p.shard = b.shard
    WHERE b.shard_bytes <= {LIMIT_BYTES} OR b.n = 1
    GROUP BY key, n_bytes
)
SELECT f.key AS doc_id, p.shard, f.depth, f.n_bytes, b.shard_bytes,
       b.shard_bytes > {LIMIT_BYTES} AS oversized
FROM first f
JOIN prefixes p ON p.key = f.key AND p.depth = f.depth
JOIN buckets b ON b.depth = p.depth AND b.shard = p.shard
"""

_REACH = """
reach(a, b) AS (
    SELECT {key}, {key} FROM {table}
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
"""

OP10 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), grams AS (
    SELECT DISTINCT doc_id, w[i : i + 3] AS gram
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i
          FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), common_grams AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id
), links AS (
    SELECT a, b FROM common_grams
    JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), """ + _REACH.format(key="doc_id", table="documents") + """
SELECT a AS doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(b) AS component_id
FROM reach LEFT JOIN sizes ON sizes.doc_id = a
GROUP BY a
"""

OP8 = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL
      AND NOT list_contains([coalesce(isfinite(x), false) for x in embedding], false)
      AND list_contains([x <> 0 for x in embedding], true)
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b
    FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id <> y.vec_id
    WHERE list_cosine_similarity(x.v, y.v) >= 0.93
), """ + _REACH.format(key="vec_id", table="embeddings") + """
SELECT r.a AS vec_id, any_value(coalesce(c.n, 0))::BIGINT AS n_links,
       min(r.b) AS component_id, min(r.b) = r.a AS kept
FROM reach r LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = r.a
GROUP BY r.a
"""

# The crc32 runs over the bytes of a run with the table of its polynomial. Two words are one
# edit apart when dropping a letter of one, or the letter at one place of both, makes them meet.
OP11 = r"""
WITH RECURSIVE runs AS MATERIALIZED (
    SELECT doc_id, run, len(run) AS size, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS run
        FROM documents)
    GROUP BY ALL
), crc_steps(b, c, step) AS (
    SELECT b, b, 0 FROM (SELECT unnest(range(0, 256)) AS b)
    UNION ALL
    SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1
    FROM crc_steps WHERE step < 8
), crc_table AS MATERIALIZED (
    SELECT list(c ORDER BY b) AS crc FROM crc_steps WHERE step = 8
), hashed AS (
    SELECT run, size, n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
        lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
                       ELSE [195::BIGINT, (unicode(x) - 64)::BIGINT] END))),
        lambda c, x: xor(c >> 8, crc[xor(c, x) % 256 + 1])), 4294967295::BIGINT) AS h
    FROM runs, crc_table
), results AS (
    SELECT CASE WHEN h % 31 = 0
                THEN substr(run, 1, (h % size)::BIGINT) || substr(run, (h % size + 2)::BIGINT)
                ELSE run END AS word, n
    FROM hashed
), words AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n FROM results WHERE len(word) >= 7
    GROUP BY word HAVING sum(n) >= 2
), dropped AS MATERIALIZED (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words)
), near AS MATERIALIZED (
    SELECT DISTINCT x.word, x.n, y.word AS other, y.n AS other_n
    FROM dropped x JOIN dropped y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
    UNION
    SELECT x.word, x.n, y.word, y.n FROM dropped x JOIN words y ON x.rest = y.word
    UNION
    SELECT y.word, y.n, x.word, x.n FROM dropped x JOIN words y ON x.rest = y.word
), best AS (
    SELECT word, count(*) AS n_near,
           min(ROW(-other_n, other)) AS least
    FROM near GROUP BY word
), forms AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
           CASE WHEN -least[1] >= 10 * w.n THEN least[2] END AS form,
           CASE WHEN -least[1] >= 10 * w.n THEN -least[1] END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word
), steps(word, here, depth) AS (
    SELECT word, word, 0 FROM forms
    UNION ALL
    SELECT s.word, f.form, depth + 1 FROM steps s JOIN forms f ON f.word = s.here
    WHERE f.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n::BIGINT AS form_n, s.root
FROM forms f JOIN (SELECT word, arg_max(here, depth) AS root FROM steps GROUP BY word) s
  ON s.word = f.word
"""

OP13 = """
WITH vectors AS MATERIALIZED (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) for x in embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND NOT list_contains([coalesce(isfinite(x), false) for x in embedding], false)
), scores AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           list_inner_product(a.v, b.v)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, positive_id
                           ORDER BY s.score DESC, s.other_id))::INTEGER AS rank,
       s.other_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLE_SQL: dict[str, str] = {
    "op8_pigeonhole_dedup": OP8,
    "op10_ngram_join": OP10,
    "op9_extendible_shards": OP9,
    "op11_spelling_variants": OP11,
    "op13_hard_negatives": OP13,
}
