"""The registered queries of the training-data operators (one per operator,
over whole tables, with production parameters) and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import chat, exact, jaccard, mixing, periodic, pieces, pii, quality, substring, suffix, token_counts, topk, whitening
from strata.llm.common import KEY, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f
    return add


# --- 1 chat formatting ------------------------------------------------------

def _esc(x: str) -> str:
    return f"replace(replace({x}, '\\', '\\0'), '<|', '<\\1')"


@query(rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
seg AS (
  SELECT *, role = 'assistant' AS target,
         row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(24 + length({_esc("replace(role, chr(10), '~~')")}) + length({_esc("text")})) OVER w AS upto
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE target), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE target), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (WHERE target OR i = n) AS BIGINT) AS formatted_chars,
       count(*) FILTER (WHERE target OR i = n) AS n_examples
FROM seg GROUP BY conv_id""")
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat formatting of all conversations and the planted conversation -1."""
    odd = "<|im_end|><|im_start|>assistant ok"
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)],
                                    "conv_id long, turn long, role string, text string")
    return chat.digests(chat.examples(turns.unionByName(planted)))


# --- 2 mixing ---------------------------------------------------------------

@query(rf"""
WITH docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat('7:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS spot FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM docs GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][(pos - 1) % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS lim FROM per),
levels AS (
  SELECT *, lim / weight AS ratio,
         (sum(source_size) OVER () * 1.5::DOUBLE
          - coalesce(sum(source_size) OVER b, 0) * 2.0::DOUBLE)
         / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM weighed WINDOW b AS (ORDER BY lim / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT *, least(lim, coalesce(weight * (SELECT min_by(level, (ratio, pos)) FROM levels WHERE level <= ratio), lim)) AS target,
         CAST(greatest(1, ceil(source_size / {mixing.SHARD_WORDS})) AS BIGINT) AS shards FROM levels),
blocks AS (SELECT CAST(greatest(1, least({mixing.BLOCK_WORDS}, coalesce(floor(min(target) FILTER (WHERE target > 0) / {mixing.LEAST_BLOCKS}), 1))) AS BIGINT) AS words
           FROM targets),
house AS (SELECT CAST(floor(sum(target) / (SELECT words FROM blocks)) AS BIGINT) AS n FROM targets),
quotients AS (
  SELECT pos, target / (2 * k - 1) AS q, k
  FROM (SELECT pos, target, unnest(range(1, CAST((SELECT n FROM house) AS BIGINT) + 1)) AS k FROM targets WHERE target > 0)),
seats AS (
  SELECT pos, count(*) AS seats FROM (SELECT pos, row_number() OVER (ORDER BY q DESC, pos, k) AS r FROM quotients)
  WHERE r <= (SELECT n FROM house) GROUP BY pos),
dealt AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.pos, d.spot, coalesce(s.seats, 0) AS seats,
         CAST(concat('0x', substr(spot, 1, 8)) AS BIGINT) % t.shards AS shard
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN seats s ON s.pos = t.pos),
rings AS (SELECT pos, shard, CAST(sum(size) AS BIGINT) AS ring, max(seats) AS seats FROM dealt GROUP BY pos, shard),
shard_quotients AS (
  SELECT pos, shard, seats, ring / (2 * k - 1) AS q, k
  FROM (SELECT pos, shard, seats, CAST(ring AS DOUBLE) AS ring, unnest(range(1, seats + 1)) AS k FROM rings WHERE ring > 0)),
quotas AS (
  SELECT pos, shard, count(*) AS quota
  FROM (SELECT pos, shard, seats, row_number() OVER (PARTITION BY pos ORDER BY q DESC, shard, k) AS r FROM shard_quotients)
  WHERE r <= seats GROUP BY pos, shard),
taken AS (
  SELECT r.pos, r.shard, r.ring, least(coalesce(quota, 0), CAST(floor(r.ring * 2 / (SELECT words FROM blocks)) AS BIGINT)) * (SELECT words FROM blocks) AS blocks
  FROM rings r LEFT JOIN quotas q ON q.pos = r.pos AND q.shard = r.shard),
placed AS (
  SELECT d.*, t.ring, t.blocks, CASE WHEN t.ring > 0 THEN CAST(floor(t.blocks / t.ring) AS BIGINT) ELSE 0 END AS rounds,
         CAST(sum(size) OVER (PARTITION BY d.pos, d.shard ORDER BY spot, doc_id, size
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM dealt d JOIN taken t ON d.pos = t.pos AND d.shard = t.shard)
SELECT doc_id, source, size, source_size, target,
       CAST(rounds * size + greatest(0, least(upto, blocks - rounds * ring) - (upto - size)) AS BIGINT) AS taken
FROM placed""")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixing of all documents: sources weigh 5, 2, 1, share 150 % of all words."""
    return mixing.mix(read(spark, sf_dir, "documents")).drop(KEY)


# --- 3 exact dedup ----------------------------------------------------------

@query("""
WITH norm AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
groups AS (SELECT t, count(*) AS n, max(doc_id) AS keep_id FROM norm GROUP BY t)
SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM norm JOIN groups USING (t)""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents; of equal texts the largest id stays."""
    return exact.exact_groups(read(spark, sf_dir, "documents"), keep="largest").drop(KEY)


# --- 4 substring dedup ------------------------------------------------------

@query(r"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM docs WHERE len(w) >= 13)),
firsts AS (SELECT win, min(doc_id) AS first FROM windows GROUP BY win),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i
  FROM windows JOIN firsts USING (win) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
left_over AS (SELECT words.* FROM words ANTI JOIN covered ON words.doc_id = covered.doc_id AND words.i = covered.i),
texts AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM left_over GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM docs d LEFT JOIN texts ON d.doc_id = texts.doc_id""")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removes the words of 13-word windows that an earlier document has."""
    return substring.deduplicated(read(spark, sf_dir, "documents")).drop("spans")


# --- 5 quality classifier ---------------------------------------------------

@query()
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores all documents with a model learnt from two thirds of the labels."""
    return quality.classified(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


# --- 6 n-gram Jaccard join --------------------------------------------------

@query(r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
texts AS (SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS t FROM shingles GROUP BY doc_id),
classes AS (SELECT t, min(doc_id) AS rep FROM texts GROUP BY t),
own AS (SELECT doc_id, s FROM shingles WHERE doc_id IN (SELECT rep FROM classes)),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM own a JOIN own b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY x, y),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT rep, rep FROM classes UNION SELECT r.x, b.y FROM reach r JOIN ways b ON r.y = b.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN texts t ON t.doc_id = d.doc_id
LEFT JOIN classes c ON c.t = t.t LEFT JOIN least l ON l.x = c.rep""")
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of all documents: 4-word shingles, Jaccard 0.85 or more."""
    return jaccard.linked(read(spark, sf_dir, "documents")).drop("class_id", KEY)


# --- 7 SentencePiece encoding and decoding ----------------------------------

@query()
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes all documents and reads them back."""
    return pieces.digests(read(spark, sf_dir, "documents"))


# --- 8 suffix-array dedup ---------------------------------------------------

@query("""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS row, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
windows AS (
  SELECT row, p, md5(substr(h, 2 * p + 1, 400)) AS win
  FROM (SELECT row, h, unnest(range(0, n - 199)) AS p FROM docs WHERE n >= 200)),
again AS (SELECT row, p FROM windows JOIN (SELECT win FROM windows GROUP BY win HAVING count(*) > 1) USING (win)),
marked AS (
  SELECT row, p, CASE WHEN p > lag(p) OVER (PARTITION BY row ORDER BY p) + 200 THEN 1
                      WHEN lag(p) OVER (PARTITION BY row ORDER BY p) IS NULL THEN 1 ELSE 0 END AS new FROM again),
spans AS (
  SELECT row, min(p) AS a, max(p) + 200 AS b
  FROM (SELECT row, p, sum(new) OVER (PARTITION BY row ORDER BY p) AS s FROM marked) GROUP BY row, s),
pieces AS (
  SELECT row, a, b, lag(b, 1, 0) OVER (PARTITION BY row ORDER BY a) AS since FROM spans),
parts AS (
  SELECT d.row, count(*) AS spans, sum(b - a) AS removed, max(b) AS upto,
         string_agg(substr(h, CAST(2 * since + 1 AS BIGINT), CAST(2 * (a - since) AS BIGINT)), '' ORDER BY a) AS before
  FROM docs d JOIN pieces p ON d.row = p.row GROUP BY d.row)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN p.row IS NULL THEN h ELSE concat(before, substr(h, CAST(2 * upto + 1 AS BIGINT))) END)) AS kept_sha256
FROM docs d LEFT JOIN parts p ON d.row = p.row""")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removes the bytes of 200-byte strings that start anywhere else too."""
    return suffix.deduplicated(read(spark, sf_dir, "documents")).drop("spans")


# --- 9 token counts ---------------------------------------------------------

@query()
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts.token_counts(read(spark, sf_dir, "documents"))


# --- 10 exact top-k search --------------------------------------------------

@query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q, len(embedding) AS dim
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.dim = b.dim AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 10""")
def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 by integer inner product for every 100th vector."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


# --- 11 embedding whitening ---------------------------------------------------

@query()
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 32 whitened components of every vector, fitted on all of them."""
    return whitening.whitened(read(spark, sf_dir, "embeddings"))


# --- 12 periodic run detection --------------------------------------------------

@query(r"""
WITH bits AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
         flatten([[(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) >> j) & 1 for j in range(8)]
                  for i in range(1, length(CAST(doc_id AS VARCHAR)) + 1)]) AS bits FROM documents),
hashed AS (
  SELECT row, doc_id, w, len(w) AS n,
         xor(list_reduce([4294967295::BIGINT] || list_transform(bits, lambda b: CAST(b AS BIGINT)),
                         lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) AS h FROM bits),
places AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a, 3 + (h // 10) % 8 AS parts FROM hashed),
docs AS (
  SELECT row, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i:
           w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END]) END AS w FROM places),
grams AS (
  SELECT row, n, i, array_to_string(w[i + 1:i + 5], ' ') AS gram
  FROM (SELECT row, n, w, unnest(range(0, n - 4)) AS i FROM docs WHERE n >= 6)),
pairs AS (
  SELECT a.row, b.i - a.i AS q, a.i FROM grams a JOIN grams b ON a.row = b.row AND a.gram = b.gram AND a.i < b.i
  WHERE 4 * (b.i - a.i) <= a.n),
islands AS (
  SELECT row, q, min(i) AS start, max(i) - min(i) + 5 + q AS length
  FROM (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM pairs)
  GROUP BY row, q, island HAVING max(i) - min(i) + 5 + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM islands x WHERE NOT EXISTS (
    SELECT 1 FROM islands y WHERE y.row = x.row AND y.q < x.q AND y.start <= x.start AND y.start + y.length >= x.start + x.length)),
per AS (
  SELECT row, count(*) AS n_runs, arg_min({'s': start, 'n': length, 'q': q}, [-length, start, q]) AS best,
         string_agg(concat(start, ',', length, ',', q, chr(10)), '' ORDER BY start, q) AS lines FROM runs GROUP BY row),
gone AS (SELECT DISTINCT row, unnest(range(start + q, start + length)) AS i FROM runs),
words AS (
  SELECT d.row, string_agg(word, ' ' ORDER BY d.i) AS t
  FROM (SELECT row, unnest(w) AS word, unnest(range(0, n)) AS i FROM docs) d ANTI JOIN gone ON gone.row = d.row AND gone.i = d.i GROUP BY d.row)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.n AS BIGINT) AS length,
       CAST(best.q AS BIGINT) AS period, CAST(1000 * best.n // best.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM docs LEFT JOIN per ON per.row = docs.row LEFT JOIN words ON words.row = docs.row""")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in all documents, of which a tenth is made periodic."""
    return periodic.periodic_runs(periodic.planted(read(spark, sf_dir, "documents")))


# --- 13 personal data -----------------------------------------------------------

@query()
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: base spans and those that the trees add."""
    return pii.digests(pii.found(read(spark, sf_dir, "documents")))
