"""One query per operator: it applies the operator, with its production parameters, to
its whole table and derives the contract's columns. SQL says the same for DuckDB where it can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    anchor_dedup, centroids, exact_dedup, interpolated_lm, jump_shards, language_svm, order_minhash, packing, quality_qda, source_mix, spelling, topk_nra,
    toxicity_kn)
from .common import held_out, read_table

QUALITY_THRESHOLD, TOXIC_THRESHOLD = 0.3, 0.5
LABEL_FOLDS, LABEL_FOLD, LANG_FOLDS, LANG_FOLD = 5, 0, 4, 2
LM_FOLDS, LM_FOLD = 7, 2


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that may be learned: those of the fold are held out."""
    return read_table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), LABEL_FOLDS, LABEL_FOLD))


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_classes(read_table(spark, sf_dir, "documents"))


def op2_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_qda.quality_scores(read_table(spark, sf_dir, "documents"), training_labels(spark, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id"), LABEL_FOLDS, LABEL_FOLD).alias("held_out"), "score",
                         (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op3_toxicity_kn(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity_kn.toxicity_scores(read_table(spark, sf_dir, "documents"), training_labels(spark, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id"), LABEL_FOLDS, LABEL_FOLD).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_THRESHOLD).cast("int").alias("predicted"))


def op4_bloom_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(read_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = jump_shards.shard_documents(read_table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op6_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_amounts(read_table(spark, sf_dir, "documents"))


def op7_nra_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_nra.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_anchor_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_dedup.drop_repeats(read_table(spark, sf_dir, "documents"), window=35, with_text=False)


def op9_hierarchical_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_svm.train(docs, ~held_out(F.col("doc_id"), LANG_FOLDS, LANG_FOLD))
    return language_svm.predict_languages(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), LANG_FOLDS, LANG_FOLD).alias("held_out"), "lang_pred", "score")


def op10_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(read_table(spark, sf_dir, "documents"))


def op12_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(read_table(spark, sf_dir, "embeddings"))


def op13_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(F.col("doc_id"), LM_FOLDS, LM_FOLD)
    return interpolated_lm.text_scores(read_table(spark, sf_dir, "documents"), ~out).select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {f.__name__: f for f in (
    op1_order_minhash, op2_quality_qda, op3_toxicity_kn, op4_bloom_exact_dedup, op5_jump_sharding, op6_sainte_lague_mix, op7_nra_top_k,
    op8_anchor_substring_dedup, op9_hierarchical_language, op10_sum_of_squares_packing, op11_spelling_variants, op12_simplex_clusters,
    op13_interpolated_lm)}


def _cluster_sql(rounds: int = 3) -> str:
    """Rounds of assignment and exact floor means, one common table expression each."""
    distance = "list_sum([(v[i] - m[i]) * (v[i] - m[i]) FOR i IN range(1, 65)])"
    # the remainder of SQL has the dividend's sign, so it is made positive before it is taken off
    floor = "((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT"
    text = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
           WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1)::INTEGER AS c, v AS m FROM v WHERE vec_id IS NOT NULL QUALIFY c < 16)"""
    for n in range(rounds + 1):
        text += f""",
a{n} AS (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min(ROW({distance}::BIGINT, c)) AS best FROM v, c{n} GROUP BY r)"""
        if n < rounds:
            text += f""",
u{n} AS (SELECT c, list(x ORDER BY i) AS m FROM (SELECT best[2] AS c, i, {floor} AS x FROM a{n}, range(1, 65) AS t(i) GROUP BY best[2], i) GROUP BY c),
c{n + 1} AS (SELECT c, coalesce(u{n}.m, c{n}.m) AS m FROM c{n} LEFT JOIN u{n} USING (c))"""
    return text + f"""
SELECT vec_id, c AS cluster, best[1] AS distance, (sum(best[1]) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(best[1]) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c = best[2]"""


SQL = {
    "op4_bloom_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)""",
    # seats are listed one by one, and so are the words of each source around its circle
    "op6_sainte_lague_mix": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('0' || source, '1') AS skey, coalesce(doc_id::VARCHAR, 'null') AS did,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT skey, sum(size)::BIGINT AS source_size FROM d GROUP BY skey),
w AS (SELECT *, 3 * source_size AS cap, (row_number() OVER (ORDER BY skey) - 1) % 3 + 1 AS weight FROM s),
t AS (SELECT sum(source_size)::BIGINT AS total, sum(weight)::BIGINT AS weights, count(*) AS n FROM w),
l AS (SELECT w.*, (total - coalesce(sum(cap) OVER o, 0))::DOUBLE / (weights - coalesce(sum(weight) OVER o, 0))::DOUBLE AS level
      FROM w, t WINDOW o AS (ORDER BY cap::DOUBLE / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT skey, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM l),
seats AS (SELECT skey, target, unnest(range(1, (target / 4)::BIGINT + n::BIGINT + 3)) AS k FROM g, t WHERE target > 0),
won AS (SELECT skey, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, skey, k) AS place FROM seats),
q AS (SELECT skey, count(*) AS quota FROM won, t WHERE place <= floor(total / 4.0 + 0.5) GROUP BY skey),
p AS (SELECT g.*, least(4 * coalesce(quota, 0), 3 * source_size) AS given,
             4 * (('0x' || substr(md5('17:start:' || skey), 1, 13))::BIGINT % greatest(ceil(source_size / 4.0)::BIGINT, 1)) AS start
      FROM g LEFT JOIN q USING (skey)),
word AS (SELECT r, skey, row_number() OVER (PARTITION BY skey ORDER BY md5('17:' || did), did, size, r, i) - 1 AS place
         FROM (SELECT *, unnest(range(size)) AS i FROM d)),
times AS (SELECT r, sum(given // source_size + CASE WHEN (place - start + source_size) % source_size < given % source_size THEN 1 ELSE 0 END)::BIGINT AS taken
          FROM word JOIN p USING (skey) GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM d JOIN p USING (skey) LEFT JOIN times USING (r)""",
    "op7_nra_top_k": r"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
      FROM v AS q JOIN v ON q.r <> v.r WHERE q.vec_id % 100 = 0),
k AS (SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM k WHERE rank <= 10""",
    "op8_anchor_substring_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT r, s, md5(array_to_string(ws[s:s + 34], ' ')) AS h FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS s FROM d)),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM win SEMI JOIN rep USING (h)),
word AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)""",
    # CRC-32 by its rule; words are near if they are equal but for one place, or once one place is deleted
    "op11_spelling_variants": r"""
WITH RECURSIVE
t AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
      FROM range(256) AS r(i)),
run AS (SELECT coalesce(doc_id::VARCHAR, 'null') AS did,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents),
own AS (SELECT did, w, count(*) AS n, hex(encode(did || ':' || w)) AS x FROM run WHERE length(w) >= 5 GROUP BY did, w),
code AS (SELECT w, n, xor(list_reduce([4294967295] || [('0x' || substr(x, 2 * k + 1, 2))::BIGINT FOR k IN range(len(x) // 2)],
                                      lambda c, b: xor(c >> 8, t[(xor(c, b) % 256 + 1)::INTEGER])), 4294967295) AS h FROM own, t),
slip AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::INTEGER) || substr(w, (h % length(w) + 2)::INTEGER) ELSE w END AS word, n FROM code),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slip WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gap AS (SELECT word, n, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM words, unnest(range(1, length(word) + 1)) AS u(i)),
near AS (SELECT a.word, b.word AS other, b.n FROM gap AS a JOIN gap AS b USING (l, r) WHERE a.word <> b.word
         UNION SELECT g.word, w.word, w.n FROM gap AS g JOIN words AS w ON w.word = g.l || g.r
         UNION SELECT w.word, g.word, g.n FROM gap AS g JOIN words AS w ON w.word = g.l || g.r),
best AS (SELECT word, count(*) AS n_near, min(ROW(-n, other)) AS b FROM near GROUP BY word),
forms AS (SELECT word, CASE WHEN -b[1] >= 2 * n THEN b[2] END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b[1] >= 2 * n THEN -b[1] END AS form_n
          FROM words LEFT JOIN best USING (word)),
up AS (SELECT word, word AS root FROM forms UNION ALL SELECT up.word, f.form FROM up JOIN forms AS f ON f.word = up.root WHERE f.form IS NOT NULL),
top AS (SELECT up.word, up.root FROM up JOIN forms AS f ON f.word = up.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN top USING (word)""",
    "op12_simplex_clusters": _cluster_sql(),
}
