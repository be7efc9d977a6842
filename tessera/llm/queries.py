"""The queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ann, bpe, conversation, exactdedup, hardneg, htmltext, langid, lmscore, mixing, neardup, simhash, toxicity, urlfilter
from tessera.llm.common import fold, read

TOXIC_FROM = 0.3
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    part = fold(F.col("doc_id"), 3)
    model = langid.fit(docs.where(part != 1))
    rows = docs.select("doc_id", "text", F.coalesce(part == 1, F.lit(False)).alias("held_out"))
    return langid.predict(rows, model, keep=("doc_id", "held_out"))


def op2_lm_score(spark: SparkSession, d: str) -> DataFrame:
    """Target: documents labelled of good quality; background: all documents."""
    docs = read(spark, d, "documents")
    target = read(spark, d, "labels").where("quality = 1").select("doc_id")
    return lmscore.score(docs, target, keep=("doc_id",))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    return toxicity.fit(docs, labels.where(fold(F.col("doc_id"), 4) != 2))


def op3_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    model = fit_toxicity(docs, read(spark, d, "labels"))
    rows = docs.select("doc_id", "text", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"))
    scored = toxicity.score(rows, model, keep=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op4_html_text(spark: SparkSession, d: str) -> DataFrame:
    made = htmltext.extract(read(spark, d, "pages"), htmltext.fit(spark), keep=("page_id", "url"))
    return made.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op5_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return urlfilter.judge(read(spark, d, "pages"), urlfilter.fit(spark), URL_RULES, keep=("page_id",))


def op6_simhash(spark: SparkSession, d: str) -> DataFrame:
    groups = simhash.simhash_groups(read(spark, d, "documents"), words=3, radius=3)
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         F.col("component").alias("component_id"))


def op7_bpe(spark: SparkSession, d: str) -> DataFrame:
    return bpe.bpe_round_trip(read(spark, d, "documents"), tokenizer_path(), keep=("doc_id",))


def op8_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exactdedup.exact_groups(read(spark, d, "documents")).withColumnRenamed("id", "doc_id")


def op9_mixing(spark: SparkSession, d: str) -> DataFrame:
    made = mixing.mix_counts(read(spark, d, "documents"), weights=(1, 2, 3), epochs=3)
    return made.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_embedding_neardup(spark: SparkSession, d: str) -> DataFrame:
    groups = neardup.near_groups(read(spark, d, "embeddings"), threshold=0.9)
    return groups.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                         F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


def op11_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    pieces = conversation.repair(conversation.damage(read(spark, d, "conversations")))
    return conversation.digests(pieces).withColumnRenamed("conv", "conv_id")


def op12_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    vec, label = F.col("vec_id"), F.col("label")
    rows = read(spark, d, "embeddings").select(
        vec.alias("id"), F.when(vec % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        hardneg.quantised(F.col("embedding")).alias("code"), (vec % 100 == 0).alias("anchor"))
    return hardneg.mine(rows, positives=5, negatives=10, low=30, high=90, base=100)


def op13_nearest_neighbours(spark: SparkSession, d: str) -> DataFrame:
    vec = F.col("vec_id")
    rows = read(spark, d, "embeddings").select(vec.alias("id"), F.col("embedding").alias("vector"), (vec % 50 == 0).alias("query"))
    return ann.search(rows, k=5).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_lm_score, op3_toxicity, op4_html_text, op5_url_filter, op6_simhash, op7_bpe, op8_exact_dedup,
    op9_mixing, op10_embedding_neardup, op11_conversation_repair, op12_hard_negatives,
    op13_nearest_neighbours)}

ORACLES = {
    "op8_exact_dedup": r"""
        WITH rows AS (
          SELECT doc_id, length(coalesce(text, '')) AS points,
                 regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
        classes AS (
          SELECT norm, first(doc_id ORDER BY points DESC, doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM rows JOIN classes USING (norm)""",
    "op12_hard_negatives": """
        WITH rows AS (
          SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 [floor(256 * x::DOUBLE) FOR x IN embedding] AS code
          FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scores AS (
          SELECT a.id AS anchor_id, c.id, c.label = a.label AS same, list_dot_product(a.code, c.code)::BIGINT AS score
          FROM rows a JOIN rows c ON a.id <> c.id AND len(a.code) = len(c.code) WHERE a.id % 100 = 0),
        positives AS (
          SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        hard AS (
          SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
                 row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
          FROM positives JOIN scores USING (anchor_id)
          WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
        SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 10""",
    "op13_nearest_neighbours": """
        WITH rows AS (
          SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
            AND len([x FOR x IN embedding IF x <> 0]) > 0),
        scores AS (
          SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
          FROM rows q JOIN rows c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
        ranked AS (
          SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scores)
        SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
