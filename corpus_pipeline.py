"""A training-data pipeline over ``documents``: drop toxic texts, exact copies
and near copies, mix the sources, and encode the mix.

Each stage takes what its predecessor kept, written as Parquet and read again.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, exactdedup, mixing, simhash, toxicity
from tessera.llm.common import read
from tessera.llm.queries import TOXIC_FROM, fit_toxicity, tokenizer_path
from tessera.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold. The model learns from the
    labelled documents among ``docs``; null and empty texts stay unless the
    score of an empty text itself reaches the threshold. Repeated rows share
    their fate; other columns keep their names and values; no rows give none."""
    model = fit_toxicity(docs, read(spark, sf_dir, "labels"))
    out = "__score" + "_" * max(map(len, docs.columns))  # longer than any column's name
    scored = toxicity.score(docs, model, keep=tuple(docs.columns), score_out=out)
    return scored.where(scored[out] < TOXIC_FROM).drop(out)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of equal texts (white space aside): the longest,
    then the smallest id; null and empty texts are one class; of rows that
    repeat both, one stays. No rows give none."""
    return exactdedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, decided by row, not by id alone;
    rows with a null id stay. No rows give none."""
    return simhash.simhash_dedup(docs, words=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to three rows; a text
    without words is not taken. Null sources are a source, ids need not differ.
    No rows give none."""
    return mixing.mix(docs, weights=(1, 2, 3), epochs=3)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix, repeats included."""
    return bpe.bpe_round_trip(docs, tokenizer_path(), keep=("doc_id",))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("simhash_dedup", drop_near_copies),
          ("mixing", mix_sources), ("bpe", encode)]

#: Scores, fingerprints and tokens are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
