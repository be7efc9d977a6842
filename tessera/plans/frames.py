"""Shared intermediate frames of the catalog, composed from the operators.

These follow the reference's three flows on the fixture analogues:
clean -> profile -> reduce -> split -> repair (recommendation), and
features -> labels -> split -> resample (classification).

Frames that later steps read several times are pinned with a reliable
checkpoint (``pin``): the clean facts feed the reduction three times (facts,
two profiles), each profile its median and the reduction, the split feeds four branches of the
repair, and the repaired split feeds train, test and list branches.
Recomputing a join-and-aggregate chain per consumer costs far more at scale
than writing its result once to the shared checkpoint folder. Nothing is
pinned across queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import hash_key, uniform
from tessera.operators import match, sample, shape, summary
from tessera.operators.features import string_index
from tessera.plans import params as P
from tessera.session import checkpoint_dir
from tessera.sources import fixtures as fx


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once under ``spark.checkpoint.dir`` and cut its
    lineage (survives executor loss, unlike a local checkpoint or cache)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


MISMATCH_FIELDS = {"song_id": (9, 18), "track_id": (27, 19)}


def line_ids(spark: SparkSession, d: str) -> DataFrame:
    """The ids on every line, errors or not."""
    return shape.extract_fixed(fx.mismatch_lines(spark, d), "value", MISMATCH_FIELDS)


def mismatches(spark: SparkSession, d: str) -> DataFrame:
    """The exclusion list: the ids on the error lines."""
    lines = shape.keep_prefix(fx.mismatch_lines(spark, d), "value", "ERROR: ")
    return shape.extract_fixed(lines, "value", MISMATCH_FIELDS)


def accepted(spark: SparkSession, d: str) -> DataFrame:
    lines = shape.keep_prefix(fx.accepted_lines(spark, d), "value", "< ERROR: ")
    return shape.extract_fixed(lines, "value", {"song_id": (11, 18), "track_id": (29, 19)})


def effective(spark: SparkSession, d: str) -> DataFrame:
    return match.effective_exclusions(mismatches(spark, d), accepted(spark, d), "track_id")


def clean_triplets(spark: SparkSession, d: str) -> DataFrame:
    return match.exclude(fx.triplets(spark, d), effective(spark, d), "song_id")


def user_activity(spark: SparkSession, d: str) -> DataFrame:
    return summary.profile_by(clean_triplets(spark, d), "user_id", "play_count", "play_count",
                              ("n_songs", "total_plays"))


def item_popularity(spark: SparkSession, d: str) -> DataFrame:
    return summary.profile_by(clean_triplets(spark, d), "song_id", "user_id", "play_count",
                              ("n_users", "total_plays"))


def reduced(spark: SparkSession, d: str, facts: DataFrame | None = None, keep_stats: bool = False) -> DataFrame:
    """Facts of popular items and active users, thresholds = exact medians.
    Each profile is built once, for its median and for the reduction."""
    facts = facts if facts is not None else pin(clean_triplets(spark, d))
    users = pin(match.user_profile(facts, "user_id", "play_count"))
    items = pin(match.item_profile(facts, "user_id", "song_id", "play_count"))
    min_items = summary.quantile_value(users, "user_items", 0.5)
    min_total = summary.quantile_value(items, "item_total", 0.5)
    return match.reduce_facts(facts, "user_id", "song_id", "play_count", min_items, min_total,
                              keep_stats=keep_stats, users=users, items=items)


def splitted(spark: SparkSession, d: str) -> DataFrame:
    return sample.random_split(reduced(spark, d), ["user_id", "song_id"],
                               [P.TRAIN_FRAC, 1 - P.TRAIN_FRAC], P.SPLIT_SEED)


def cold_split(spark: SparkSession, d: str) -> DataFrame:
    """Row-level split, then every row of a ``COLD_USER_FRAC`` share of users
    (by a per-user draw) moved to test: cold users the repair must cover."""
    cold = uniform(["user_id"], P.COLD_SEED) < F.lit(P.COLD_USER_FRAC)
    return splitted(spark, d).withColumn("split", F.when(cold, "test").otherwise(F.col("split")))


def repaired(spark: SparkSession, d: str, cold: DataFrame | None = None) -> DataFrame:
    cold = cold if cold is not None else pin(cold_split(spark, d))
    return sample.repair_coverage(cold, "user_id", "song_id", "split", P.REPAIR_FRAC, P.REPAIR_SEED)


def repaired_pinned(spark: SparkSession, d: str) -> DataFrame:
    """The repaired split, materialised for queries that read it repeatedly."""
    return pin(repaired(spark, d))


def features(spark: SparkSession, d: str) -> DataFrame:
    return shape.strip_quotes(fx.track_features(spark, d), "track_id")


def genre_ok(spark: SparkSession, d: str) -> DataFrame:
    return match.exclude(fx.genre_labels(spark, d), effective(spark, d), "track_id")


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return match.attach_label(features(spark, d), genre_ok(spark, d), "track_id")


def binary_labelled(spark: SparkSession, d: str) -> DataFrame:
    return shape.binary_label(labelled(spark, d), "genre", P.GENRE_POSITIVE)


def stratified(spark: SparkSession, d: str) -> DataFrame:
    """Binary-labelled tracks with an exact 80/20 split per label. The input
    is pinned: the bucketed row number reads it for sizes, rows and counts."""
    return sample.stratified_split(pin(binary_labelled(spark, d)), "label", ["track_id"],
                                   P.STRAT_FRAC, P.STRAT_SEED)


def multiclass(spark: SparkSession, d: str) -> DataFrame:
    """Genre index as the label; the labelled tracks are pinned because the
    index reads them twice (value counts, join back)."""
    return string_index(pin(labelled(spark, d)), "genre", "label")


def _level(col: str, seed) -> F.Column:
    return F.conv(F.substring(hash_key([col], seed), 1, 2), 16, 10).cast("bigint")


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Fixed, mildly informative scores with ties (no model involved)."""
    lv = _level("track_id", P.SCORE_SEED)
    return binary_labelled(spark, d).select(
        "track_id", "label", ((lv.cast("double") + F.col("label") * 64) / F.lit(319.0)).alias("score"))


def multi_scored(spark: SparkSession, d: str) -> DataFrame:
    lv = _level("track_id", P.SCORE_SEED)
    pred = F.when(lv < 150, F.col("label")).otherwise((lv % 25).cast("double"))
    return multiclass(spark, d).select("track_id", "label", pred.alias("prediction"))
