"""Trees grown for many fits at once equal those of ``GBTClassifier``."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import boosting, models

GRID = {"maxDepth": [1, 4], "maxBins": [8, 20], "stepSize": [0.05, 0.5]}


def _noisy(spark, n=900, parts=1):
    return spark.range(0, n, 1, parts).select(
        F.col("id").cast("string").alias("id"), F.rand(1).alias("x"), F.round(F.rand(2) * 9).alias("y"), F.lit(1.0).alias("z"),
        (F.rand(1) + F.rand(3) * 0.8 > 0.9).cast("int").alias("label"))


def _by_mllib(df, cols, setting, fold, folds=3, **params):
    data = models._assembled(df, cols).transform(df).withColumn("f", models.fold_of(["id"], folds, 5))
    gbt = GBTClassifier(featuresCol="assembled", labelCol="label", seed=5, **(params | models.settings_of(GRID)[setting]))
    scored = gbt.fit(data.where(F.col("f") != fold)).transform(data.where(F.col("f") == fold))
    return sorted(tuple(r) for r in scored.select("label", vector_to_array("rawPrediction").getItem(1)).collect())


def _scores(df, cols, **params):
    rows = models.validation_scores(df, cols, "label", ["id"], GRID, 3, 5, 2, **params).collect()
    out = {}
    for r in rows:
        out.setdefault((r["setting"], r["fold"]), []).append((r["label"], r["score"]))
    return {k: sorted(v) for k, v in out.items()}


def _close(a, b):
    return len(a) == len(b) and all(x[0] == y[0] and abs(x[1] - y[1]) < 1e-9 for x, y in zip(a, b))


@pytest.mark.parametrize("block_bytes", [boosting.BLOCK_BYTES, 0])
def test_scores_equal_mllib_in_one_block_and_by_levels(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(boosting, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    df = _noisy(spark, parts=3 if block_bytes else 1).checkpoint()
    found = _scores(df, ["x", "z", "y"], maxIter=4)
    assert len(found) == 24 and sum(map(len, found.values())) == 8 * 900
    for setting, fold in ((0, 0), (4, 2), (7, 1)):
        assert _close(found[setting, fold], _by_mllib(df, ["x", "z", "y"], setting, fold, maxIter=4))


def test_jobs_do_not_grow_with_the_trees(spark):
    df = _noisy(spark, 200).checkpoint()
    tracker, counts = spark.sparkContext.statusTracker(), []
    for trees in (2, 6):
        spark.sparkContext.setJobGroup(f"grid-{trees}", "")
        try:
            models.validation_scores(df, ["x", "y"], "label", ["id"], GRID, 2, 5, 2, maxIter=trees)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        counts.append(len(tracker.getJobIdsForGroup(f"grid-{trees}")))
    assert counts[0] == counts[1] > 0


@pytest.mark.parametrize("margin_bytes, groups", [(boosting.MARGIN_BYTES, 1), (1, 3)])
def test_a_larger_table_takes_one_job_a_level_for_all_its_fits(spark, monkeypatch, margin_bytes, groups):
    monkeypatch.setattr(boosting, "BLOCK_BYTES", 0)
    monkeypatch.setattr(boosting, "MARGIN_BYTES", margin_bytes)
    jobs, sums = [], boosting._level_sums
    monkeypatch.setattr(boosting, "_level_sums", lambda trees, *a: jobs.append(len(trees)) or sums(trees, *a))
    df = _noisy(spark, 300).checkpoint()
    found = _scores(df, ["x", "y"], maxIter=2)
    assert len(found) == 24 and jobs[0] == 24 // groups and len(jobs) <= groups * 2 * 4


def test_sums_do_not_depend_on_the_run_or_on_where_they_are_added(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_BYTES", 0)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    df = _noisy(spark, 700, 3).checkpoint()
    here = _scores(df, ["x", "y"], maxIter=2)
    assert _scores(df, ["x", "y"], maxIter=2) == here
    monkeypatch.setattr(boosting, "SUM_BYTES", 0)
    monkeypatch.setattr(boosting, "MERGED_BYTES", 1000)
    assert _scores(df, ["x", "y"], maxIter=2) == here


def test_other_parameters_are_left_to_mllib(spark):
    df = _noisy(spark, 200)
    data = models._assembled(df, ["x", "y"]).transform(df)
    known = lambda **p: boosting.supported(GBTClassifier(featuresCol="assembled", labelCol="label", **p), data)
    assert known() and known(minInstancesPerNode=4, minInfoGain=0.01)
    assert not known(subsamplingRate=0.5) and not known(featureSubsetStrategy="sqrt") and not known(weightCol="y") and not known(maxBins=400)
    found = models.validation_scores(df, ["x", "y"], "label", ["id"], {"maxDepth": [2]}, 2, 5, 2, maxIter=2, subsamplingRate=0.5)
    assert found.count() == 200


def test_limits_on_splits_hold(spark):
    df = _noisy(spark, 400).checkpoint()
    params = {"maxIter": 2, "minInstancesPerNode": 30, "minInfoGain": 0.01}
    found = _scores(df, ["y", "x"], **params)
    assert _close(found[7, 1], _by_mllib(df, ["y", "x"], 7, 1, **params))


@pytest.mark.parametrize("block_bytes", [boosting.BLOCK_BYTES, 0])
def test_constant_columns_and_one_class_give_a_root_alone(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(boosting, "BLOCK_BYTES", block_bytes)
    df = _noisy(spark, 120).withColumn("label", F.lit(1)).checkpoint()
    for cols in (["z"], ["x", "y"]):
        found = _scores(df, cols, maxIter=2)
        assert _close(found[7, 0], _by_mllib(df, cols, 7, 0, maxIter=2))
    df = _noisy(spark, 120).checkpoint()
    assert _close(_scores(df, ["z"], maxIter=2)[7, 0], _by_mllib(df, ["z"], 7, 0, maxIter=2))


def test_labels_other_than_0_and_1_fail_as_in_mllib(spark):
    df = _noisy(spark, 60).withColumn("label", F.lit(2))
    with pytest.raises(Exception, match="(?i)label"):
        models.validation_scores(df, ["x", "y"], "label", ["id"], {"maxDepth": [1]}, 2, 5, 2, maxIter=1)


def test_a_value_equal_to_a_cut_lies_below_it():
    at = [np.array([1.0, 2.0])]
    assert boosting.binned(np.array([[0.5], [1.0], [1.5], [2.0], [9.0]]), at).tolist() == [[0, 0, 1, 1, 2]]
