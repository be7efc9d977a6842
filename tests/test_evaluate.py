"""Reports against MLlib evaluators and hand-computed edge cases."""

import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.mllib.evaluation import RankingMetrics
from pyspark.sql import functions as F

from tessera.operators import evaluate


def test_binary_report_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    r = evaluate.binary_report(df).first()
    assert (r["total"], r["positive"], r["negative"], r["tp"], r["fn"], r["tn"]) == (3, 1, 2, 0, 1, 2)
    assert r["precision"] is None and r["recall"] == 0.0
    assert math.isclose(r["accuracy"], 2 / 3)


def test_threshold_sweep_strict(spark):
    df = spark.createDataFrame([(1, 0.3), (0, 0.3), (1, 0.5)], "label int, p double")
    rows = {r["threshold"]: r for r in evaluate.threshold_sweep(df, "p", [0.3, 0.2]).collect()}
    assert rows[0.3]["n_pred_pos"] == 1 and rows[0.2]["n_pred_pos"] == 3


def test_auroc_exact_equals_mllib_with_ties(spark):
    data = [(1, 0.9), (0, 0.9), (1, 0.7), (0, 0.5), (0, 0.5), (1, 0.5), (0, 0.1), (1, 0.95), (0, 0.2)]
    df = spark.createDataFrame(data, "label int, score double")
    ours = evaluate.auroc(df, "label", "score", partitions=3).first()["auroc"]
    schema = StructType([StructField("label", DoubleType()), StructField("raw", VectorUDT())])
    vec = spark.createDataFrame([(float(y), Vectors.dense([1 - s, s])) for y, s in data], schema)
    ref = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0).evaluate(vec)
    assert math.isclose(ours, ref, rel_tol=1e-12)


def test_per_class_report_missing_classes(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 1.0), (1.0, 3.0)],
                               "label double, prediction double")
    rep = {r["class"]: r for r in evaluate.per_class_report(df).collect()}
    assert rep[2.0]["precision"] == 0.0 and rep[2.0]["recall"] == 0.0   # true, never predicted
    assert rep[3.0]["recall"] is None and rep[3.0]["precision"] == 0.0  # predicted, never true
    assert math.isclose(rep[1.0]["precision"], 1 / 3) and math.isclose(rep[1.0]["recall"], 0.5)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_ranking_report_equals_mllib(spark, k):
    pred = [(1, [1, 2, 3, 4, 5]), (2, [9, 8]), (3, [7, 6, 5, 4, 3]), (4, []), (5, [1])]
    truth = {1: [2, 5, 11, 12], 2: [8], 3: list(range(20, 40)), 4: [1], 6: [1]}
    pdf = spark.createDataFrame(pred, "u int, items array<int>")
    tdf = spark.createDataFrame([(u, i) for u, items in truth.items() for i in items], "u int, i int")
    ours = evaluate.ranking_report(pdf, tdf, "u", "i", "items", k).first()
    pairs = [(p, truth[u]) for u, p in pred if u in truth]
    rm = RankingMetrics(spark.sparkContext.parallelize(pairs))
    assert ours["users"] == 4
    assert math.isclose(ours["precision_at_k"], rm.precisionAt(k), abs_tol=1e-12)
    assert math.isclose(ours["ndcg_at_k"], rm.ndcgAt(k), abs_tol=1e-12)
    assert math.isclose(ours["mean_average_precision"], rm.meanAveragePrecision, abs_tol=1e-12)


def test_apply_threshold_on_vector(spark):
    from tessera.functions.columns import positive_probability
    df = spark.createDataFrame([(Vectors.dense([0.4, 0.6]),), (Vectors.dense([0.8, 0.2]),)],
                               StructType([StructField("p", VectorUDT())]))
    out = evaluate.apply_threshold(df, positive_probability("p"), 0.5).collect()
    assert [r["custom_prediction"] for r in out] == [1, 0]


def test_auroc_reports_what_it_leaves_out(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (None, 0.5), (2, 0.7), (0, 0.2)], "label int, score double")
    row = evaluate.auroc(df).first()
    assert (row["auroc"], row["positive"], row["negative"], row["left_out"]) == (1.0, 1, 2, 3)
    none = evaluate.auroc(df.where("label = 1")).first()
    assert none["auroc"] is None and none["negative"] == 0


def test_auroc_of_counts_above_a_bigint_product(spark):
    n = 4_000_000_000
    hist = spark.createDataFrame([(0.1, 0, n), (0.5, n, n), (0.9, n, 0)], "_s double, _pos bigint, _neg bigint")
    row = evaluate.auroc_of_counts(hist).first()
    assert math.isclose(row["auroc"], 0.875) and row["positive"] == 2 * n


def test_sweep_equals_single_reports(spark):
    df = spark.createDataFrame([(k % 2, (k * 37 % 100) / 100.0) for k in range(80)] + [(1, None)], "label int, p double")
    for r in evaluate.threshold_sweep(df, "p", [0.2, 0.5, 1.0]).collect():
        one = evaluate.binary_report(evaluate.apply_threshold(df, "p", r["threshold"], "prediction")).first()
        assert tuple(r)[1:] == tuple(one)


def test_auroc_by_group_equals_each_group_alone(spark):
    df = spark.range(600).select(
        (F.col("id") % 5).cast("int").alias("g"), F.when(F.col("id") % 7 == 0, None).otherwise("h").alias("h"),
        (F.col("id") * 37 % 11 / 10).alias("s"), (F.col("id") * 13 % 3 == 0).cast("int").alias("y"))
    df = df.unionByName(spark.createDataFrame([(9, "h", 0.5, 1), (9, "h", 0.7, 1), (8, "h", None, 0)], "g int, h string, s double, y int"))
    got = {(r["g"], r["h"]): r["auroc"] for r in evaluate.auroc_by(df, ["g", "h"], "y", "s", 3).collect()}
    assert got[9, "h"] is None and (8, "h") not in got and len(got) == 11
    for (g, h), area in got.items():
        own = df.where(F.col("g").eqNullSafe(F.lit(g)) & F.col("h").eqNullSafe(F.lit(h)))
        want = evaluate.auroc(own, "y", "s").first()["auroc"]
        assert want == area or abs(area - want) < 1e-12
