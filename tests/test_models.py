"""Trained models: shape, determinism, better than chance on separable data."""

import random

from pyspark.sql import functions as F

from tessera.operators import evaluate, models


def _separable(spark, n=400):
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        (F.col("id") % 2).cast("int").alias("label"),
        ((F.col("id") % 2) * 2.0 + F.rand(1) * 0.5).alias("x"),
        (F.rand(2)).alias("y"))


def test_logistic_separates(spark):
    df = _separable(spark)
    scored = models.predict(models.fit_logistic(df, ["x", "y"], "label"), df)
    auc = evaluate.auroc(scored, "label", "p1").first()["auroc"]
    assert auc > 0.95


def test_forest_and_gbt_are_seeded(spark):
    df = _separable(spark, 200)
    a = models.predict(models.fit_gbt(df, ["x", "y"], "label", seed=3, maxIter=5), df)
    b = models.predict(models.fit_gbt(df, ["x", "y"], "label", seed=3, maxIter=5), df)
    assert sorted(a.select("id", "p1").collect()) == sorted(b.select("id", "p1").collect())
    rf = models.predict(models.fit_forest(df, ["x", "y"], "label", seed=3, numTrees=5), df)
    assert rf.count() == 200


def test_als_recommendations_shape(spark):
    rows = [(u, i, (u * i) % 5 + 1) for u in range(20) for i in range(15) if (u + i) % 3]
    df = spark.createDataFrame(rows, "user int, item int, plays int")
    model = models.fit_als(df, "user", "item", "plays", seed=1, max_iter=3, rank=4)
    recs = models.recommend_top_k(model, 5).collect()
    assert len(recs) == 20 and all(len(r["items"]) == 5 for r in recs)
    scored = models.score_pairs(model, df, cold="drop")
    assert scored.count() == len(rows)


def test_scaler_is_fitted_on_the_rows_before_resampling(spark):
    df = _separable(spark, 200)
    up = df.unionAll(df.where("label = 1")).unionAll(df.where("label = 1"))
    model = models.fit_logistic(up, ["x", "y"], "label", fit_on=df)
    mean = df.agg(F.avg("x")).first()[0]
    assert abs(model.stages[1].mean[0] - mean) < 1e-9
    assert abs(models.fit_logistic(up, ["x", "y"], "label").stages[1].mean[0] - mean) > 0.1


def test_copies_never_cross_folds(spark):
    df = spark.range(300).select((F.col("id") % 60).cast("string").alias("id"))
    folds = df.withColumn("f", models.fold_of(["id"], 5, 7))
    assert folds.groupBy("id").agg(F.countDistinct("f").alias("n")).where("n > 1").count() == 0
    assert {r["f"] for r in folds.select("f").distinct().collect()} == {0, 1, 2, 3, 4}


def test_tuning_tries_every_setting_and_keeps_the_best(spark):
    df = _separable(spark, 120)
    grid = {"maxDepth": [1, 2], "stepSize": [0.01, 0.5]}
    best, cv = models.tune_gbt(df, ["x", "y"], "label", ["id"], grid=grid, folds=2, seed=3, parallelism=2, maxIter=2)
    assert len(cv.avgMetrics) == 4 and models.predict(best, df).count() == 120
    assert [len(v) for v in models.GBT_GRID.values()] == [3, 3, 2]


def test_equals_a_plain_pipeline_of_the_same_seed(spark):
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    df = _separable(spark, 150).cache()
    raw = VectorAssembler(inputCols=["x", "y"], outputCol="assembled").transform(df)
    plain = GBTClassifier(featuresCol="assembled", labelCol="label", seed=5, maxIter=4).fit(raw).transform(raw)
    ours = models.predict(models.fit_gbt(df, ["x", "y"], "label", seed=5, maxIter=4), df)
    assert sorted(r["id"] + str(r["prediction"]) for r in plain.collect()) == sorted(r["id"] + str(r["prediction"]) for r in ours.collect())
    scaled = StandardScaler(inputCol="assembled", outputCol="s", withMean=True, withStd=True).fit(raw).transform(raw)
    lr = LogisticRegression(featuresCol="s", labelCol="label").fit(scaled)
    assert abs(lr.intercept - models.fit_logistic(df, ["x", "y"], "label").stages[-1].intercept) < 1e-6


def test_score_pairs_leaves_the_model_as_it_is(spark):
    rows = [(u, i, 1) for u in range(6) for i in range(6) if u != i]
    df = spark.createDataFrame(rows, "user int, item int, plays int")
    model = models.fit_als(df, "user", "item", "plays", seed=1, max_iter=2, rank=2)
    cold = spark.createDataFrame([(0, 1, 1), (99, 1, 1)], df.schema)
    assert models.score_pairs(model, cold, cold="drop").count() == 1
    assert model.getColdStartStrategy() == "nan" and models.score_pairs(model, cold).count() == 2
    some = models.recommend_top_k(model, 3, users=cold.select("user")).collect()
    assert [r["user"] for r in some] == [0] and len(set(some[0]["items"])) == 3


def test_fold_metrics_equal_the_evaluator_and_the_best_mean_wins(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = _separable(spark, 160).withColumn("x", F.col("x") + F.rand(9) * 2).cache()
    grid = {"maxDepth": [1, 3], "stepSize": [0.05, 0.5]}
    best, metrics = models.cross_validate(df, ["x", "y"], "label", ["id"], grid, folds=3, seed=3, parallelism=4, maxIter=3)
    rows = {(r["setting"], r["fold"]): r["auroc"] for r in metrics.collect()}
    assert len(rows) == 12
    data = models._assembled(df, ["x", "y"]).transform(df).withColumn("f", models.fold_of(["id"], 3, 3))
    judge = BinaryClassificationEvaluator(labelCol="label", numBins=0)
    for setting, fold in ((0, 0), (3, 2)):
        gbt = GBTClassifier(featuresCol="assembled", labelCol="label", seed=3, maxIter=3, **models.settings_of(grid)[setting])
        scored = gbt.fit(data.where(F.col("f") != fold)).transform(data.where(F.col("f") == fold))
        assert abs(judge.evaluate(scored) - rows[setting, fold]) < 1e-9
    means = {s: sum(rows[s, f] for f in range(3)) / 3 for s in range(4)}
    assert models.best_setting(metrics) == max(means, key=lambda s: (means[s], -s))
    assert best.stages[-1].getOrDefault("maxDepth") == models.settings_of(grid)[models.best_setting(metrics)]["maxDepth"]


def test_small_fits_share_the_cores_deepest_first(spark, monkeypatch):
    pools, depths = [], []
    pool, gbt = models.ThreadPoolExecutor, models.GBTClassifier
    monkeypatch.setattr(models, "ThreadPoolExecutor", lambda n: pools.append(n) or pool(1))
    monkeypatch.setattr(models, "GBTClassifier", lambda **k: depths.append(k["maxDepth"]) or gbt(**k))
    df, cores = _separable(spark, 60).coalesce(1), spark.sparkContext.defaultParallelism
    scores = models.validation_scores(df, ["x", "y"], "label", ["id"], {"maxDepth": [1, 2]}, folds=2, seed=3, parallelism=2, maxIter=1)
    assert pools == [models.TASKS_A_CORE * cores] and depths == [2, 2, 1, 1]
    assert {(r["setting"], r["n"]) for r in scores.groupBy("setting").agg(F.count("*").alias("n")).collect()} == {(0, 60), (1, 60)}
    assert models._side_by_side(df.repartition(20 * cores), 3) == 3


def test_nothing_stays_persisted(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = _separable(spark, 80)
    models.fit_logistic(df, ["x", "y"], "label")
    models.fit_gbt(df, ["x", "y"], "label", seed=3, maxIter=2)
    models.cross_validate(df, ["x", "y"], "label", ["id"], {"maxDepth": [1]}, folds=2, seed=3, maxIter=1)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_top_k_equals_recommend_for_all_users(spark):
    rng = random.Random(4)  # no two items alike: the other form leaves ties open
    rows = [(u, i, rng.randint(1, 9)) for u in range(30) for i in range(60) if rng.random() < 0.6]
    model = models.fit_als(spark.createDataFrame(rows, "user int, item int, plays int"), "user", "item", "plays", seed=1, max_iter=3, rank=4)
    ours = {r["user"]: r["items"] for r in models.recommend_top_k(model, 5).collect()}
    theirs = {r["user"]: [x["item"] for x in r["recommendations"]] for r in model.recommendForAllUsers(5).collect()}
    assert ours == theirs
    some = models.recommend_top_k(model, 5, users=spark.createDataFrame([(3,), (3,), (99,)], "user int")).collect()
    assert {r["user"]: r["items"] for r in some} == {3: ours[3]}
    plan = models.recommend_top_k(model, 5)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_checks_fail_for_a_model_of_other_labels(spark):
    from tessera.plans import mlqueries as ml

    df = _separable(spark, 300).withColumn("x", F.col("x") + F.rand(9) * 6).checkpoint()
    wrong = df.withColumn("label", (F.xxhash64("id") % 2 == 0).cast("int")).checkpoint()
    for linear, model in ((True, models.fit_logistic(df, ["x", "y"], "label")), (False, models.fit_gbt(df, ["x", "y"], "label", seed=3, maxIter=5))):
        assert ml.learned(ml.fit_report(model, df, ["x", "y"], linear), linear)
        assert not ml.learned(ml.fit_report(model, wrong, ["x", "y"], linear), linear)
    multi = df.select("x", "y", (F.col("id").cast("int") % 3).cast("double").alias("label"), F.lit(1.0).alias("w")).withColumn(
        "weight", F.when(F.col("label") == 0, 5.0).otherwise(1.0)).checkpoint()
    model = models.fit_multiclass(multi, ["x", "y"], "label", "weight")
    assert ml.multiclass_residual(model, multi) < 1e-3 < 0.05 < ml.multiclass_residual(model, multi, weight="w")  # the weights matter
    rows = [(float(u), float(i), 3) for u in range(40) for i in range(30) if u % 3 == i % 3]
    pairs = spark.createDataFrame(rows, "user_index double, song_index double, plays int")
    als = models.fit_als(pairs, "user_index", "song_index", "plays", seed=1, max_iter=5, rank=4)
    moved = pairs.withColumn("song_index", (F.col("song_index") + 10) % 30)
    assert ml.prefers_trained(als, pairs) and not ml.prefers_trained(als, moved)
