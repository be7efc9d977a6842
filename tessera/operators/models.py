"""Model fitting and scoring with Spark ML.

Each ``fit_*`` returns a fitted ``PipelineModel`` that assembles the raw feature
columns itself (and scales them for regressions; trees do not depend on scale),
so it can be applied to any frame with those columns. Training sets are persisted for the iterative fit and released
afterwards (the reference caches and never unpersists).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from itertools import product

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import uniform
from tessera.operators import boosting
from tessera.operators.evaluate import auroc_by
from tessera.operators.features import assembler, fit_scaler
from tessera.operators.topk import top_k_by_norm
from tessera.session import scratch_path


@contextmanager
def _persisted(df: DataFrame):
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def _fit(train: DataFrame, prep: PipelineModel, estimator) -> PipelineModel:
    with _persisted(prep.transform(train)) as data:
        return PipelineModel(stages=[*prep.stages, estimator.fit(data)])


def _assembled(df: DataFrame, cols: Sequence[str], out: str = "assembled") -> PipelineModel:
    return Pipeline(stages=[assembler(cols, out)]).fit(df)


def fit_logistic(train: DataFrame, cols: Sequence[str], label: str = "label",
                 weight: str | None = None, fit_on: DataFrame | None = None, **params) -> PipelineModel:
    """Logistic regression (binomial or multinomial by label count);
    ``weight`` names an observation-weight column. The scaler is fitted on
    ``fit_on``, which should be the training rows before any resampling, so
    that copies do not weigh in its mean and deviation (default: ``train``)."""
    lr = LogisticRegression(featuresCol="scaled", labelCol=label, **params)
    if weight:
        lr.setWeightCol(weight)
    return _fit(train, fit_scaler(fit_on if fit_on is not None else train, cols, "scaled"), lr)


def fit_multiclass(train: DataFrame, cols: Sequence[str], label: str = "label",
                   weight: str = "weight", **params) -> PipelineModel:
    """Weighted multinomial logistic regression."""
    return fit_logistic(train, cols, label, weight, family="multinomial", **params)


def fit_forest(train: DataFrame, cols: Sequence[str], label: str = "label", seed: int = 0,
               **params) -> PipelineModel:
    """L2: random forest (20 trees, depth 5 by default), seeded."""
    forest = RandomForestClassifier(featuresCol="assembled", labelCol=label, seed=seed, **params)
    return _fit(train, _assembled(train, cols), forest)


def fit_gbt(train: DataFrame, cols: Sequence[str], label: str = "label", seed: int = 0,
            **params) -> PipelineModel:
    """L3: gradient-boosted trees, binary labels only, seeded."""
    gbt = GBTClassifier(featuresCol="assembled", labelCol=label, seed=seed, **params)
    return _fit(train, _assembled(train, cols), gbt)


# The reference's tuning grid.
GBT_GRID = {"maxDepth": [2, 4, 8], "maxBins": [24, 32, 48], "stepSize": [0.01, 0.1]}


def fold_of(id_cols: Sequence[str], folds: int, seed: int):
    """The fold of a row: equal for all copies of a key."""
    return (uniform(id_cols, f"fold{seed}") * folds).cast("int")


def tune_gbt(train: DataFrame, cols: Sequence[str], label: str = "label",
             id_cols: Sequence[str] = (), grid: dict | None = None, folds: int = 5,
             seed: int = 0, parallelism: int = 2, **params):
    """L4: grid search with k-fold cross-validation on AUROC.

    With ``id_cols`` the fold is a hash of the row key (``foldCol``), so all
    copies of an upsampled row share a fold and cannot leak across it; the
    reference cuts folds from upsampled rows. Returns the ``CrossValidatorModel``.
    """
    grid = grid or GBT_GRID
    gbt = GBTClassifier(featuresCol="assembled", labelCol=label, seed=seed, **params)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(gbt.getParam(name), list(values))
    cv = CrossValidator(estimator=gbt, estimatorParamMaps=builder.build(),
                        evaluator=BinaryClassificationEvaluator(labelCol=label),
                        numFolds=folds, seed=seed, parallelism=parallelism)
    prep = _assembled(train, cols)
    data = prep.transform(train).select("assembled", label, *id_cols)
    if id_cols:
        data = data.withColumn("_fold", fold_of(id_cols, folds, seed))
        cv.setFoldCol("_fold")
    with _persisted(data):
        cv_model = cv.fit(data)
    return PipelineModel(stages=[*prep.stages, cv_model.bestModel]), cv_model


def settings_of(grid: dict) -> list[dict]:
    """Every setting of a grid, the last parameter varying fastest."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


# Tasks per core that fits offer at once: theirs are short and mostly wait for the scheduler and for shuffles.
TASKS_A_CORE = 2


def _side_by_side(data: DataFrame, least: int) -> int:
    """How many fits of ``data`` MLlib works on at once: each of its steps is a
    job of one task per partition, so few partitions leave most cores idle unless
    as many more fits share them; never fewer than ``least``."""
    cores = data.sparkSession.sparkContext.defaultParallelism
    return max(least, TASKS_A_CORE * cores // max(1, data.rdd.getNumPartitions()))


def validation_scores(train: DataFrame, cols: Sequence[str], label: str, id_cols: Sequence[str], grid: dict,
                      folds: int = 5, seed: int = 0, parallelism: int = 2, **params) -> DataFrame:
    """L4: ``(setting, fold, label, score)`` of every row of every fold, scored by
    the trees of each setting fitted on the other folds. Folds are cut by the
    hash of the row key, so copies of a row share one. The trees are those of
    ``GBTClassifier``, grown by ``boosting.forests`` for all fits at once, those
    with most work first; of parameters that it does not know, by MLlib fit by
    fit, at least ``parallelism`` of them side by side (``_side_by_side``). The
    scores are written below the checkpoint folder.
    """
    spark, prep, settings = train.sparkSession, _assembled(train, cols), settings_of(grid)
    data = prep.transform(train).select("assembled", label, fold_of(id_cols, folds, seed).alias("_fold"))
    path = scratch_path(spark, "validation-scores")

    def rest(fold: int) -> DataFrame:
        return data.where(F.col("_fold") != fold)

    def run(fit: tuple) -> None:
        setting, fold, gbt = fit
        scored = gbt.fit(rest(fold)).transform(data.where(F.col("_fold") == fold))
        margin = vector_to_array("rawPrediction").getItem(1)
        scored.select(F.lit(setting).alias("setting"), F.lit(fold).alias("fold"), F.col(label).alias("label"), margin.alias("score")) \
            .write.parquet(f"{path}/part={setting}-{fold}")

    deepest = sorted(range(len(settings)), key=lambda s: -(params | settings[s]).get("maxDepth", 0))
    fits = [(setting, fold, GBTClassifier(featuresCol="assembled", labelCol=label, seed=seed, **(params | settings[setting])))
            for setting, fold in product(deepest, range(folds))]
    with _persisted(data), ThreadPoolExecutor(_side_by_side(data, parallelism)) as pool:
        side_by_side = lambda f, *over: list(pool.map(inheritable_thread_target(spark)(f), *over))
        if all(boosting.supported(gbt, data) for _, _, gbt in fits):
            of = {(fold, gbt.getMaxBins()): gbt for _, fold, gbt in fits}
            points = dict(zip(of, side_by_side(lambda key: boosting.cuts(of[key], rest(key[0])), of)))
            grown = [boosting.Fit(setting, fold, (fold, gbt.getMaxBins()), boosting.boosting_of(gbt)) for setting, fold, gbt in fits]
            trees = boosting.forests(data, "assembled", label, "_fold", grown, points)
            boosting.scores(data, "assembled", label, "_fold", grown, points, trees).write.parquet(f"{path}/all")
        else:
            side_by_side(run, fits)
    return spark.read.parquet(f"{path}/*")


def tuning_metrics(scores: DataFrame) -> DataFrame:
    """L4: ``(setting, fold, auroc)``, exact, from one pass over all scores."""
    return auroc_by(scores, ["setting", "fold"]).select("setting", "fold", "auroc")


def best_setting(metrics: DataFrame) -> int:
    """The setting with the largest mean AUROC over its folds, the first of equals."""
    means = metrics.groupBy("setting").agg(F.avg("auroc").alias("mean"))
    return means.orderBy(F.col("mean").desc_nulls_last(), "setting").first()["setting"]


def cross_validate(train: DataFrame, cols: Sequence[str], label: str = "label", id_cols: Sequence[str] = (),
                   grid: dict | None = None, folds: int = 5, seed: int = 0, parallelism: int = 2,
                   **params) -> tuple[PipelineModel, DataFrame]:
    """L4: the model of the best setting, fitted on all rows, and the metrics of
    every setting and fold."""
    grid = grid or GBT_GRID
    metrics = tuning_metrics(validation_scores(train, cols, label, id_cols, grid, folds, seed, parallelism, **params)).checkpoint()
    best = settings_of(grid)[best_setting(metrics)]
    return fit_gbt(train, cols, label, seed, **(params | best)), metrics


def fit_als(train: DataFrame, user: str, item: str, rating: str, seed: int = 0,
            max_iter: int = 5, reg: float = 0.01, rank: int = 10, alpha: float = 1.0,
            implicit: bool = True, cold_start: str = "nan") -> ALSModel:
    """Implicit-feedback matrix factorisation. ``user``/``item`` must be
    integer-valued ids in int range (e.g. ``features.string_index`` output)."""
    als = ALS(maxIter=max_iter, regParam=reg, rank=rank, alpha=alpha, userCol=user, itemCol=item,
              ratingCol=rating, implicitPrefs=implicit, seed=seed, coldStartStrategy=cold_start)
    with _persisted(train):
        return als.fit(train)


def score_pairs(model: ALSModel, pairs: DataFrame, cold: str = "nan") -> DataFrame:
    """R2: predicted preference for known pairs; ``cold='drop'`` removes pairs
    whose user or item was not in training (NaN otherwise)."""
    return model.copy().setColdStartStrategy(cold).transform(pairs)


def recommend_top_k(model: ALSModel, k: int, out: str = "items", users: DataFrame | None = None) -> DataFrame:
    """The ``k`` best items per training user as an id list (score desc,
    ties by item id); with ``users`` only for the users in that frame.

    Exact: items are visited by falling norm and a user stops where no later
    item can enter its list (``topk.top_k_by_norm``); no pair list is ever
    materialised and no join pairs users with items.
    """
    col = model.getUserCol()
    factors = model.userFactors
    if users is not None:
        factors = factors.join(users.select(F.col(col).cast("int").alias("id")).distinct(), "id", "left_semi")
    return top_k_by_norm(factors, model.itemFactors, k).select(F.col("id").alias(col), F.col("items").alias(out))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Apply a fitted pipeline and keep a plain ``probability`` array too."""
    scored = model.transform(df)
    if "probability" in scored.columns:
        scored = scored.withColumn("p1", vector_to_array(F.col("probability")).getItem(1))
    return scored
