"""Quality reports (E1–E5), each one aggregate job instead of a driver loop.

The reference issues 9 count jobs per binary report and 42 evaluator jobs per
multiclass report; here every report is a single grouped aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import safe_ratio
from tessera.operators.rank import running_total


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


#: Columns of a binary report, in order.
REPORT = ("total", "positive", "negative", "n_pred_pos", "n_pred_neg", "tp", "fp", "fn", "tn",
          "precision", "recall", "accuracy")


def _confusion(label: Column, pred: Column) -> list[Column]:
    tp = _count_if((pred == 1) & (label == 1))
    fp = _count_if((pred == 1) & (label == 0))
    fn = _count_if((pred == 0) & (label == 1))
    tn = _count_if((pred == 0) & (label == 0))
    return [
        F.count(F.lit(1)).alias("total"),
        _count_if(label == 1).alias("positive"),
        _count_if(label == 0).alias("negative"),
        _count_if(pred == 1).alias("n_pred_pos"),
        _count_if(pred == 0).alias("n_pred_neg"),
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(tp + tn, F.count(F.lit(1))).alias("accuracy"),
    ]


def binary_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row of totals, confusion counts, precision, recall, accuracy.

    Ratios are null where the denominator is zero (the reference divides on
    the driver and would raise).
    """
    return df.agg(*_confusion(F.col(label), F.col(prediction)))


def apply_threshold(df: DataFrame, probability: Column | str, threshold: float,
                    out: str = "custom_prediction") -> DataFrame:
    """``1`` where the positive-class probability is strictly above ``t``."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return df.withColumn(out, (p > F.lit(float(threshold))).cast("int"))


def threshold_sweep(df: DataFrame, probability: Column | str, thresholds: Sequence[float],
                    label: str = "label") -> DataFrame:
    """E2 sweep: one binary report row per threshold: conditional counts for
    all thresholds in one aggregate over the rows as they are, then ``stack``."""
    p = F.col(probability) if isinstance(probability, str) else probability
    rows = df.select(F.col(label).alias("_y"), p.alias("_p"))
    aggs = [c.alias(f"{n}_{k}") for k, t in enumerate(thresholds)
            for c, n in zip(_confusion(F.col("_y"), (F.col("_p") > F.lit(float(t))).cast("int")), REPORT)]
    body = ", ".join(f"CAST({float(t)!r} AS DOUBLE), " + ", ".join(f"{n}_{k}" for n in REPORT)
                     for k, t in enumerate(thresholds))
    return rows.agg(*aggs).selectExpr(f"stack({len(thresholds)}, {body}) AS (threshold, {', '.join(REPORT)})")


def auroc_of_counts(hist: DataFrame, partitions: int | None = None) -> DataFrame:
    """AUROC of ``(_s, _pos, _neg)``, one row per score; the products are
    doubles, as those of two counts do not fit a bigint."""
    cum = running_total(hist, [F.col("_s").asc()], {"_cneg": F.col("_neg")}, partitions)
    pos, neg = F.col("_pos").cast("double"), F.col("_neg").cast("double")
    below = F.col("_cneg").cast("double") - neg
    return cum.agg(safe_ratio(F.sum(pos * (below + neg * 0.5)), F.sum(pos) * F.sum(neg)).alias("auroc"),
                   F.coalesce(F.sum("_pos"), F.lit(0)).alias("positive"), F.coalesce(F.sum("_neg"), F.lit(0)).alias("negative"))


def auroc(df: DataFrame, label: str = "label", score: Column | str = "score",
          exact: bool = True, partitions: int | None = None) -> DataFrame:
    """Area under the ROC curve, one row ``(auroc, positive, negative, left_out)``.

    Rows with a null score or a label other than 0 and 1 cannot be ranked; they
    are left out and counted in ``left_out``. ``auroc`` is null without both labels.

    ``exact=True``: rank-sum form with tied scores averaged,
    ``sum_s pos(s) * (neg_below(s) + neg(s)/2) / (P * N)``. Scores are first
    reduced to a per-score histogram (partial aggregation), and ``neg_below``
    is a distributed prefix sum over the sorted histogram (no single-task
    window). ``exact=False`` uses ``BinaryClassificationEvaluator`` on a vector
    ``score`` (1000-bin down-sampled curve) and returns ``(auroc)`` alone.
    """
    s = F.col(score) if isinstance(score, str) else score
    if not exact:
        value = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label,
                                              metricName="areaUnderROC").evaluate(df)
        return df.sparkSession.createDataFrame([(float(value),)], "auroc double")
    rows = df.select(s.cast("double").alias("_s"), F.col(label).alias("_y"))
    usable = F.col("_s").isNotNull() & F.coalesce(F.col("_y").isin(0, 1), F.lit(False))
    hist = (rows.where(usable).groupBy("_s")
            .agg(_count_if(F.col("_y") == 1).alias("_pos"), _count_if(F.col("_y") == 0).alias("_neg")))
    left_out = rows.select(_count_if(~usable)).scalar()
    return auroc_of_counts(hist, partitions).withColumn("left_out", left_out)


def auroc_by(df: DataFrame, by: Sequence[str], label: str = "label", score: str = "score",
             partitions: int | None = None) -> DataFrame:
    """E3 for every group at once: ``(by..., auroc, positive, negative)``.

    The rank sums of all groups come from one distributed prefix sum over the
    histogram of (group, score); a group's own sum begins at the least prefix
    of its rows, so that nothing is computed group by group. ``auroc`` is null
    without both labels; rows that cannot be ranked are left out.
    """
    by = list(by)
    rows = df.select(*by, F.col(score).cast("double").alias("_s"), F.col(label).alias("_y")).where(
        F.col("_s").isNotNull() & F.col("_y").isin(0, 1))
    hist = rows.groupBy(*by, "_s").agg(_count_if(F.col("_y") == 1).alias("_pos"), _count_if(F.col("_y") == 0).alias("_neg"))
    cum = running_total(hist, [*[F.col(c).asc() for c in by], F.col("_s").asc()], {"_cneg": F.col("_neg")}, partitions)
    pos, neg, upto = F.col("_pos").cast("double"), F.col("_neg").cast("double"), F.col("_cneg").cast("double")
    sums = cum.groupBy(*by).agg(F.sum(pos * (upto - neg * 0.5)).alias("_r"), F.min(upto - neg).alias("_before"),
                                F.sum("_pos").alias("positive"), F.sum("_neg").alias("negative"))
    area = safe_ratio(F.col("_r") - F.col("_before") * F.col("positive"), F.col("positive").cast("double") * F.col("negative"))
    return sums.select(*by, area.alias("auroc"), "positive", "negative")


def per_class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(class, tp, predicted, actual, precision, recall)`` for every class
    that occurs as a label or a prediction.

    One pass: ``groupBy(label, prediction)`` (at most classes^2 rows), each
    pair exploded into its two roles (as the true class, as the predicted
    class), then one ``groupBy(class)``. Precision is 0 for a class never
    predicted (as MLlib); recall is null for a class with no true rows (MLlib
    raises there).
    """
    pairs = df.groupBy(F.col(label).alias("_y"), F.col(prediction).alias("_p")).agg(
        F.count(F.lit(1)).alias("_c"))
    zero = F.lit(0).cast("bigint")
    as_true = F.struct(F.col("_y").alias("class"), F.col("_c").alias("actual"), zero.alias("predicted"),
                       F.when(F.col("_y") == F.col("_p"), F.col("_c")).otherwise(zero).alias("tp"))
    as_pred = F.struct(F.col("_p").alias("class"), zero.alias("actual"), F.col("_c").alias("predicted"),
                       zero.alias("tp"))
    roles = pairs.select(F.explode(F.array(as_true, as_pred)).alias("r")).select("r.*")
    rep = roles.groupBy("class").agg(F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"),
                                     F.sum("actual").alias("actual"))
    return rep.select(
        "class", "tp", "predicted", "actual",
        F.when(F.col("predicted") == 0, F.lit(0.0)).otherwise(safe_ratio("tp", "predicted")).alias("precision"),
        safe_ratio("tp", "actual").alias("recall"))


def _ideal_dcg(n: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0),
                       lambda acc, i: acc + F.lit(1.0) / F.log(i + 2))


def ranking_per_user(predicted: DataFrame, truth: DataFrame, user: str, item: str,
                     list_col: str, k: int) -> DataFrame:
    """Per-user precision@k, NDCG@k and average precision.

    ``predicted`` holds one ordered item list per user; ``truth`` holds one
    row per relevant (user, item). Truth sets are never collected: predicted
    positions are exploded (bounded by list length), matched to truth rows by
    a join on (user, item), and relevant-set sizes come from a grouped count.
    Users missing on either side are dropped, as with the reference's inner
    join; an empty predicted list scores 0.
    """
    truth_set = truth.select(user, item).distinct()
    sizes = truth_set.groupBy(user).agg(F.count(F.lit(1)).alias("_nrel"))
    pos = predicted.select(user, F.posexplode_outer(list_col).alias("_pos", item))
    hits = (pos.join(truth_set.withColumn("_hit", F.lit(1)), [user, item], "left")
            .withColumn("_hit", F.coalesce("_hit", F.lit(0))))
    cum = F.sum("_hit").over(Window.partitionBy(user).orderBy("_pos")
                             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hits = hits.withColumn("_cum", cum)
    in_k = F.col("_pos") < k
    is_hit = F.col("_hit") == 1
    per_user = hits.groupBy(user).agg(
        F.coalesce(F.sum(F.when(in_k & is_hit, 1)), F.lit(0)).alias("_hits_k"),
        F.coalesce(F.sum(F.when(in_k & is_hit, F.lit(1.0) / F.log(F.col("_pos") + 2))), F.lit(0.0)).alias("_dcg"),
        F.coalesce(F.sum(F.when(is_hit, F.col("_cum") / (F.col("_pos") + 1))), F.lit(0.0)).alias("_ap"))
    joined = per_user.join(sizes, user, "inner")
    return joined.select(
        user,
        (F.col("_hits_k") / F.lit(float(k))).alias("precision_at_k"),
        (F.col("_dcg") / _ideal_dcg(F.least(F.col("_nrel"), F.lit(k)))).alias("ndcg_at_k"),
        (F.col("_ap") / F.col("_nrel")).alias("average_precision"))


def ranking_report(predicted: DataFrame, truth: DataFrame, user: str, item: str,
                   list_col: str = "items", k: int = 10) -> DataFrame:
    """E5: mean precision@k, NDCG@k and MAP over users, one row, plus the
    number of users scored. Same definitions as MLlib ``RankingMetrics``:
    precision divides by ``k`` even for shorter lists; MAP divides by the
    relevant-set size and uses the whole predicted list."""
    per_user = ranking_per_user(predicted, truth, user, item, list_col, k)
    return per_user.agg(F.count(F.lit(1)).alias("users"),
                        F.avg("precision_at_k").alias("precision_at_k"),
                        F.avg("ndcg_at_k").alias("ndcg_at_k"),
                        F.avg("average_precision").alias("mean_average_precision"))
