"""Mergeable states for quantiles and distinct counts.

A state has one row per part of the data (a day, a file, a partition), column
and, for bitmaps, range of keys. States are stored and merged: over all parts,
or over any grouping of them, without reading the data again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _long(df: DataFrame, by: Sequence[str], cols: Sequence[str], kind: str) -> DataFrame:
    """``by..., column, v``: one row per value that is not null."""
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("v")) for c in cols])
    return df.select(*by, F.explode(values).alias("x")).select(*by, "x.column", "x.v").where("v is not null")


# --- quantiles --------------------------------------------------------------

def quantile_state(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: int = 200) -> DataFrame:
    """``(by..., column, n, sketch)``: a KLL sketch of each column in each part.
    A larger ``k`` gives smaller rank errors (about 1.7 % at 200)."""
    long = _long(df, by, cols, "double")
    return long.groupBy(*by, "column").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("v", k).alias("sketch"))


def merged_quantiles(state: DataFrame, probs: Sequence[float], by: Sequence[str] = (), k: int = 200) -> DataFrame:
    """``(by..., column, probability, n, value)`` of the merged sketches."""
    merged = state.groupBy(*by, "column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))
    at = F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
                   for p in probs])
    return merged.select(*by, "column", "n", F.explode(at).alias("q")).select(*by, "column", "q.probability", "n", "q.value")


def rank_audit(found: DataFrame, df: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Exact ranks of ``found(column, probability, n, value)`` in ``df``:
    ``(column, probability, n, below, upto, within)``, the shares of values
    smaller than the value and no larger, and whether that interval comes
    within ``tolerance`` of the probability. ``found`` has one row per column
    and probability, which are counted in one aggregate."""
    asked = found.select("column", "probability", "n", "value").collect()
    counts = []
    for k, r in enumerate(asked):
        x, v = F.col(r["column"]).cast("double"), F.lit(r["value"])
        counts += [F.count_if(x < v).alias(f"b{k}"), F.count_if(x <= v).alias(f"u{k}"), F.count(x).alias(f"n{k}")]
    if not asked:
        return df.sparkSession.createDataFrame(
            [], "column string, probability double, n bigint, below double, upto double, within boolean")
    body = ", ".join(f"'{r['column']}', CAST({r['probability']!r} AS DOUBLE), CAST({r['n']} AS BIGINT), b{k} / n{k}, u{k} / n{k}"
                     for k, r in enumerate(asked))
    ranks = df.agg(*counts).selectExpr(f"stack({len(asked)}, {body}) AS (column, probability, n, below, upto)")
    inside = (F.col("below") <= F.col("probability") + tolerance) & (F.col("upto") >= F.col("probability") - tolerance)
    return ranks.withColumn("within", F.coalesce(inside, F.lit(False)))


# --- distinct counts --------------------------------------------------------

def distinct_bitmaps(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, bucket, bits)``: exact states of whole-number keys, one
    bitmap of 32,768 keys a row; best for dense keys (ids, indexes)."""
    long = _long(df, by, cols, "bigint")
    bucket, at = F.bitmap_bucket_number("v").alias("bucket"), F.bitmap_bit_position("v").alias("at")
    return long.select(*by, "column", bucket, at).groupBy(*by, "column", "bucket").agg(F.bitmap_construct_agg("at").alias("bits"))


def bitmap_counts(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, distinct)``: exact counts of the merged bitmaps."""
    merged = state.groupBy(*by, "column", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return merged.groupBy(*by, "column").agg(F.sum("n").alias("distinct"))


def distinct_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), lg_k: int = 12) -> DataFrame:
    """``(by..., column, sketch)``: HyperLogLog states of keys of any type."""
    return _long(df, by, cols, "string").groupBy(*by, "column").agg(F.hll_sketch_agg("v", F.lit(lg_k)).alias("sketch"))


def sketch_counts(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, distinct)``: estimates from the merged sketches."""
    merged = state.groupBy(*by, "column").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, "column", F.hll_sketch_estimate("sketch").alias("distinct"))


def sketch_bound(lg_k: int = 12, deviations: float = 4.0) -> float:
    """Relative error that an estimate stays below but for ``deviations`` standard errors."""
    return deviations * 1.04 / (1 << lg_k) ** 0.5


def close_to(estimate: Column, exact: Column, bound: float) -> Column:
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * F.lit(bound))
