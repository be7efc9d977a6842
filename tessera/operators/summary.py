"""Aggregations, profiles, statistics and top-k.

Aggregations use Spark's partial/final hash aggregation, so a hot key is
combined map-side before the shuffle. Reports that the reference computes as
many separate count jobs are fused into one ``agg``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import safe_ratio
from tessera.operators.correlate import correlation_pairs
from tessera.operators.rank import numbered_in_order, placed_in_order, prefix_sums, running_total
from tessera.session import checkpoint_dir


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """A1: ``(name, rows)`` for several frames in one union-all job."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """A2: ``(label, count, ratio)``; the total is a one-row aggregate of the
    same frame, joined as a scalar, so no task sees all groups."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.select(label, "count", (F.col("count") / total).alias("ratio"))


def group_counts(df: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """A3: rows per group, most frequent first, ties by key."""
    keys = [by] if isinstance(by, str) else list(by)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), *keys))


def profile_by(df: DataFrame, key: str, counted: str, value: str,
               names: tuple[str, str] = ("n", "total"), ordered: bool = False) -> DataFrame:
    """A4: per key, ``count(counted)`` (non-null) and ``sum(value)``.

    ``ordered=True`` (O2) sorts by the count descending, ties by key: a
    range-partitioned sort, for display or a sorted sink only.
    """
    out = df.groupBy(key).agg(F.count(F.col(counted)).alias(names[0]),
                              F.sum(value).alias(names[1]))
    return out.orderBy(F.col(names[0]).desc(), F.col(key)) if ordered else out


def order_rows(df: DataFrame, *keys: Column) -> DataFrame:
    """O3: multi-key sort with explicit null placement (Spark puts nulls
    first in ascending order, DuckDB last), e.g.
    ``order_rows(df, F.col("user").asc_nulls_last(), F.col("score").desc_nulls_last())``."""
    return df.orderBy(*keys)


def positions(ordered: DataFrame, out: str = "position") -> DataFrame:
    """O3, checked form: the rows of a sorted frame with their 1-based place in it.

    A sort leaves rows in order inside partitions and across them; the frame is
    written as it lies, and the places are counted up partition by partition."""
    checkpoint_dir(ordered.sparkSession)
    placed = ordered.withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True)
    return running_total(placed, [F.col("_at").asc()], {out: F.lit(1).cast("bigint")}).drop("_at")


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False,
                    rsd: float = 0.05) -> DataFrame:
    """A5: exact (or HyperLogLog++) distinct count per column, one job."""
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in cols])
    return df.agg(*[F.countDistinct(c).alias(c) for c in cols])


def values_per_group(df: DataFrame, by: str, col: str) -> DataFrame:
    """The distinct non-null ``col`` values of each group, one row each, so
    that a group of any number of values fits."""
    return df.where(F.col(col).isNotNull()).select(by, col).distinct()


def top_k_per_group(df: DataFrame, by: str | Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group by ``order``.

    The plain ``row_number() <= k`` form lets Spark insert a partial
    ``WindowGroupLimit`` before the shuffle, so a hot group ships at most ``k``
    rows per input partition.
    """
    keys = [by] if isinstance(by, str) else list(by)
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    name = rank_col or "_rank"
    out = df.withColumn(name, rn).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def ranked_items(df: DataFrame, user: str, item: str, weight: str, k: int | None = None,
                 position: str = "position") -> DataFrame:
    """Each user's items, heaviest first (ties by item), as rows
    ``(user, position, item)`` with positions from 1; ``k=None`` is the whole list.

    No list is ever one row. With ``k`` the cut runs before the shuffle (O7).
    Whole lists are numbered inside range partitions, with one offset carried
    over each partition boundary (``rank.numbered_in_order``).
    """
    if k is not None:
        top = top_k_per_group(df, user, [F.col(weight).desc(), F.col(item)], k, rank_col=position)
        return top.select(user, F.col(position).cast("bigint").alias(position), item)
    order = [F.col(weight).desc(), F.col(item).asc()]
    return numbered_in_order(df.select(user, item, weight), [user], order, position).select(user, position, item)


def describe_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, count, mean, stddev, min, max)`` per column, numeric.

    One aggregate over all columns (one scan), then ``stack`` to long form.
    ``stddev`` is the sample standard deviation, as in ``describe()``.
    """
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"a{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"n{i}"), F.max(x).alias(f"x{i}")]
    wide = df.agg(*aggs)
    body = ", ".join(f"'{c}', c{i}, a{i}, s{i}, n{i}, x{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {body}) AS (column, count, mean, stddev, min, max)")


def quantile_value(df: DataFrame, col: str, p: float, rel_err: float = 0.0) -> Column:
    """A scalar-subquery Column holding one quantile of ``col`` (see ``quantiles``)."""
    return quantiles(df, [col], [p], rel_err).select("value").scalar()


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              rel_err: float = 0.0) -> DataFrame:
    """``(column, probability, value)`` for every column and probability.

    ``rel_err=0`` is exact: the smallest value whose cumulative share reaches
    ``p`` (equal to ``approxQuantile(..., 0)``); a column without values gives
    nulls. Values are counted per (column, value), the counts are summed up in
    value order by distributed prefix sums, and each probability takes the first
    value that reaches it, so that a column of distinct doubles is never in one
    task. ``rel_err>0`` uses the bounded Greenwald-Khanna sketch of
    ``percentile_approx``. Nulls are left out.
    """
    names = [(c, float(p)) for c in cols for p in probs]
    if rel_err > 0:
        accuracy = max(1, int(round(1.0 / rel_err)))
        wide = df.agg(*[F.percentile_approx(c, p, accuracy).cast("double").alias(f"q{k}") for k, (c, p) in enumerate(names)])
    else:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v"))
                                             for i, c in enumerate(cols)])).alias("x")).select("x.c", "x.v")
        counts = long.where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        order = [F.col("c").asc(), F.col("v").asc()]
        placed = placed_in_order(counts, order)
        # One row of bounds per column of the call.
        totals = placed.groupBy("c").agg(F.sum("n").alias("total"))
        earlier = Window.orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
        bounds = F.broadcast(totals.withColumn("before", F.coalesce(F.sum("total").over(earlier), F.lit(0))))
        upto = prefix_sums(placed, order, {"cum": F.col("n")})
        share = (F.col("cum") - F.col("before")) / F.col("total")
        at = upto.join(bounds, "c").select("c", "v", share.alias("share"))
        place = {c: i for i, c in enumerate(cols)}
        wide = at.agg(*[F.min(F.when((F.col("c") == place[c]) & (F.col("share") >= p), F.col("v"))).alias(f"q{k}")
                        for k, (c, p) in enumerate(names)])
    body = ", ".join(f"'{c}', CAST({p!r} AS DOUBLE), q{k}" for k, (c, p) in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {body}) AS (column, probability, value)")


def correlated_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.8,
                     absolute: bool = False) -> DataFrame:
    """Pairs with ``r > threshold`` (one-sided unless ``absolute``)."""
    pairs = correlation_pairs(df, cols)
    r = F.abs(F.col("r")) if absolute else F.col("r")
    return pairs.where(r > threshold)


def columns_to_drop(flagged: Sequence[tuple[int, int]], cols: Sequence[str]) -> list[str]:
    """Greedy rule: walk flagged pairs in ``(i, j)`` order and drop ``j``
    unless ``i`` or ``j`` is already dropped."""
    dropped: set[int] = set()
    for i, j in sorted(flagged):
        if i in dropped or j in dropped:
            continue
        dropped.add(j)
    return [cols[k] for k in sorted(dropped)]


def decorrelate(df: DataFrame, cols: Sequence[str], threshold: float = 0.8,
                absolute: bool = False, drop: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Drop one column of each highly correlated pair.

    ``drop`` overrides the rule with a manual choice. The flagged pairs are at
    most columns^2 / 2 rows, so reading them on the driver is bounded.
    """
    if drop is None:
        flagged = [(r["i"], r["j"]) for r in
                   correlated_pairs(df, cols, threshold, absolute).select("i", "j").collect()]
        drop = columns_to_drop(flagged, list(cols))
    return df.drop(*drop), list(drop)


def kept_columns(df: DataFrame, cols: Sequence[str], threshold: float = 0.8, absolute: bool = False) -> DataFrame:
    """A11 as rows: ``(column, kept)`` for every candidate column."""
    _, dropped = decorrelate(df, cols, threshold, absolute)
    return df.sparkSession.createDataFrame([(c, c not in dropped) for c in cols], "column string, kept boolean")


def retention(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(before, after, ratio)`` in one row; null ratio on an empty input."""
    n_after = after.select(F.count(F.lit(1))).scalar()
    return (before.agg(F.count(F.lit(1)).alias("before"))
            .select("before", n_after.alias("after"),
                    safe_ratio(n_after, F.col("before")).alias("ratio")))


def histogram(df: DataFrame, col: str, width: float, origin: float = 0.0) -> DataFrame:
    """Fixed-width bins ``[bin_start, bin_start + width)`` with counts."""
    start = (F.floor((F.col(col) - F.lit(origin)) / F.lit(width)) * F.lit(width) + F.lit(origin))
    return (df.where(F.col(col).isNotNull())
            .groupBy(start.cast("double").alias("bin_start"))
            .agg(F.count(F.lit(1)).alias("count")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of one column."""
    return df.select(col).dropDuplicates()


def top_rows(df: DataFrame, by: str, n: int, tie: Sequence[str] = ()) -> DataFrame:
    """O1: the ``n`` rows with the largest ``by`` (ties by ``tie`` ascending);
    planned as ``TakeOrderedAndProject`` (per-partition top-n, no full sort)."""
    return df.orderBy(F.col(by).desc(), *[F.col(t) for t in tie]).limit(n)
