"""Joins and unions.

No broadcast hints: Spark (and AQE at run time, from measured sizes) turns a
join into a broadcast only when the build side is under
``spark.sql.autoBroadcastJoinThreshold``, which is the size check. Skewed
probe keys are split by AQE's skew-join rule for inner, semi and anti joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.shape import keep_above

Keys = str | Sequence[str]


def _keys(on: Keys) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def effective_exclusions(exclusions: DataFrame, accepted: DataFrame, on: Keys) -> DataFrame:
    """Exclusion rows minus the manually accepted exceptions."""
    return (exclusions.join(accepted.select(*_keys(on)), _keys(on), "left_anti")
            .select(*exclusions.columns))


def exclude(df: DataFrame, exclusions: DataFrame, on: Keys) -> DataFrame:
    """Drop rows whose key appears in ``exclusions``.

    Anti-join semantics: a null key never matches, so null-key rows are kept
    (``NOT IN`` would drop everything once the list holds a null). Every
    duplicate of an excluded key is removed.
    """
    return df.join(exclusions.select(*_keys(on)), _keys(on), "left_anti").select(*df.columns)


def attach_label(features: DataFrame, labels: DataFrame, on: str,
                 feature_key: str | None = None) -> DataFrame:
    """Inner join of features and labels; rows unlabelled on either side drop."""
    if feature_key and feature_key != on:
        features = features.withColumnRenamed(feature_key, on)
    return features.join(labels, on, "inner")


def item_profile(df: DataFrame, user: str, item: str, value: str) -> DataFrame:
    return df.groupBy(item).agg(F.count(F.col(user)).alias("item_users"), F.sum(value).alias("item_total"))


def user_profile(df: DataFrame, user: str, value: str) -> DataFrame:
    return df.groupBy(user).agg(F.count(F.col(value)).alias("user_items"), F.sum(value).alias("user_total"))


def reduce_facts(df: DataFrame, user: str, item: str, value: str,
                 min_user_items: Column | float, min_item_total: Column | float,
                 keep_stats: bool = False, users: DataFrame | None = None,
                 items: DataFrame | None = None) -> DataFrame:
    """Keep facts whose item total exceeds ``min_item_total`` and whose
    user has more than ``min_user_items`` items (both strict).

    Thresholds may be scalar-subquery Columns (see ``summary.quantile_value``)
    so the whole reduction is one lazy plan. ``keep_stats=False`` uses
    semi-joins (no aggregate columns carried); ``True`` reproduces the
    reference's inner joins that carry the profile columns along. ``users``
    ``(user, user_items, user_total)`` and ``items`` ``(item, item_users,
    item_total)`` are profiles that exist already; else they are built here.
    """
    items = items if items is not None else item_profile(df, user, item, value)
    users = users if users is not None else user_profile(df, user, value)
    items = keep_above(items, "item_total", min_item_total)
    users = keep_above(users, "user_items", min_user_items)
    if keep_stats:
        out = df.join(items, item, "inner").join(users, user, "inner")
        extra = ["item_users", "item_total", "user_items", "user_total"]
        return out.select(*df.columns, *extra)
    return (df.join(items.select(item), item, "left_semi")
              .join(users.select(user), user, "left_semi"))


def uncovered(test: DataFrame, train: DataFrame, on: Keys) -> DataFrame:
    """Rows of ``test`` whose key has no row in ``train``."""
    return (test.join(train.select(*_keys(on)).distinct(), _keys(on), "left_anti")
            .select(*test.columns))


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by column name (the reference aligns columns first)."""
    return a.unionByName(b.select(*a.columns))
