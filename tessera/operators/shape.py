"""Projections, filters and predicates.

Filters on source columns reach the Parquet scan as ``PushedFilters``; keep
them on the source column rather than on a derived label.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import bucket_weight, fixed_field, one_vs_rest, unquote


def extract_fixed(df: DataFrame, col: str, fields: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Trimmed fixed-position fields, ``{name: (start, length)}`` 1-based."""
    return df.select(*[fixed_field(col, start, length).alias(name)
                       for name, (start, length) in fields.items()])


def keep_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Rows whose ``col`` starts with ``prefix``."""
    return df.where(F.col(col).startswith(prefix))


def strip_quotes(df: DataFrame, col: str, quote: str = '"') -> DataFrame:
    """Remove surrounding quotes in place."""
    return df.withColumn(col, unquote(col, quote))


def select_prefixed(df: DataFrame, prefix: str, drop: Iterable[str] = ()) -> DataFrame:
    """The columns starting with ``prefix``, in schema order, but for
    those in ``drop`` (by name, as positions are fragile under schema changes)."""
    gone = set(drop)
    return df.select(*[c for c in df.columns if c.startswith(prefix) and c not in gone])


def keep_above(df: DataFrame, col: str, n) -> DataFrame:
    """Strict threshold ``col > n`` (``n`` may be a scalar-subquery Column)."""
    return df.where(F.col(col) > n)


def lookup(df: DataFrame, key_col: str, value) -> DataFrame:
    """Point lookup. On a stored column the equality is pushed to the scan;
    on a computed one it is a filter above whatever computes it."""
    return df.where(F.col(key_col) == F.lit(value))


def binary_label(df: DataFrame, col: str, positive, out: str = "label") -> DataFrame:
    """One-vs-rest integer label (null category gives 0)."""
    return df.withColumn(out, one_vs_rest(col, positive))


def weight_by_label(df: DataFrame, label: str, weights: Mapping[float, Sequence],
                    default: float = 1.0, out: str = "weight") -> DataFrame:
    """Observation weight from label buckets, first match wins."""
    return df.withColumn(out, bucket_weight(label, weights, default))
