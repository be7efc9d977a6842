"""Column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``, so
it runs inside whole-stage codegen and has a one-line SQL twin.

Randomness is derived from data: ``hash_key`` is the md5 of the key columns
and a seed, and ``uniform`` reads its first 32 bits as a number in [0, 1).
The same rows therefore get the same draw under any partitioning, after
retries and in DuckDB, where the twin of ``uniform`` is
``('0x' || substr(md5(k), 1, 8))::BIGINT / 4294967296.0``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

ColumnLike = Column | str

_TWO_POW_32 = 4294967296.0


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _key_text(cols: Sequence[ColumnLike], seed: int | str, *extra: Column) -> Column:
    """``length:text`` of every part, ``n`` for a null, then the seed: different
    keys never have the same text."""
    parts = [_col(c).cast("string") for c in cols] + [e.cast("string") for e in extra]
    marked = [F.coalesce(F.concat(F.char_length(p).cast("string"), F.lit(":"), p), F.lit("n")) for p in parts]
    return F.concat(*marked, F.lit(f"#{seed}"))


def hash_key(cols: Sequence[ColumnLike], seed: int | str = 0) -> Column:
    """md5 hex of the key columns and a seed: a stable, uniform ordering key.

    Key columns must be strings or integers (their text form is the same in
    every engine) and together unique, or the order among equal keys is
    undefined.
    """
    return F.md5(_key_text(cols, seed))


def _unit(hex_digest: Column) -> Column:
    return F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("bigint") / F.lit(_TWO_POW_32)


def uniform(cols: Sequence[ColumnLike], seed: int | str = 0) -> Column:
    """Deterministic draw in [0, 1) for the row identified by ``cols``."""
    return _unit(hash_key(cols, seed))


def uniform_at(cols: Sequence[ColumnLike], seed: int | str, index: Column) -> Column:
    """The ``index``-th draw for a row (``index`` may be a lambda variable)."""
    return _unit(F.md5(_key_text(cols, seed, index)))


def fixed_field(col: ColumnLike, start: int, length: int) -> Column:
    """Characters ``start .. start+length-1`` (1-based), spaces trimmed."""
    return F.trim(F.substring(_col(col), start, length))


def unquote(col: ColumnLike, quote: str = '"') -> Column:
    """Strip the quote character from both ends, whatever the id length."""
    return F.btrim(_col(col), F.lit(quote))


def one_vs_rest(col: ColumnLike, positive) -> Column:
    """1 where the value equals ``positive``, else 0 (null gives 0)."""
    return F.when(_col(col) == F.lit(positive), 1).otherwise(0).cast("int")


def bucket_weight(col: ColumnLike, weights: Mapping[float, Iterable], default: float = 1.0) -> Column:
    """Weight by label membership; the first matching bucket wins."""
    c = _col(col)
    expr = None
    for weight, members in weights.items():
        members = list(members)
        cond = c.isin(members)
        expr = F.when(cond, F.lit(float(weight))) if expr is None else expr.when(cond, F.lit(float(weight)))
    return F.lit(float(default)) if expr is None else expr.otherwise(F.lit(float(default)))


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Division that yields null on a zero denominator (ANSI would raise)."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def positive_probability(col: ColumnLike, dtype: DataType | None = None) -> Column:
    """Element 1 of a probability vector or array column."""
    c = _col(col)
    if isinstance(dtype, ArrayType):
        return F.element_at(c, 2).cast("double")
    return vector_to_array(c).getItem(1)


def top_k_by_score(list_col: ColumnLike, k: int | None, item: str = "item",
                   score: str = "rating") -> Column:
    """Items of an ``array<struct<item, score>>`` best first, ties by item.

    ``k=None`` keeps the whole list.
    """
    ordered = F.array_sort(
        _col(list_col),
        lambda a, b: F.when(a[score] > b[score], -1)
        .when(a[score] < b[score], 1)
        .when(a[item] < b[item], -1)
        .when(a[item] > b[item], 1)
        .otherwise(0),
    )
    if k is not None:
        ordered = F.slice(ordered, 1, k)
    return F.transform(ordered, lambda z: z[item])
