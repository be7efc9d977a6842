"""Pearson correlation of all column pairs from blocked, masked cross products (A10).

Columns are cut into blocks. A task turns each Arrow batch into a matrix of
centred values and a mask of the rows that have them, and adds up, for every
pair of blocks, the products that give the sums of a pair over the rows in
which both of its columns have a value:

    n = M'M   sx = X'M   sy = M'X   sxx = (X*X)'M   syy = M'(X*X)   sxy = X'X

It returns one row per pair of blocks, so the first stage puts out
blocks x tasks rows, however many rows it read; one aggregate adds them up.
Values are centred on their column's mean, which keeps the sums of squares
accurate; the means take a pass of their own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of one block, and pairs of blocks whose sums a task holds at once.
BLOCK_COLS, BAND_PAIRS = 64, 128
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy", "odd")
#: A column whose variance over the rows of a pair is below this share of its mean square is constant there.
CONSTANT = 1e-13


def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lists of equal length as a matrix, and where it has values."""
    flat = column.flatten()
    shape = (len(column), -1)
    return (flat.to_numpy(zero_copy_only=False).reshape(shape),
            flat.is_valid().to_numpy(zero_copy_only=False).reshape(shape))


def _values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("v"))


def column_means(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """The mean of each column's finite values, 0 without any; one row per task and column is added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(cols)), np.zeros(len(cols))
        for batch in batches:
            if batch.num_rows:
                x, has = matrix(batch.column(0))
                has &= np.isfinite(x)
                total += np.where(has, x, 0.0).sum(axis=0)
                n += has.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cols)), pa.int32()), pa.array(total), pa.array(n)], ["c", "t", "n"])

    sums = _values(df, cols).mapInArrow(run, "c int, t double, n double").groupBy("c").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    means = np.zeros(len(cols))
    for r in sums.where("n > 0").collect():  # one row per column
        means[r["c"]] = r["t"] / r["n"]
    return means


def _band(df: DataFrame, cols: Sequence[str], pairs: list[tuple[int, int]], means: np.ndarray) -> DataFrame:
    """``(i, j, sums...)`` of the pairs of blocks, from a scan of their columns alone."""
    blocks = sorted({b for p in pairs for b in p})
    span = {b: list(range(b * BLOCK_COLS, min((b + 1) * BLOCK_COLS, len(cols)))) for b in blocks}
    used = [k for b in blocks for k in span[b]]
    at = {b: slice(used.index(span[b][0]), used.index(span[b][-1]) + 1) for b in blocks}
    centre = means[used]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {p: np.zeros((len(SUMS), len(span[p[0]]), len(span[p[1]]))) for p in pairs}
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            x, has = matrix(batch.column(0))
            finite = has & np.isfinite(x)
            x, m = np.where(finite, x - centre, 0.0), has.astype(np.float64)
            square, odd = x * x, (has & ~finite).astype(np.float64)
            for (a, b), sums in held.items():
                i, j = at[a], at[b]
                for k, (left, right) in enumerate(((m, m), (x, m), (m, x), (square, m), (m, square), (x, x))):
                    sums[k] += left[:, i].T @ right[:, j]
                if odd[:, i].any() or odd[:, j].any():
                    sums[6] += odd[:, i].T @ m[:, j] + m[:, i].T @ odd[:, j]
        if seen:
            ends = [pa.array([p[k] for p in held], pa.int32()) for k in (0, 1)]
            sums = [pa.array([s[k].ravel() for s in held.values()], pa.list_(pa.float64())) for k in range(len(SUMS))]
            yield pa.RecordBatch.from_arrays([*ends, *sums], ["a", "b", *SUMS])

    schema = "a int, b int, " + ", ".join(f"{s} array<double>" for s in SUMS)
    made = _values(df, [cols[k] for k in used]).mapInArrow(run, schema)
    cells = made.select("a", "b", F.posexplode(F.arrays_zip(*SUMS)).alias("at", "s"))
    width = F.least(F.lit(BLOCK_COLS), F.lit(len(cols)) - F.col("b") * BLOCK_COLS)
    i = (F.col("a") * BLOCK_COLS + F.floor(F.col("at") / width)).cast("int")
    j = (F.col("b") * BLOCK_COLS + F.col("at") % width).cast("int")
    return (cells.select(i.alias("i"), j.alias("j"), "s.*").where("i < j")
            .groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS]))


def _variance(squares: str, total: str) -> Column:
    """``n`` times the sum of squared deviations; null where the column is constant."""
    n, s, t = F.col("n"), F.col(squares), F.col(total)
    spread = n * s - t * t
    return F.when(spread > F.lit(CONSTANT) * n * s, spread)


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: Pearson ``r`` for every pair ``i < j`` as ``(i, j, col_i, col_j, r)``.

    A pair leaves out the rows in which one of its two columns is null, at any
    number of columns. ``r`` is null without two such rows or where one of the
    columns is constant over them, and NaN where a value of them is not finite.
    No rows give no pairs. Wide tables are read in bands of ``BAND_PAIRS``
    pairs of blocks, each a scan of its own columns.
    """
    cols = list(cols)
    schema = "i int, j int, col_i string, col_j string, r double"
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], schema)
    means = column_means(df, cols)
    blocks = range((len(cols) + BLOCK_COLS - 1) // BLOCK_COLS)
    pairs = list(combinations_with_replacement(blocks, 2))
    sums = None
    for s in range(0, len(pairs), BAND_PAIRS):
        band = _band(df, cols, pairs[s:s + BAND_PAIRS], means)
        sums = band if sums is None else sums.unionAll(band)
    spread = F.sqrt(_variance("sxx", "sx")) * F.sqrt(_variance("syy", "sy"))
    r = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / spread
    r = F.when(r > 1.0, 1.0).when(r < -1.0, -1.0).otherwise(r)
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select("i", "j", F.get(names, F.col("i")).alias("col_i"), F.get(names, F.col("j")).alias("col_j"),
                       F.when(F.col("odd") > 0, F.lit(float("nan"))).otherwise(r).alias("r"))
