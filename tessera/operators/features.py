"""Feature preparation.

MLlib estimators are used where the reference uses them; each also has a
native column form that stays in the SQL engine, used by the query catalog
and checked against SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.rank import checked_broadcast, dense_index
from tessera.session import checkpoint_dir


def assembler(cols: Sequence[str], out: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """pack numeric columns into one vector column."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)


def scaler_pipeline(cols: Sequence[str], out: str = "scaled") -> Pipeline:
    """F1+F2 as an MLlib pipeline: assemble, then centre and scale."""
    return Pipeline(stages=[
        assembler(cols, "_raw_features"),
        StandardScaler(inputCol="_raw_features", outputCol=out, withMean=True, withStd=True),
    ])


def fit_scaler(train: DataFrame, cols: Sequence[str], out: str = "scaled") -> PipelineModel:
    """F2 (MLlib): fit on training rows only; apply with ``.transform``.

    The reference fits on all rows before splitting, which leaks test
    statistics; pass the whole frame to reproduce that.
    """
    return scaler_pipeline(cols, out).fit(train)


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
                suffix: str = "") -> DataFrame:
    """F2 (native): ``(x - mean) / stddev_samp`` per column; 0 where the
    column is constant (as ``StandardScaler``).

    Fitting is one aggregate over ``fit_on`` (default ``df``); its result,
    two numbers per column, comes back to the driver, exactly like an MLlib
    scaler model, and is applied as literals inside codegen. (A scalar
    subquery per use would be planned once per reference.)
    """
    source = fit_on if fit_on is not None else df
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    stats = source.agg(*aggs).first()
    out = df
    for i, c in enumerate(cols):
        m, s = stats[f"m{i}"], stats[f"s{i}"]
        if s is None or s == 0 or m is None:
            scaled = F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
        else:
            scaled = (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
        out = out.withColumn(c + suffix, scaled)
    return out


def fit_index(df: DataFrame, col: str, out: str = "index", partitions: int | None = None) -> DataFrame:
    """F3, fitted: the vocabulary ``(col, frequency, out)`` of the non-null values of
    one frame, index by descending frequency, ties by value ascending
    (``StringIndexer``'s default ``frequencyDesc``), as a double.

    Value counts (partial aggregation) and a distributed global rank of the
    distinct values (``rank.dense_index``: no single-task window, no vocabulary
    on the driver). The table is written once, to be applied to any frame.
    """
    checkpoint_dir(df.sparkSession)
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("frequency"))
    vocab = dense_index(counts, [F.col("frequency").desc(), F.col(col).asc()], "_idx", partitions)
    return vocab.select(col, "frequency", F.col("_idx").cast("double").alias(out)).checkpoint(eager=True)


UNSEEN = ("error", "skip", "keep", "null")


def apply_index(df: DataFrame, vocab: DataFrame, col: str, out: str = "index", unseen: str = "error") -> DataFrame:
    """F3, applied: add ``out``, the index of ``col`` in a vocabulary that was
    fitted on another frame (``fit_index``).

    ``unseen`` says what becomes of values that the vocabulary lacks, nulls
    included: ``error`` fails the job (at run time, naming the value), ``skip``
    drops their rows, ``keep`` gives them the index behind the last one, all as
    ``StringIndexerModel`` does, and ``null`` a null index. The vocabulary is a
    table of one row per value; joined by shuffle, or broadcast where it is
    small (``rank.checked_broadcast``).
    """
    if unseen not in UNSEEN:
        raise ValueError(f"unseen is one of {UNSEEN}")
    index = [c for c in vocab.columns if c not in (col, "frequency")][0]
    named = vocab.select(F.col(col).alias("_value"), F.col(index).alias("_index"))
    joined = df.join(checked_broadcast(named), F.col(col) == F.col("_value"), "inner" if unseen == "skip" else "left")
    found = F.col("_index")
    if unseen == "keep":
        found = F.coalesce(found, vocab.select(F.count(F.lit(1)).cast("double")).scalar())
    if unseen == "error":
        name = F.concat(F.lit(f"not in the fitted index of {col}: "), F.coalesce(F.col(col).cast("string"), F.lit("null")))
        found = F.when(found.isNull(), F.raise_error(name)).otherwise(found)
    return joined.select(*[F.col(c) for c in df.columns], found.alias(out))


def string_index(df: DataFrame, col: str, out: str, method: str = "native",
                 partitions: int | None = None) -> DataFrame:
    """F3 fitted and applied to the same frame; null values get a null index.

    ``ml``: MLlib ``StringIndexer``, whose fit collects the vocabulary to the
    driver; use only for bounded vocabularies.
    """
    if method == "ml":
        model = StringIndexer(inputCol=col, outputCol=out).fit(df)
        return model.transform(df)
    return apply_index(df, fit_index(df, col, out, partitions), col, out, "null")


def string_index_table(df: DataFrame, col: str, out: str = "index",
                       partitions: int | None = None) -> DataFrame:
    """F3 vocabulary only: ``(value, frequency, index)``."""
    return fit_index(df, col, out, partitions)
