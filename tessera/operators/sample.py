"""Reproducible sampling and splitting.

Order and draws come from the data: ``hash_key`` of a unique row key and a
seed. Results are identical under any partitioning, after task retries, and
in SQL. ``rand()`` is avoided: after a shuffle its per-partition streams see
rows in a different order, so even a seeded rerun can differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import hash_key, uniform, uniform_at
from tessera.operators.rank import TARGET_BUCKET_ROWS, checked_broadcast, hash_cuts, numbered_by_hash


def numbered(df: DataFrame, by: Sequence[str], id_cols: Sequence[str], seed: int = 0,
             out: str = "row", size_out: str | None = "size",
             target_rows: int = TARGET_BUCKET_ROWS) -> DataFrame:
    """Random-order row number (1-based) and size within groups.

    ``id_cols`` must identify rows uniquely. Hot groups are split into hash
    buckets (see ``rank.numbered_by_hash``), so no task sorts a whole group.
    """
    keyed = df.withColumn("_h", hash_key(id_cols, seed))
    return numbered_by_hash(keyed, by, "_h", out, size_out, target_rows, tie=id_cols).drop("_h")


def _taken(df: DataFrame, cuts: DataFrame, by: Sequence[str], key: str, tie: Sequence[str], out: str) -> DataFrame:
    """Add ``out``: whether the row comes no later than its group's cut; null
    without a cut. The cuts, one row per group, are written, and broadcast
    where they are few."""
    named = checked_broadcast(cuts.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("cut").alias("_cut"))
                              .checkpoint(eager=True))
    same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
    return (df.join(named, same, "left").withColumn(out, F.struct(key, *tie) <= F.col("_cut"))
            .drop("_cut", *[f"_by{i}" for i in range(len(by))]))


def stratified_split(df: DataFrame, label: str, id_cols: Sequence[str], frac: float = 0.8,
                     seed: int = 0, out: str = "split") -> DataFrame:
    """M1: exact per-label split: rows with ``row < n * frac`` are ``train``.

    ``n`` is the label's row count and ``row`` the number in random (hash)
    order, ties by ``id_cols``, so each label keeps its share (strict ``<``, as
    in the reference: when ``n * frac`` is whole, train gets one row fewer).
    Only the hash of each label's last training row is looked for; every row
    then compares its own with it (``rank.hash_cuts``).
    """
    keyed = df.withColumn("_h", hash_key(id_cols, seed))
    cuts = hash_cuts(keyed, [label], "_h", lambda n: F.ceil(n * F.lit(float(frac))) - 1, id_cols)
    marked = _taken(keyed, cuts, [label], "_h", id_cols, "_train")
    return marked.withColumn(out, F.when(F.col("_train"), "train").otherwise("test")).drop("_h", "_train")


def random_split(df: DataFrame, id_cols: Sequence[str], weights: Sequence[float], seed: int = 0,
                 names: Sequence[str] | None = None, out: str = "split") -> DataFrame:
    """M2: independent draw per row against normalised cumulative weights.

    Adds one ``split`` column instead of returning several frames, so the
    input is read once and the parts are disjoint by construction.
    """
    names = list(names or (["train", "test"] if len(weights) == 2 else
                           [f"part{i}" for i in range(len(weights))]))
    total = float(sum(weights))
    u = uniform(id_cols, seed)
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(acc)
    expr = None
    for name, b in zip(names, bounds):
        expr = F.when(u < F.lit(b), name) if expr is None else expr.when(u < F.lit(b), name)
    last = F.lit(names[-1])
    return df.withColumn(out, last if expr is None else expr.otherwise(last))


def downsample(df: DataFrame, label: str, cls, rate: float | Column, id_cols: Sequence[str],
               seed: int = 0) -> DataFrame:
    """M3: keep rows of other labels, and rows of ``cls`` with draw < ``rate``
    (a number or a scalar-subquery Column)."""
    u = uniform(id_cols, seed)
    rate = rate if isinstance(rate, Column) else F.lit(float(rate))
    keep = (F.col(label) != F.lit(cls)) | ((F.col(label) == F.lit(cls)) & (u < rate))
    return df.where(keep)


def upsample(df: DataFrame, label: str, minority, majority, n: int, p: float,
             id_cols: Sequence[str], seed: int = 0) -> DataFrame:
    """M4: repeat each ``minority`` row ``k`` times, ``k`` = number of its ``n``
    draws above ``p`` (Binomial(n, 1-p), may be 0); ``majority`` rows once;
    rows of any other label are dropped, as in the reference."""
    draws = F.filter(F.sequence(F.lit(1), F.lit(n)),
                     lambda i: uniform_at(id_cols, seed, i) > F.lit(float(p)))
    copies = (F.when(F.col(label) == F.lit(majority), F.array(F.lit(0)))
              .when(F.col(label) == F.lit(minority), draws)
              .otherwise(F.array().cast("array<int>")))
    return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")


def repair_coverage(df: DataFrame, user: str, item: str, split: str = "split",
                    frac: float = 0.7, seed: int = 0, min_moved: int = 0,
                    train: str = "train", test: str = "test") -> DataFrame:
    """M5: move test rows of users absent from training into training.

    Per uncovered user with ``v`` test rows, the rows with random-order
    ``row < v * frac`` (or ``row <= min_moved``) switch to ``train``; the rest
    stay in test. The reference loops one filter per user; here one aggregate
    finds the uncovered users, and a cut key per such user tells which of its
    rows move. ``(user, item)`` must be unique.
    """
    in_train, in_test = F.col(split) == train, F.col(split) == test
    users = (df.groupBy(user).agg(F.max(F.when(in_train, 1)).alias("_tr"), F.max(F.when(in_test, 1)).alias("_te"))
             .where(F.col("_tr").isNull() & F.col("_te").isNotNull() & F.col(user).isNotNull()).select(user))
    keyed = df.withColumn("_h", hash_key([user, item], seed))
    rows = keyed.where(in_test).select(user, item, "_h").join(users, user, "left_semi")
    cuts = hash_cuts(rows, [user], "_h",
                     lambda v: F.greatest(F.ceil(v * F.lit(float(frac))) - 1, F.least(F.lit(min_moved), v)), [item])
    moved = _taken(keyed, cuts, [user], "_h", [item], "_moved")
    return (moved.withColumn(split, F.when(in_test & F.col("_moved"), train).otherwise(F.col(split)))
            .select(*df.columns))
