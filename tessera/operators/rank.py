"""Exact ranks that never put a whole group, or the whole table, in one task.

``row_number().over(Window.partitionBy(g).orderBy(k))`` sorts each group in a
single task: with a two-valued label or one very active user that task holds
a third or more of all rows. ``Window.orderBy(k)`` without a partition puts
everything in one task. The two primitives below give the same numbers with
bounded work per task.

* ``numbered_by_hash`` — row number and group size inside groups, ordered by
  a uniform hash key. A group larger than a target bucket size is split into
  buckets by the leading hex digits of its key (as many digits as its size
  needs). Bucket sizes are aggregated, turned into per-bucket offsets by a
  window over each group's buckets, and added to a row number local to the
  bucket.

* ``hash_cuts`` — per group, the hash key of its n-th row, from counts of hash
  prefixes and a row number inside one prefix only; a split needs no more.

* ``numbered_in_order`` — row number inside groups in any order: one range
  partitioning by group and order, numbers inside (partition, group), and an
  offset for the one group that may go on from the partition before.

* ``running_total`` — global prefix sums in any order: range-partition by the
  order, pin the partitioning with a reliable checkpoint (range bounds are
  sampled, so a recomputation could move rows), sum inside each partition,
  and add per-partition offsets (one row per partition, a proven-small
  broadcast).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right
    for i, k in enumerate(keys):
        renamed = renamed.withColumnRenamed(k, f"_rk{i}")
    cond = [left[k].eqNullSafe(renamed[f"_rk{i}"]) for i, k in enumerate(keys)]
    joined = left.join(renamed, cond, "inner")
    return joined.drop(*[f"_rk{i}" for i in range(len(keys))])


# Rows of a table that may be broadcast; those of this module hold a digest and a few ids each.
BROADCAST_ROWS = 1 << 17


def checked_broadcast(written: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``written`` (a checkpoint or a table, as it is counted here) with a
    broadcast hint if it has at most ``max_rows`` rows, else as it is, for a
    shuffle join that AQE may split."""
    return F.broadcast(written) if written.limit(max_rows + 1).count() <= max_rows else written


# Rows one task may window-sort per bucket before a group is split further.
TARGET_BUCKET_ROWS = 1 << 20


def numbered_by_hash(df: DataFrame, by: Sequence[str], key: str, out: str = "row",
                     size_out: str | None = "size", target_rows: int = TARGET_BUCKET_ROWS,
                     tie: Sequence[str] = ()) -> DataFrame:
    """Add ``out`` (1-based row number within ``by`` ordered by ``key``, then
    ``tie``) and optionally ``size_out`` (group size).

    ``key`` must be a lowercase hex digest (e.g. ``md5``): its leading
    characters spread rows evenly and order buckets like the key itself.
    Each group gets just enough leading characters ``L`` that its buckets hold
    about ``target_rows`` rows or fewer (``L = 0``, one bucket, for ordinary
    groups), so a group with a third of all rows is split into many tasks
    while the bucket-offset table stays near one row per group. Group sizes
    come from a partial aggregation; joining them back is a broadcast when the
    group table is small and otherwise a shuffle join that AQE splits on a
    skewed key. Null group keys form their own group, as in a window.
    """
    by = list(by)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    depth = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("_n") / F.lit(float(target_rows))))).cast("int")
    sizes = sizes.withColumn("_L", F.least(depth, F.lit(32)))
    x = _null_safe_join(df, sizes, by)
    x = x.withColumn("_b", F.expr(f"substring(`{key}`, 1, _L)"))
    local_w = Window.partitionBy(*by, "_b").orderBy(F.col(key), *[F.col(t) for t in tie])
    local = x.withColumn("_lr", F.row_number().over(local_w))
    counts = x.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_bc"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_b", F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_off"))
    joined = _null_safe_join(local, offsets, [*by, "_b"])
    cols = [F.col(c) for c in df.columns] + [(F.col("_off") + F.col("_lr")).cast("bigint").alias(out)]
    if size_out:
        cols.append(F.col("_n").alias(size_out))
    return joined.select(*cols)


# Hex digits that one step of the search for a cut adds, and rows that the last step may rank.
CUT_STEP, CUT_ROWS = 3, 1 << 16


def hash_cuts(df: DataFrame, by: Sequence[str], key: str, take, tie: Sequence[str] = (),
              out: str = "cut", max_rows: int = CUT_ROWS, step: int = CUT_STEP) -> DataFrame:
    """``(by..., out)``: the struct ``(key, tie...)`` of the row numbered ``take``
    in each group's (key, tie) order; no row where that number is below 1.

    ``take`` maps the group size (a Column) to a row number. Rows are counted
    per group and hash prefix (partial aggregation, at most 16^``step`` rows
    per group) and the prefix that holds the wanted row stays open. While an
    open prefix holds more than ``max_rows`` rows, it is counted again by
    ``step`` more digits, to the whole digest if need be, so the last step
    ranks at most ``max_rows`` rows of a group however large the group is
    (rows of one and the same digest apart, which only ``tie`` tells apart).
    The open prefixes are written each time, one row per group, and broadcast
    where they are few (``checked_broadcast``).
    """
    by = list(by)
    checkpoint_dir(df.sparkSession)
    rows, group = df.select(*dict.fromkeys([*by, key, *tie])), Window.partitionBy(*by)
    first = F.substring(F.col(key), 1, step)
    sums = rows.groupBy(*by, first.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    sums = sums.withColumn("_need", take(F.sum("_c").over(group)).cast("bigint"))
    depth = step
    while True:
        upto = F.sum("_c").over(group.orderBy("_p"))
        need = F.col("_need")
        open_ = (sums.withColumn("_upto", upto).where((need >= 1) & (F.col("_upto") >= need) & (F.col("_upto") - F.col("_c") < need))
                 .select(*by, "_p", "_c", (need - F.col("_upto") + F.col("_c")).alias("_need")).checkpoint(eager=True))
        inside = _null_safe_join(rows.withColumn("_p", F.substring(F.col(key), 1, depth)), checked_broadcast(open_), [*by, "_p"])
        if depth >= 32 or (open_.agg(F.max("_c")).first()[0] or 0) <= max_rows:
            break
        depth = min(32, depth + step)
        sums = inside.groupBy(*by, F.substring(F.col(key), 1, depth).alias("_p")).agg(
            F.count(F.lit(1)).alias("_c"), F.first("_need").alias("_need"))
    number = F.row_number().over(group.orderBy(F.col(key), *[F.col(t) for t in tie]))
    return (inside.withColumn("_row", number).where(F.col("_row") == F.col("_need"))
            .select(*by, F.struct(key, *tie).alias(out)))


def running_total(df: DataFrame, order: Sequence[Column], values: Mapping[str, Column],
                  partitions: int | None = None) -> DataFrame:
    """Append inclusive prefix sums ``values`` in the global ``order``.

    Rows with equal order keys land in the same range partition; the order
    must be total (add a unique tie-break) for row-exact results. Triggers one
    job to write the checkpoint under the shared checkpoint folder.
    """
    return prefix_sums(placed_in_order(df, order, partitions), order, values)


def placed_in_order(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """The rows range-partitioned by ``order`` and written, with their partition as ``_part``."""
    checkpoint_dir(df.sparkSession)
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n_parts, *order).withColumn("_part", F.spark_partition_id()).checkpoint(eager=True)


def prefix_sums(pinned: DataFrame, order: Sequence[Column], values: Mapping[str, Column]) -> DataFrame:
    """``running_total`` of rows that ``placed_in_order`` has written."""
    names = list(values)
    local_w = Window.partitionBy("_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = pinned.select("*", *[F.sum(values[n]).over(local_w).alias(f"_l{i}")
                                 for i, n in enumerate(names)])
    totals = pinned.groupBy("_part").agg(*[F.sum(values[n]).alias(f"_t{i}")
                                           for i, n in enumerate(names)])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_o{i}")
                                       for i in range(len(names))])
    joined = local.join(F.broadcast(offsets), "_part")
    return joined.select(*[F.col(c) for c in pinned.columns if c != "_part"],
                         *[(F.col(f"_o{i}") + F.col(f"_l{i}")).alias(n) for i, n in enumerate(names)])


def numbered_in_order(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "row",
                      partitions: int | None = None) -> DataFrame:
    """Add ``out``: the 1-based row number inside ``by``, in ``order`` (which
    should be total inside a group).

    Rows are range-partitioned by (``by``, ``order``), so that a group of any
    size covers as many partitions as it needs, and written once. A group then
    has rows in two partitions only if it is the last one of the first and the
    first one of the next; each partition therefore carries one offset, held in
    a table of one row per partition. No join on the group, and beside the
    range exchange only the one that numbers inside (partition, group).
    """
    by = list(by)
    placed = placed_in_order(df, [*[F.col(c).asc() for c in by], *order], partitions)
    group = F.struct(*by)
    ends = placed.groupBy("_part").agg(F.min(group).alias("_head"), F.max(group).alias("_tail"))
    # One row per partition, here and below.
    tails = placed.join(F.broadcast(ends), "_part").groupBy("_part").agg(
        F.first("_head").alias("_head"), F.first("_tail").alias("_tail"),
        F.count_if(group.eqNullSafe(F.col("_tail"))).alias("_n"))
    in_row = Window.orderBy("_part")
    so_far = F.sum("_n").over(Window.partitionBy("_tail").orderBy("_part"))
    before = tails.withColumn("_sum", so_far).select(
        "_part", "_head", F.when(F.lag("_tail").over(in_row).eqNullSafe(F.col("_head")), F.lag("_sum").over(in_row))
        .otherwise(0).alias("_carry"))
    local = F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order))
    offset = F.when(group.eqNullSafe(F.col("_head")), F.col("_carry")).otherwise(0)
    return (placed.withColumn("_row", local).join(F.broadcast(before), "_part")
            .select(*df.columns, (F.col("_row") + offset).cast("bigint").alias(out)))


def dense_index(df: DataFrame, order: Sequence[Column], out: str = "index",
                partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the global ``order`` (must be total)."""
    ranked = running_total(df, order, {"_pos": F.lit(1)}, partitions)
    return ranked.withColumn(out, F.col("_pos") - 1).drop("_pos")
