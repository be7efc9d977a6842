"""Mixing sources to target weights by capped water-filling.

Every source gets its share of the total by weight, at most ``epochs`` times
its own size; what a full source cannot take is shared again by weight until
none is above its limit. A source's target divided by its size is the number
of passes over it: whole passes take all its documents, and the fractional
pass takes documents in a seeded order up to the fraction of its size, so that
each source ends within half a document of its target.

The fractional pass needs one cut key per source, not a rank per document. It
is found by sums over leading bits of the seeded key, so that a source with a
third of all rows is never in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, hash_order, pin, text_of

#: Bits of the seeded key that each refinement of a cut fixes.
STEP_BITS, STEPS = 11, 3


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def source_weights(sources: DataFrame, pattern: tuple[float, ...]) -> DataFrame:
    """Weights by code-point order of ``source``, null last, repeating ``pattern``.

    Numbers the distinct sources (one row each) without a global window: the
    sorted names are numbered inside range partitions and shifted by the row
    counts of the partitions before."""
    order = [F.col("source").isNull().cast("int"), F.col("source")]
    dealt = pin(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    counts = dealt.groupBy("part").count()
    # One row per partition.
    before = counts.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1 + F.col("before")
    weights = F.array(*[F.lit(float(w)) for w in pattern])
    return (dealt.join(F.broadcast(before), "part")
            .withColumn("place", place)
            .select(*sources.columns, F.get(weights, (F.col("place") % len(pattern)).cast("int")).alias("weight")))


def water_fill(sources: DataFrame, total: float, epochs: float, max_rounds: int = 1000) -> DataFrame:
    """Add ``target`` to ``sources(source_size, weight, ...)``: proportional to
    weight, at most ``epochs * source_size``, adding up to ``total`` where the
    limits allow it. Each round clamps every source above its limit at the
    present level; the driver sees the sums of a round, not the sources."""
    cap = F.col("source_size") * F.lit(float(epochs))
    state, level, clamped = sources.withColumn("full", F.lit(False)), 0.0, -1
    for _ in range(max_rounds):
        state = pin(state)
        s = state.agg(F.sum(F.when(F.col("full"), cap).otherwise(0.0)).alias("used"),
                      F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).alias("open"),
                      F.sum(F.col("full").cast("bigint")).alias("n")).first()
        if not s["open"] or s["n"] == clamped:
            break
        clamped, level = s["n"], max(0.0, (total - s["used"]) / s["open"])
        state = state.withColumn("full", F.col("full") | (cap < F.col("weight") * F.lit(level)))
    else:
        raise RuntimeError(f"no feasible targets after {max_rounds} rounds")
    return state.withColumn("target", F.when(F.col("full"), cap).otherwise(F.col("weight") * F.lit(level))).drop("full")


def _cuts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source ``(source, cut_u, cut_id, cut_size, any)``: the last document
    of the fractional pass in seeded order. ``wanted(source, need)``.

    Each step sums sizes by the next bits of the key within the open bucket of
    each source and keeps the bucket in which ``need`` is reached; a source has
    at most 2**STEP_BITS buckets a step, the last bucket a few rows."""
    key = F.col("u")
    open_ = wanted.select(F.col("source").alias("s"), "need", F.lit(0).cast("bigint").alias("prefix"))
    same = F.col("source").eqNullSafe(F.col("s"))
    for step in range(STEPS):
        # The key without its sign has 63 bits.
        left = 63 - STEP_BITS * (step + 1)
        inside = same & (F.shiftright(key, left + STEP_BITS) == F.col("prefix"))
        sums = (rows.join(open_, inside)
                .groupBy("s", "need", F.shiftright(key, left).alias("bucket")).agg(F.sum("size").alias("size")))
        upto = F.sum("size").over(Window.partitionBy("s").orderBy("bucket"))
        sums = sums.withColumn("upto", upto).where(F.col("upto") >= F.col("need"))
        open_ = pin(sums.groupBy("s").agg(F.min(F.struct("bucket", "upto", "size", "need")).alias("b"))
                    .select("s", (F.col("b.need") - F.col("b.upto") + F.col("b.size")).alias("need"),
                            F.col("b.bucket").alias("prefix")))
    inside = same & (F.shiftright(key, 63 - STEP_BITS * STEPS) == F.col("prefix"))
    order = ["u", "id", "size"]
    before = F.sum("size").over(Window.partitionBy("s").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    last = (rows.join(open_, inside).withColumn("before", F.coalesce(before, F.lit(0)))
            # A document belongs to the pass if over half of it lies within the need.
            .withColumn("in", F.col("before") + F.col("size") / 2 <= F.col("need")))
    # Where even the first row of the bucket is out, the cut lies before it.
    first = F.min(F.struct(*order))
    return last.groupBy("s").agg(F.max(F.when(F.col("in"), F.struct(*order))).alias("cut"), first.alias("first")) \
        .select("s", F.coalesce("cut", "first").alias("cut"), F.col("cut").isNotNull().alias("take_cut"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[float, ...] = (1, 2, 3), epochs: int = 3, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """``(rows, sources)``. rows: ``id, source, size, u`` of every row, pinned;
    sources: ``source, source_size, target, whole, cut, take_cut``, written
    below the checkpoint folder, so that its size is known where it is joined."""
    from tessera.session import scratch_path

    spark = docs.sparkSession
    rows = pin(docs.select(docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"),
                           word_count(text_of(docs, text_col)).alias("size"))
               .withColumn("u", F.shiftrightunsigned(hash_order(F.col("id"), seed), 1)))
    sizes = pin(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    filled = water_fill(source_weights(sizes, weights), float(total), epochs)
    passes = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    filled = pin(filled.withColumn("whole", F.least(F.floor(passes + 1e-12), F.lit(epochs)).cast("int"))
                 .withColumn("need", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))))
    part = filled.where("need > 0.5").select("source", "need")
    cuts = _cuts(rows, part)
    sources = filled.join(cuts, filled["source"].eqNullSafe(cuts["s"]), "left").drop("s", "need", "weight")
    path = scratch_path(spark, "mix-sources")
    sources.write.parquet(path)
    return rows, spark.read.parquet(path)


def _copies(whole: Column, cut: Column, take_cut: Column, key: Column) -> Column:
    extra = F.when(cut.isNull(), 0).when((key < cut) | ((key == cut) & take_cut), 1).otherwise(0)
    return whole + extra


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[float, ...] = (1, 2, 3), epochs: int = 3, seed: int = 11) -> DataFrame:
    """One row per row: ``id, size, source_size, target, copies, taken``.

    Size is the number of words; null and empty texts have none and are taken
    for nothing. A null source is a source like others, after all names. Rows
    with a null id share one seeded key; ties in the key are ordered by id and
    size, and identical rows fall on the same side of the cut. Reruns agree,
    as the key depends on id and seed alone. No rows give no rows; a source
    without words has target 0.
    """
    rows, sources = mix_plan(docs, id_col, text_col, source_col, weights, epochs, seed)
    s = sources.withColumnRenamed("source", "s")
    key = F.struct("u", "id", "size")
    copies = _copies(F.col("whole"), F.col("cut"), F.col("take_cut"), key)
    return (rows.join(s, rows["source"].eqNullSafe(s["s"]))
            .select("id", "size", "source_size", "target", copies.alias("copies"),
                    (F.col("size") * copies).alias("taken")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (1, 2, 3), epochs: int = 3, seed: int = 11) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, 0 to
    ``epochs`` times, with all its columns, whatever their names. Texts without
    words are not taken; null ids, null sources, ties and repeated rows are
    treated as by ``mix_counts``. No rows give no rows."""
    _, sources = mix_plan(docs, id_col, text_col, source_col, weights, epochs, seed)
    names = [F.col(f"__r.`{c}`").alias(c) for c in docs.columns]
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__r"),
                       docs[source_col].cast("string").alias("source"),
                       docs[id_col].alias("id"), word_count(text_of(docs, text_col)).alias("size"))
    rows = rows.withColumn("u", F.shiftrightunsigned(hash_order(F.col("id"), seed), 1))
    s = sources.withColumnRenamed("source", "s")
    copies = _copies(F.col("whole"), F.col("cut"), F.col("take_cut"), F.struct("u", "id", "size"))
    return (rows.join(s, rows["source"].eqNullSafe(s["s"])).withColumn("copies", copies).where("copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*names))
