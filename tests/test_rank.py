"""Distributed ranks equal the single-task window forms."""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.columns import hash_key
import pytest

from tessera.operators.rank import checked_broadcast, dense_index, hash_cuts, numbered_by_hash, numbered_in_order, running_total
from tessera.operators.sample import numbered


def _skewed(spark, n=3000):
    # one hot group holding ~60% of rows, many small ones, and a null group
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 5 < 3, F.lit("hot")).when(F.col("id") % 97 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("g"), (F.col("id") % 41).cast("string"))).alias("grp"))


def test_numbered_by_hash_equals_window(spark):
    df = _skewed(spark).withColumn("h", hash_key(["id"], 7))
    ours = numbered_by_hash(df, ["grp"], "h", "row", "size", target_rows=40)
    w = Window.partitionBy("grp").orderBy("h")
    ref = df.select("id", F.row_number().over(w).alias("row"),
                    F.count(F.lit(1)).over(Window.partitionBy("grp")).alias("size"))
    a = sorted(ours.select("id", "row", "size").collect())
    b = sorted(ref.collect())
    assert a == b
    assert ours.count() == 3000


def test_numbered_same_under_other_partitioning(spark):
    df = _skewed(spark, 1500)
    a = sorted(numbered(df, ["grp"], ["id"], seed=3, target_rows=30).select("id", "row").collect())
    b = sorted(numbered(df.repartition(13), ["grp"], ["id"], seed=3).select("id", "row").collect())
    assert a == b


def test_hot_group_is_split_into_buckets(spark):
    df = _skewed(spark).withColumn("h", hash_key(["id"], 7))
    from tessera.operators import rank
    sizes = df.groupBy("grp").count()
    hot = sizes.where("grp = 'hot'").first()["count"]
    # depth for the hot group at a 40-row target: ceil(log16(hot / 40))
    import math
    assert math.ceil(math.log(hot / 40, 16)) == 2
    out = rank.numbered_by_hash(df, ["grp"], "h", "row", "size", target_rows=40)
    assert out.where("grp = 'hot'").agg(F.max("row")).first()[0] == hot


def test_running_total_matches_pandas(spark):
    df = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("k"), (F.col("id") % 3).alias("v"))
    out = running_total(df, [F.col("k").asc()], {"cum": F.col("v")}, partitions=5).toPandas()
    out = out.sort_values("k").reset_index(drop=True)
    exp = df.toPandas().sort_values("k").reset_index(drop=True)
    assert list(out["cum"]) == list(exp["v"].cumsum())


def test_dense_index_descending_with_ties_broken(spark):
    rows = [("b", 3), ("a", 3), ("c", 1), ("d", 5), ("e", 1)]
    df = spark.createDataFrame(rows, "value string, n long")
    out = dense_index(df, [F.col("n").desc(), F.col("value")], "idx", partitions=3)
    got = {r["value"]: r["idx"] for r in out.collect()}
    assert got == {"d": 0, "a": 1, "b": 2, "c": 3, "e": 4}


def test_running_total_empty(spark):
    df = spark.createDataFrame([], "k long")
    out = running_total(df, [F.col("k")], {"c": F.lit(1)}, partitions=2)
    assert out.count() == 0


@pytest.mark.parametrize("partitions", [1, 2, 7, 64])
def test_numbered_in_order_equals_window(spark, partitions):
    """A hot group over many partitions, small ones between, a null group, partitions without rows."""
    df = _skewed(spark, 1200).withColumn("w", F.col("id") % 13)
    order = [F.col("w").desc(), F.col("id").asc()]
    got = numbered_in_order(df, ["grp"], order, "row", partitions)
    want = df.withColumn("row", F.row_number().over(Window.partitionBy("grp").orderBy(*order)))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_numbered_in_order_of_two_columns_and_edges(spark):
    rows = [("a", 1, 5), ("a", None, 4), ("a", None, 3), (None, None, 1), (None, None, 2), ("b", 2, 9)]
    df = spark.createDataFrame(rows, "g string, h int, x int")
    got = {(r["g"], r["h"], r["x"]): r["n"] for r in numbered_in_order(df, ["g", "h"], [F.col("x").asc()], "n", 5).collect()}
    assert got == {("a", 1, 5): 1, ("a", None, 4): 2, ("a", None, 3): 1, (None, None, 1): 1, (None, None, 2): 2, ("b", 2, 9): 1}
    assert numbered_in_order(df.limit(0), ["g"], [F.col("x").asc()]).count() == 0
    one = spark.range(500).select(F.lit("only").alias("g"), "id")
    assert {(r["id"], r["row"]) for r in numbered_in_order(one, ["g"], [F.col("id").asc()], "row", 9).collect()} == {(k, k + 1) for k in range(500)}


def test_numbering_in_order_needs_two_exchanges_of_the_rows(spark):
    df = _skewed(spark, 300)
    got = numbered_in_order(df, ["grp"], [F.col("id").asc()], "row", 4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The range exchange is behind the checkpoint; the rows are dealt by (_part, group) once more.
    assert "SortMergeJoin" not in plan and len(re.findall(r"hashpartitioning\(_part#\d+, grp", plan)) == 1


@pytest.mark.parametrize("max_rows, step", [(1 << 16, 3), (20, 1), (1, 1), (3, 2)])
def test_cuts_at_any_depth(spark, max_rows, step):
    df = _skewed(spark, 900).withColumn("h", hash_key(["id"], 7))
    got = {r["grp"]: r["cut"]["id"] for r in
           hash_cuts(df, ["grp"], "h", lambda n: F.floor(n * 0.5), ["id"], max_rows=max_rows, step=step).collect()}
    w = Window.partitionBy("grp")
    want = (df.withColumn("row", F.row_number().over(w.orderBy("h", "id"))).withColumn("n", F.count("*").over(w))
            .where("row = floor(n * 0.5)").collect())
    assert got == {r["grp"]: r["id"] for r in want}


def test_cut_among_equal_digests(spark):
    df = spark.range(40).select(F.lit("g").alias("grp"), "id", F.md5(F.lit("x")).alias("h"))
    got = hash_cuts(df, ["grp"], "h", lambda n: F.lit(7), ["id"], max_rows=2, step=3).collect()
    assert [r["cut"]["id"] for r in got] == [6]


def test_broadcast_only_up_to_the_bound(spark):
    left, right = spark.range(100).withColumnRenamed("id", "k"), spark.range(10).checkpoint()
    of = lambda some: left.join(some, left["k"] == some["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in of(checked_broadcast(right, 10)) and "broadcast" not in of(checked_broadcast(right, 9))
