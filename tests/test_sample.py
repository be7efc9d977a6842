"""Splits and resampling: exact sizes, determinism, edge cases."""

from pyspark.sql import functions as F

from tessera.operators import sample


def test_stratified_sizes_and_whole_boundary(spark):
    # 10 rows of label 0 (10*0.8 = 8 is whole -> strict < keeps 7) and 7 of label 1
    rows = [(f"a{i}", 0) for i in range(10)] + [(f"b{i}", 1) for i in range(7)]
    df = spark.createDataFrame(rows, "id string, label int")
    out = sample.stratified_split(df, "label", ["id"], 0.8, seed=1)
    got = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert got[(0, "train")] == 7 and got[(0, "test")] == 3
    assert got[(1, "train")] == 5 and got[(1, "test")] == 2   # row < 5.6 -> 5


def test_random_split_partitions_input_and_is_stable(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    a = sample.random_split(df, ["id"], [0.7, 0.3], seed=5)
    b = sample.random_split(df.repartition(7), ["id"], [0.7, 0.3], seed=5)
    assert sorted(a.collect()) == sorted(b.collect())
    counts = {r["split"]: r["count"] for r in a.groupBy("split").count().collect()}
    assert sum(counts.values()) == 5000
    assert 3300 < counts["train"] < 3700


def test_downsample_keeps_other_classes_and_drops_null_label(spark):
    rows = [(str(i), 0) for i in range(2000)] + [("p", 1), ("q", 1), ("n", None)]
    df = spark.createDataFrame(rows, "id string, label int")
    out = sample.downsample(df, "label", 0, 0.25, ["id"], seed=2)
    labels = [r["label"] for r in out.collect()]
    assert labels.count(1) == 2 and None not in labels
    assert 400 < labels.count(0) < 600


def test_upsample_multiplicity_bounds(spark):
    rows = [(str(i), 1) for i in range(3000)] + [("m", 0), ("x", 2), ("y", None)]
    df = spark.createDataFrame(rows, "id string, label int")
    out = sample.upsample(df, "label", 1, 0, 15, 10 / 15, ["id"], seed=3)
    per = {r["id"]: r["count"] for r in out.groupBy("id").count().collect()}
    assert per.pop("m") == 1
    assert "x" not in per and "y" not in per
    assert all(1 <= v <= 15 for v in per.values())
    mean = sum(per.values()) / 3000.0
    assert 4.0 < mean < 6.0          # Binomial(15, 1/3) averages 5
    assert len(per) < 3000           # a row draws 0 copies with (2/3)^15; some vanish


def test_repair_coverage_moves_share_of_uncovered_users(spark):
    rows = [("u1", f"s{i}", 1, "train") for i in range(3)]
    rows += [("u2", f"s{i}", 1, "test") for i in range(10)]     # uncovered: 10 rows
    rows += [("u3", "s1", 1, "test")]                             # uncovered, 1 row
    rows += [("u1", "s9", 1, "test")]                             # covered
    df = spark.createDataFrame(rows, "user string, item string, plays int, split string")
    out = sample.repair_coverage(df, "user", "item", "split", 0.7, seed=4)
    got = {(r["user"], r["split"]): r["count"] for r in out.groupBy("user", "split").count().collect()}
    assert got[("u2", "train")] == 6 and got[("u2", "test")] == 4   # row < 7.0 -> 6
    assert got[("u3", "test")] == 1 and ("u3", "train") not in got
    assert got[("u1", "test")] == 1
    assert out.count() == len(rows)
    moved = sample.repair_coverage(df, "user", "item", "split", 0.7, seed=4, min_moved=1)
    assert moved.where("user = 'u3' AND split = 'train'").count() == 1
