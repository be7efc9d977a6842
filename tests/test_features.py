"""Native feature operators against their MLlib counterparts."""

import math

import numpy as np
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from tessera.operators import features, shape, summary


def test_string_index_native_equals_stringindexer(spark):
    vals = ["b", "a", "c", "a", "b", "d", "e", "e", "c", "f"]
    df = spark.createDataFrame([(v,) for v in vals], "g string")
    ours = {r["g"]: r["i"] for r in features.string_index(df, "g", "i", partitions=3).collect()}
    ref = {r["g"]: r["i"] for r in StringIndexer(inputCol="g", outputCol="i").fit(df).transform(df).collect()}
    assert ours == ref


def test_standardize_native_equals_scaler(spark):
    rows = [(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (4.0, 5.0, 9.0), (8.0, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    ours = features.standardize(df, ["a", "b", "c"]).toPandas()
    model = features.fit_scaler(df, ["a", "b", "c"])
    ref = np.array([r["scaled"].toArray() for r in model.transform(df).select("scaled").collect()])
    assert np.allclose(ours[["a", "b", "c"]].to_numpy(), ref)
    assert (ours["b"] == 0.0).all()


def test_correlation_pairs_equal_mllib(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 4))
    x[:, 1] = x[:, 0] * 2 + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "c0 double, c1 double, c2 double, c3 double")
    pairs = {(r["i"], r["j"]): r["r"] for r in summary.correlation_pairs(df, df.columns).collect()}
    vec = VectorAssembler(inputCols=df.columns, outputCol="v").transform(df)
    m = Correlation.corr(vec, "v").head()[0].toArray()
    for (i, j), r in pairs.items():
        assert math.isclose(r, m[i, j], abs_tol=1e-9)


def test_greedy_drop_rule():
    cols = list("abcdef")
    assert summary.columns_to_drop([(0, 1), (1, 2), (2, 3), (0, 4), (4, 5)], cols) == ["b", "d", "e"]
    assert summary.columns_to_drop([], cols) == []


def test_correlation_leaves_out_nulls_per_pair_at_any_width(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 101))
    rows = [[float(v) for v in r] for r in x]
    for k in range(0, 60, 3):
        rows[k][100] = None  # nulls in one unrelated column
    rows[1][0] = None
    wide = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"c{i} double" for i in range(101)))
    narrow = summary.correlation_pairs(wide, ["c0", "c1", "c100"]).where("col_i = 'c0' and col_j = 'c1'").first()["r"]
    full = summary.correlation_pairs(wide, wide.columns).where("i = 0 and j = 1").first()["r"]
    keep = np.arange(60) != 1
    assert math.isclose(narrow, full, abs_tol=1e-12) and math.isclose(full, np.corrcoef(x[keep, 0], x[keep, 1])[0, 1], abs_tol=1e-9)
    assert summary.correlation_pairs(wide, wide.columns).count() == 101 * 100 // 2


def test_quantiles_nulls_ties_and_no_values(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (2.0, None), (None, None), (5.0, None)], "x double, y double")
    got = {(r["column"], r["probability"]): r["value"] for r in summary.quantiles(df, ["x", "y"], [0.0, 0.5, 0.51, 1.0]).collect()}
    assert [got["x", p] for p in (0.0, 0.5, 0.51, 1.0)] == [1.0, 1.0, 2.0, 5.0] and got["y", 0.5] is None
    plan = summary.quantiles(df, ["x"], [0.5])._jdf.queryExecution().toString()
    assert "percentile" not in plan


def test_whole_ranked_lists_and_cut_ones(spark):
    rows = [("hot", f"i{k:04d}", k % 50) for k in range(900)] + [("u", "b", 1), ("u", "a", 1), ("u", "c", 2), (None, "n", 1)]
    df = spark.createDataFrame(rows, "user string, item string, w int")
    for k in (None, 2, 1000):
        got = {}
        for r in summary.ranked_items(df, "user", "item", "w", k).collect():
            got.setdefault(r["user"], {})[r["position"]] = r["item"]
        for user in ("hot", "u", None):
            mine = [i for _, i in sorted((-w, i) for u, i, w in rows if u == user)][:k]
            assert [got[user][p] for p in sorted(got[user])] == mine and sorted(got[user]) == list(range(1, len(mine) + 1))


def test_quantiles_exact_equal_approxquantile_zero(spark):
    df = spark.range(1, 1001).select((F.col("id") * 37 % 1000).cast("double").alias("x"))
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    ours = [r["value"] for r in summary.quantiles(df, ["x"], probs, 0.0).orderBy("probability").collect()]
    assert ours == df.approxQuantile("x", probs, 0.0)


def test_fixed_width_and_quotes(spark):
    line = "ERROR: <SOAAAAAAAAAAAAAAAA TRBBBBBBBBBBBBBBBB> x"
    df = spark.createDataFrame([(line,)], "value string")
    out = shape.extract_fixed(df, "value", {"s": (9, 18), "t": (27, 19)}).first()
    assert out["s"] == "SOAAAAAAAAAAAAAAAA" and out["t"] == "TRBBBBBBBBBBBBBBBB"
    q = shape.strip_quotes(spark.createDataFrame([('"TRX"',)], "id string"), "id").first()
    assert q["id"] == "TRX"


def test_binary_label_null_is_zero_and_weights(spark):
    df = spark.createDataFrame([("Electronic",), ("Rock",), (None,)], "g string")
    assert [r["label"] for r in shape.binary_label(df, "g", "Electronic").collect()] == [1, 0, 0]
    lab = spark.createDataFrame([(0.0,), (9.0,), (18.0,), (3.0,)], "label double")
    w = shape.weight_by_label(lab, "label", {0.3: [0], 5.0: [8, 9], 10.0: [17, 18]}).collect()
    assert [r["weight"] for r in w] == [0.3, 5.0, 10.0, 1.0]
