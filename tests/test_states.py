"""Mergeable states, exact top-k by norm, fitted vocabularies, quarantine of bad rows."""

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators import correlate, features, sketch, summary, topk
from tessera.sources import files


# --- states -----------------------------------------------------------------

def test_bitmaps_merge_to_exact_counts(spark):
    rows = [(p, k * k % 1000 - 200, k % 7 or None) for k in range(3000) for p in [k % 5]] + [(9, None, None), (2, 40_000_000_000, 1)]
    df = spark.createDataFrame(rows, "part int, a bigint, b bigint")
    state = sketch.distinct_bitmaps(df, ["a", "b"], ["part"])
    whole = {r["column"]: r["distinct"] for r in sketch.bitmap_counts(state).collect()}
    assert whole == {c: len({r[i] for r in rows} - {None}) for c, i in (("a", 1), ("b", 2))}
    parts = {(r["part"], r["column"]): r["distinct"] for r in sketch.bitmap_counts(state, ["part"]).collect()}
    assert parts == {(p, c): n for p in (0, 1, 2, 3, 4, 9) for c, i in (("a", 1), ("b", 2))
                     if (n := len({r[i] for r in rows if r[0] == p} - {None}))}


def test_sketches_merge_within_their_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 8).alias("part"), F.concat(F.lit("k"), (F.col("id") % 20_011).cast("string")).alias("k"))
    state = sketch.distinct_sketches(df, ["k"], ["part"])
    got = sketch.sketch_counts(state).first()["distinct"]
    assert state.count() == 8 and abs(got - 20_011) <= 20_011 * sketch.sketch_bound()


def test_quantile_states_and_their_audit(spark):
    df = spark.range(50_000).select((F.col("id") % 9).alias("part"), (F.col("id") * 7919 % 50_021).cast("double").alias("x"),
                                    F.when(F.col("id") % 2 == 0, 3.0).alias("y"))
    state = sketch.quantile_state(df, ["x", "y"], ["part"])
    found = sketch.merged_quantiles(state, [0.0, 0.25, 0.5, 1.0])
    audit = {(r["column"], r["probability"]): r for r in sketch.rank_audit(found, df).collect()}
    assert len(audit) == 8 and all(r["within"] for r in audit.values())
    assert audit["x", 0.5]["n"] == 50_000 and audit["y", 0.5]["n"] == 25_000 and (audit["y", 0.25]["below"], audit["y", 0.25]["upto"]) == (0.0, 1.0)
    wrong = found.withColumn("value", F.col("value") + 10_000.0)
    assert not all(r["within"] for r in sketch.rank_audit(wrong, df).collect())


# --- correlation ------------------------------------------------------------

def test_correlation_of_odd_columns(spark):
    rows = [(1.0, 0.1, 2.0, None, 1.0, 1e9 + 1), (2.0, 0.1, float("nan"), None, 2.0, 1e9 + 2), (4.0, 0.1, 1.0, 3.0, None, 1e9 + 4),
            (3.0, 0.1, 0.0, 1.0, None, 1e9 + 3)]
    df = spark.createDataFrame(rows, "a double, const double, nan double, half double, other double, far double").repartition(2)
    got = {(r["col_i"], r["col_j"]): r["r"] for r in summary.correlation_pairs(df, df.columns).collect()}
    assert len(got) == 15 and got["a", "const"] is None and np.isnan(got["a", "nan"])
    assert got["half", "other"] is None  # no row has both
    assert got["a", "far"] == pytest.approx(1.0, abs=1e-9) and got["a", "half"] == pytest.approx(1.0)
    assert summary.correlation_pairs(df.limit(0), df.columns).count() == 0 and summary.correlation_pairs(df, ["a"]).count() == 0


def test_correlation_puts_out_blocks_not_rows(spark, monkeypatch):
    monkeypatch.setattr(correlate, "BLOCK_COLS", 3)
    monkeypatch.setattr(correlate, "BAND_PAIRS", 4)
    x = np.random.default_rng(3).normal(size=(500, 10))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"c{k} double" for k in range(10))).repartition(2)
    got = {(r["i"], r["j"]): r["r"] for r in summary.correlation_pairs(df, df.columns).collect()}
    want = np.corrcoef(x.T)
    assert len(got) == 45 and all(abs(r - want[i, j]) < 1e-9 for (i, j), r in got.items())
    plan = summary.correlation_pairs(df, df.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 3 and "inline" not in plan  # 10 pairs of 4 blocks in bands of 4


# --- top-k ------------------------------------------------------------------

def factors(rng, n, width, spread=1.0):
    x = rng.normal(size=(n, width)) * np.exp(spread * rng.normal(size=(n, 1)))
    return x.astype(np.float32)


def brute(users, items, k):
    out = []
    for u in users.astype(float):
        s = items.astype(float) @ u
        out.append(sorted(range(len(items)), key=lambda j: (-s[j], j))[:k])
    return out


@pytest.mark.parametrize("group, block", [(1 << 24, 512), (400, 16), (64, 3)])
def test_top_k_equals_brute_force(spark, monkeypatch, group, block):
    monkeypatch.setattr(topk, "BLOCK_ITEMS", block)
    rng = np.random.default_rng(1)
    u, v = factors(rng, 70, 8), factors(rng, 300, 8)
    v[17] = v[4]  # a tie
    u[3] = 0.0
    frame = lambda x: spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x)], "id int, features array<float>").repartition(3)
    got = {r["id"]: r for r in topk.top_k_by_norm(frame(u), frame(v), 5, group).collect()}
    assert [got[k]["items"] for k in range(70)] == brute(u, v, 5)
    if block < 512:
        assert sum(r["scored"] for r in got.values()) < 0.6 * 70 * 300
    few = topk.top_k_by_norm(frame(u[:2]), frame(v[:3]), 5).collect()
    assert all(len(r["items"]) == 3 for r in few) and topk.top_k_by_norm(frame(u), frame(v).limit(0), 5).count() == 0


def test_top_k_fetches_no_group_behind_the_last_open_user(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ITEMS", 8)
    monkeypatch.setattr(topk, "FIRST_NUMBERS", 160, raising=False)
    sizes, run = [], topk._pass
    monkeypatch.setattr(topk, "_pass", lambda state, group, *a: sizes.append(len(group)) or run(state, group, *a))
    rng = np.random.default_rng(2)
    u, v = rng.normal(size=(30, 4)), rng.normal(size=(500, 4))
    v[:40] *= 100.0
    frame = lambda x: spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x)], "id int, features array<float>")
    got = {r["id"]: r["items"] for r in topk.top_k_by_norm(frame(u.astype(np.float32)), frame(v.astype(np.float32)), 5).collect()}
    assert [got[k] for k in range(30)] == brute(u.astype(np.float32).astype(float), v.astype(np.float32).astype(float), 5)
    assert sizes == [40]


def test_top_k_sorts_few_scores_of_a_block(monkeypatch):
    rng, sorted_, lexsort = np.random.default_rng(3), [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys, *a, **b: sorted_.append(np.size(keys[0])) or lexsort(keys, *a, **b))
    u, v = rng.normal(size=(50, 4)), rng.normal(size=(512, 4))
    v[100:110] = v[90]  # ties
    held = topk.Lists(u, 5)
    held.visit(np.arange(512, dtype=np.int32), v, float(np.linalg.norm(v, axis=1).max()))
    assert held.items.tolist() == brute(u, v, 5) and sum(sorted_) < 50 * 40


# --- fitted vocabulary ------------------------------------------------------

@pytest.mark.parametrize("unseen", ["skip", "keep"])
def test_index_of_another_frame_equals_stringindexer(spark, unseen):
    train = spark.createDataFrame([(v,) for v in "b a c a b d e e c f".split()], "g string")
    test = spark.createDataFrame([(k, v) for k, v in enumerate(["a", "zz", None, "f", "b", "zz"])], "k int, g string")
    vocab = features.fit_index(train, "g", "index", 3)
    ours = {(r["k"], r["i"]) for r in features.apply_index(test, vocab, "g", "i", unseen).collect()}
    ml = StringIndexer(inputCol="g", outputCol="i", handleInvalid=unseen).fit(train).transform(test)
    assert ours == {(r["k"], r["i"]) for r in ml.collect()}


def test_index_of_an_unseen_value_is_an_error(spark):
    train = spark.createDataFrame([("a",), ("b",), ("a",)], "g string")
    vocab = features.fit_index(train, "g")
    assert {r["index"] for r in features.apply_index(train, vocab, "g").collect()} == {0.0, 1.0}
    for bad, name in (("zz", "zz"), (None, "null")):
        df = spark.createDataFrame([("a",), (bad,)], "g string")
        with pytest.raises(Exception, match=f"not in the fitted index of g: {name}"):
            features.apply_index(df, vocab, "g").collect()
    with pytest.raises(ValueError):
        features.apply_index(train, vocab, "g", unseen="drop")


# --- quarantine -------------------------------------------------------------

def test_quarantine_names_each_fault(spark, tmp_dir):
    lines = ["a,b,c", "x,1,2.5", "y,2", "z,3,1.0,more", "z,3,1.0,", "w,one,1.0", "v,4,1e", ",5,", '"q,r",6,7.0', "", "u,,"]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/t")
    good, bad = files.read_quarantined(spark, f"{tmp_dir}/t", StructType.fromDDL("a string, b int, c double"), ",", header=True)
    assert sorted(map(str, map(tuple, good.collect()))) == sorted(map(str, [("x", 1, 2.5), (None, 5, None), ("q,r", 6, 7.0), ("u", None, None)]))
    assert sorted(map(tuple, bad.collect())) == sorted([
        ("y,2", "missing field"), ("z,3,1.0,more", "extra field"), ("z,3,1.0,", "extra field"), ("w,one,1.0", "unparsable b"),
        ("v,4,1e", "unparsable c"), ("", "missing field")])
    counts = {r["reason"]: r["rows"] for r in files.quarantine_counts(good, bad).collect()}
    assert counts == {"ok": 4, "missing field": 2, "extra field": 2, "unparsable b": 1, "unparsable c": 1}
    assert good.select("b").count() == 4 and bad.select("reason").count() == 6  # fewer columns, same faults


def test_positions_follow_the_sort(spark):
    df = spark.createDataFrame([(k % 3 or None, k * 7 % 10, k) for k in range(50)], "a int, b int, k int").repartition(5)
    keys = [F.col("a").desc_nulls_last(), F.col("b").asc(), F.col("k").asc()]
    got = summary.positions(summary.order_rows(df, *keys)).orderBy("position").collect()
    want = sorted(((k % 3 or None, k * 7 % 10, k) for k in range(50)), key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))
    assert [tuple(r)[:3] for r in got] == want and [r["position"] for r in got] == list(range(1, 51))
