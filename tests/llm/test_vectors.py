"""Hard negatives and nearest neighbours against brute force in plain Python."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann, hardneg
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def table(rng, n, dim=8, copies=6):
    rows = [(k, [float(v) for v in rng.normal(size=dim)], int(rng.integers(0, 4))) for k in range(n)]
    rows += [(1000 + k, rows[3][1], k % 4) for k in range(copies)]  # equal vectors: ties
    rows += [(2000, None, 1), (2100, [0.0] * dim, 1), (2200, [NAN] + [1.0] * (dim - 1), 1), (2300, [None] + [1.0] * (dim - 1), 2),
             (2400, [INF] + [1.0] * (dim - 1), 2), (2500, [0.5] * dim, None), (2600, [], 3), (2700, [1.0, 2.0], 3),
             (2800, [1.0, 1.0], 3), (2900, [1.5, 1.0], 0), (None, [0.4] * dim, 2), (5, rows[5][1], 1), (-100, [0.1] * dim, 0)]
    return rows


def embeddings(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    return df.withColumn("code", F.lit("clash")).withColumn("score", F.lit(1)).withColumn("rank", F.lit("x"))


# --- hard negatives ---------------------------------------------------------

def test_spanning_tree_is_minimal_and_parents_come_first():
    rng = np.random.default_rng(2)
    x = rng.integers(-20, 20, (30, 3)).astype(float)
    order, parent, edge = hardneg.spanning_tree(x)
    assert sorted(order) == list(range(30)) and parent[0] == -1 and (parent[1:] < np.arange(1, 30)).all()
    assert np.allclose(edge[1:], np.linalg.norm(x[order[1:]] - x[order[parent[1:]]], axis=1))
    links = sorted((math.dist(x[a], x[b]), a, b) for a in range(30) for b in range(a))
    group, total = list(range(30)), 0.0
    for d, a, b in links:
        if group[a] != group[b]:
            total, old = total + d, group[a]
            group = [group[b] if g == old else g for g in group]
    assert np.isclose(edge.sum(), total)


def test_walk_skips_what_its_bounds_rule_out():
    rng = np.random.default_rng(3)
    base = rng.integers(-100, 100, 16)
    anchors = base + rng.integers(-1, 2, (12, 16))  # close anchors: short edges
    order, parent, edge = hardneg.spanning_tree(anchors.astype(float))
    codes = rng.integers(-100, 100, (400, 16)).astype(float)
    tree = hardneg.Tree(np.arange(12), np.arange(12), np.zeros(12), anchors[order].astype(float), parent, edge)
    scored = {}

    def wants(k, low, high):
        exact = codes @ tree.codes[k]
        assert (low <= exact).all() and (exact <= high).all()
        return (high >= 9000) & (low <= 12000)

    hardneg.walk(tree, codes, wants, lambda k, rows, s: scored.setdefault(k, dict(zip(rows.tolist(), s.tolist()))))
    for k in range(12):
        exact = codes @ tree.codes[k]
        inside = {r: int(exact[r]) for r in np.flatnonzero((exact >= 9000) & (exact <= 12000)).tolist()}
        assert inside.items() <= scored.get(k, {}).items()
    assert sum(len(s) for s in scored.values()) < 12 * 400 / 2


def brute_mine(rows, k, m, low, high):
    ok = [(i, label, code) for i, label, code, _ in rows
          if label is not None and code is not None and all(v is not None for v in code)]
    last = lambda i: (i is None, i or 0)
    out = []
    for i, label, code, anchor in rows:
        if not anchor or i is None or (i, label, code) not in ok:
            continue
        scored = [(sum(a * b for a, b in zip(code, c)), j, own) for j, own, c in ok if j != i and len(c) == len(code)]
        scored.sort(key=lambda s: (-s[0], *last(s[1])))
        for p, pid, _ in [s for s in scored if s[2] == label][:k]:
            inside = [s for s in scored if s[2] != label and low * p <= 100 * s[0] <= high * p][:m]
            out += [(i, pid, r, nid, p, n) for r, (n, nid, _) in enumerate(inside, 1)]
    return sorted(out, key=str)


def coded(rows):
    return [(i, label, None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(256 * x) for x in v],
             i is not None and i % 10 == 0) for i, v, label in rows]


@pytest.mark.parametrize("block_rows", [4, 4096])
def test_mine_equals_brute_force(spark, block_rows, monkeypatch):
    monkeypatch.setattr(hardneg, "CELLS", 64)
    rows = coded(table(np.random.default_rng(4), 90))
    df = spark.createDataFrame(rows, "id bigint, label int, code array<bigint>, anchor boolean").withColumn("extra", F.lit(1))
    got = hardneg.mine(df.repartition(3), 3, 4, 30, 90, 100, block_rows)
    assert sorted(map(tuple, got.collect()), key=str) == brute_mine(rows, 3, 4, 30, 90)
    assert len(brute_mine(rows, 3, 4, 30, 90)) > 50


def test_mine_with_large_numbers_and_negative_scores(spark):
    big = 1 << 29
    rows = [(0, 1, [big, big + 1], True), (10, 2, [-3, -4], True), (1, 1, [big, big], False), (2, 2, [big // 2, big // 3], False),
            (3, 0, [big - 7, 0], False), (4, 2, [3, 4], False), (5, 0, [1, 0], False)]
    df = spark.createDataFrame(rows, "id bigint, label int, code array<bigint>, anchor boolean")
    assert sorted(map(tuple, hardneg.mine(df).collect()), key=str) == brute_mine(rows, 5, 10, 30, 90)


def test_mine_without_rows_or_anchors(spark):
    schema = "id bigint, label int, code array<bigint>, anchor boolean"
    assert hardneg.mine(spark.createDataFrame([], schema)).count() == 0
    assert hardneg.mine(spark.createDataFrame([(1, 1, [1], False), (None, 1, [1], True)], schema)).count() == 0


def test_quantised(spark):
    vectors = [([0.5, -0.001, 1e300],), ([None],), ([NAN],), (None,), ([],)]
    got = [r[0] for r in spark.createDataFrame(vectors, "v array<double>").select(hardneg.quantised(F.col("v"))).collect()]
    assert got == [[128, -1, (1 << 63) - 1], None, None, None, []]


# --- nearest neighbours -----------------------------------------------------

def test_estimates_stay_within_their_bounds():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 64))
    x /= ann.norms(x)[:, None]
    codes, f = ann.encode(x, 13)
    assert codes.shape == (4000, 8) and ((f > 0.6) & (f < 0.95)).all()
    q = x[:50]
    about, error = ann.estimate(codes, f, q @ ann.rotation(64, 13), 3.0)
    true = x @ q.T
    assert np.mean(np.abs(about - true) <= error[:, None]) > 0.997
    assert abs((about - true)[100:].mean()) < 1e-3  # unbiased
    eye = ann.rotation(64, 13) @ ann.rotation(64, 13).T
    assert np.allclose(eye, np.eye(64))


def test_reranks_few_rows():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 64))
    x = np.repeat(centres, 100, axis=0) + 0.3 * rng.normal(size=(4000, 64))
    codes, f = ann.encode(x, 13)
    best = ann.Nearest(np.arange(20), x[:20], 5)
    turned = (best.vectors / best.norm[:, None]) @ ann.rotation(64, 13)
    for s in range(0, 4000, 500):
        best.visit(np.arange(s, s + 500), x[s:s + 500], codes[s:s + 500], f[s:s + 500], turned, 3.0)
    assert best.reranked < 20 * 4000 / 5
    unit = x / ann.norms(x)[:, None]
    sims = unit @ unit[:20].T
    sims[np.arange(20), np.arange(20)] = -2
    assert np.mean(np.sort(best.scores, axis=1) >= np.sort(np.sort(sims, axis=0)[-5:].T, axis=1) - 1e-12) >= 0.98


def brute_search(rows, k):
    fits = lambda v: v is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ok = [(i, v) for i, v, _ in rows if fits(v)]
    out = []
    for i, v in ok:
        if i is None or i % 10:
            continue
        cos = lambda w: math.sumprod(v, w) / math.sqrt(math.sumprod(v, v)) / math.sqrt(math.sumprod(w, w))  # noqa: B023, E731
        scored = sorted(((round(cos(w), 12), j) for j, w in ok if j != i and len(w) == len(v)), key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(i, r, j, s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_rows", [3, 2048])
def test_search_equals_brute_force_on_a_small_table(spark, block_rows, monkeypatch):
    monkeypatch.setattr(ann, "CELLS", 64)
    rows = table(np.random.default_rng(7), 80)
    df = embeddings(spark, rows).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"),
                                        (F.col("vec_id") % 10 == 0).alias("query"), "rank")
    got = ann.search(df.repartition(3), 4, 12.0, block_rows)
    assert sorted(((r[0], r[1], r[2], round(r[3], 12)) for r in got.collect()), key=str) == brute_search(rows, 4)


def test_search_with_extreme_numbers_and_few_candidates(spark):
    rows = [(0, [1e300, 1e300], True), (1, [1e-300, 0.0], False), (2, [-1e200, 1e-200], True), (3, [3.0], True)]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>, query boolean")
    got = {(r[0], r[1]): (r[2], round(r[3], 9)) for r in ann.search(df).collect()}
    half = round(math.sqrt(0.5), 9)
    assert got == {(0, 1): (1, half), (0, 2): (2, -half), (2, 1): (0, -half), (2, 2): (1, -1.0)}
    assert ann.search(df.limit(0)).count() == 0 and ann.search(df.where("not query")).count() == 0


def test_recall_on_the_shared_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), (F.col("vec_id") % 50 == 0).alias("query"))
    true = ann.exact(rows)
    assert true.count() == 200 and ann.recall(ann.search(rows), true) >= 0.98
    assert ann.recall(ann.search(rows, epsilon=0.0), true) < 1.0


# --- queries ----------------------------------------------------------------

@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_nearest_neighbours"])
def test_queries_on_odd_rows(spark, tmp_path, name):
    """Nulls, ties, repeated ids and clashing names, against brute force at the contract's parameters."""
    rows = [(None if i is None else 5 * i, v, label) for i, v, label in table(np.random.default_rng(11), 70)]
    embeddings(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES[name](spark, str(tmp_path))
    if name.startswith("op12"):
        marked = [(i, v, label if label is None or i is None or i % 7 else (label + 1) % 10) for i, v, label in rows]
        want = [(i, label, code, i is not None and i % 100 == 0) for i, label, code, _ in coded(marked)]
        assert sorted(map(tuple, got.collect()), key=str) == brute_mine(want, 5, 10, 30, 90)
    else:
        want = [(None if i is None else i // 5, v, label) for i, v, label in rows]
        want = [(5 * q, r, None if j is None else 5 * j, s) for q, r, j, s in brute_search(want, 5)]
        assert sorted(((r[0], r[1], r[2], round(r[3], 12)) for r in got.collect()), key=str) == sorted(want, key=str)


def test_lists_of_a_sliced_batch():
    col = pa.array([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]]).slice(1)
    assert ann.lists(col).tolist() == [[3.0, 4.0], [5.0, 6.0]] and hardneg.numbers(pa.array([[1, 2], [3, 4]]).slice(1), True).tolist() == [[3.0, 4.0]]
