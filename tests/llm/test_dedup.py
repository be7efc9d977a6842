"""Exact, SimHash and embedding dedup against brute force, with edge cases."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import exactdedup, neardup, simhash
from tessera.llm.components import connected_components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, extra string"


def roots(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    return [root(x) for x in range(n)]


# --- components -------------------------------------------------------------

def test_components_chain_star_and_loops(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in
           connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {200: 200, 201: 200}
    assert got == want


def test_components_empty(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- exact ------------------------------------------------------------------

ROWS = [(1, "a b", "x"), (2, "ab ", None), (3, "a\tb\n", "z"), (4, None, "x"), (5, "", "y"), (6, " \x0b\x0c\r", "y"),
        (7, "a b", "x"), (8, "a b", "x"), (None, "only", "n"), (9, "é" * 5, "q"), (9, "é" * 5, "q"), (10, "A b", "x")]


def exact_brute(rows):
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(strip(t), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t, _ in rows:
        first = min(groups[strip(t)], key=lambda x: (x[0], x[1], x[2] or 0))
        out.append((i, first[2], len(groups[strip(t)]), i == first[2] and len(t or "") == -first[0],
                    hashlib.sha256(strip(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("content_hash", [F.md5, lambda c: F.substring(F.md5(c), 1, 1), lambda c: F.lit("same")])
def test_exact_groups_even_where_hashes_collide(spark, content_hash):
    got = exactdedup.exact_groups(spark.createDataFrame(ROWS, DOCS), content_hash=content_hash)
    assert sorted(map(tuple, got.collect()), key=str) == exact_brute(ROWS)


def test_exact_dedup_keeps_rows_and_names(spark):
    df = spark.createDataFrame(ROWS, DOCS).withColumnRenamed("extra", "norm")
    got = exactdedup.exact_dedup(df, content_hash=lambda c: F.lit("same"))
    assert got.columns == ["doc_id", "text", "norm"]
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect())
    assert [i for none, i in ids if not none] == [3, 6, 7, 9, 10] and ids[-1][0]


def test_exact_empty(spark):
    df = spark.createDataFrame([], DOCS)
    assert exactdedup.exact_groups(df).count() == 0 and exactdedup.exact_dedup(df).count() == 0


# --- simhash ----------------------------------------------------------------

def brute_fingerprint(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[k:k + n]) for k in range(len(w) - n + 1)] or [" ".join(w)]
    values = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


@pytest.mark.parametrize("text", [None, "", " \t", "One", "one TWO", "a b c", "É b C d é", "x y z " * 7, "a b c\x1fd e",
                                  " ".join(f"w{k}" for k in range(500))])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_of_long_text_does_not_depend_on_chunks(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == whole


def test_fingerprint_matches_spark_xxhash64(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b ç")).alias("h")).first()["h"]
    assert got % (1 << 64) == xxhash.xxh64_intdigest("a b ç".encode(), seed=42)


def test_bk_tree_finds_all_and_prunes():
    rng = np.random.default_rng(1)
    values = list(dict.fromkeys(int(v) for v in rng.integers(0, 1 << 12, 400)))
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in range(0, 1 << 12, 37):
        assert sorted(tree.within(q, 2)) == [k for k, v in enumerate(values) if (v ^ q).bit_count() <= 2]
    assert simhash.BKTree().within(5, 3) == []


def cloud(n, seed):
    """Clouds of near fingerprints: some share all blocks but one or lie on both signs."""
    rng = np.random.default_rng(seed)
    out = set()
    for centre in rng.integers(0, 1 << 63, 5, dtype=np.uint64):
        for _ in range(n):
            v = int(centre)
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                v ^= 1 << int(b)
            out.add(v)
    return sorted(out | {0, 1, (1 << 64) - 1, (1 << 63)})


@pytest.mark.parametrize("shard_rows", [1024, 8, 2])
def test_links_are_whole_at_every_shard_size(spark, shard_rows):
    fps = cloud(60, 5)
    signed = [v - (1 << 64) if v >> 63 else v for v in fps]
    nodes = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp bigint, id bigint")
    got = [(r["a"], r["b"]) for r in simhash.links(nodes, 3, shard_rows).collect()]
    assert all((fps[a] ^ fps[b]).bit_count() <= 3 for a, b in got)
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    assert roots(len(fps), got) == roots(len(fps), pairs)


def test_simhash_groups_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (rows[a][1] ^ rows[b][1]).bit_count() <= 3]
    top = roots(len(rows), pairs)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top[k]] = min(i, least.get(top[k], i))
    want = sorted((i, fp, least[top[k]]) for k, (i, fp) in enumerate(rows))
    got = sorted((r["id"], r["fp"] % (1 << 64), r["component"]) for r in simhash.simhash_groups(docs).collect())
    assert got == want


def test_simhash_edges_and_dedup(spark):
    long = " ".join(f"w{k}" for k in range(300))
    rows = [(5, long, "a"), (3, long + " tail", "b"), (9, None, "c"), (8, "", "d"), (None, long, "e"), (None, "lonely words here", "f"),
            (7, "other text that stands alone", "g")]
    df = spark.createDataFrame(rows, DOCS).withColumnRenamed("extra", "component")
    got = {(r["id"], r["component"]) for r in simhash.simhash_groups(df).collect()}
    same = (brute_fingerprint(long) ^ brute_fingerprint(long + " tail")).bit_count() <= 3
    first = 3 if same else 5
    assert got == {(5, first), (3, 3), (9, 8), (8, 8), (None, first), (None, None), (7, 7)}
    kept = simhash.simhash_dedup(df)
    assert kept.columns == ["doc_id", "text", "component"]
    assert {r["component"] for r in kept.collect()} == {"b", "d", "e", "f", "g"} | (set() if same else {"a"})
    assert simhash.simhash_groups(spark.createDataFrame([], DOCS)).count() == 0
    assert simhash.simhash_dedup(spark.createDataFrame([], DOCS)).count() == 0


A, B, C = (" ".join(f"{p}{k}" for k in range(200)) for p in "abc")


@pytest.mark.parametrize("rows, want", [
    ([(1, A), (5, A), (5, B)], [(1, A), (5, B)]),
    ([(1, A), (1, B), (1, C), (2, A), (2, C)], [(1, A), (1, B), (1, C)]),
    ([(5, A), (5, A), (5, A), (7, B)], [(5, A), (7, B)]),
    ([(3, None), (3, ""), (3, " \t"), (4, None)], None),
    ([(2, A)] * 40 + [(9, B)] * 40 + [(None, A), (None, B)], [(2, A), (9, B), (None, A), (None, B)]),
])
def test_simhash_dedup_decides_by_row(spark, rows, want):
    df = spark.createDataFrame([(*r, f"x{k}") for k, r in enumerate(rows)], "doc_id bigint, text string, `__id` string")
    got = simhash.simhash_dedup(df.repartition(3))
    assert got.columns == ["doc_id", "text", "__id"]
    found = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    if want is None:
        assert len(found) == 1 and found[0][0] == 3
    else:
        assert found == sorted(want, key=str)


# --- embeddings -------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int"


def vectors_brute(rows, threshold=0.9):
    units = [neardup.unit_vector(v) if i is not None else None for i, v, *_ in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if units[a] is not None and units[b] is not None
             and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold]
    n = np.zeros(len(rows), int)
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    top, least = roots(len(rows), pairs), {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[top[k]] = min(i, least.get(top[k], i))
    return sorted(((i, int(n[k]), least[top[k]] if i is not None else None) for k, (i, *_) in enumerate(rows)), key=str)


def some_vectors(n, seed, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    out = []
    for k in range(n):
        c = centres[rng.integers(12)]
        noise = rng.normal(size=dim) * rng.choice([0.02, 0.2, 1.0])
        out.append((1000 - k, [float(np.float32(x)) for x in c + noise], 0))
    return out


@pytest.mark.parametrize("shard_rows, overlap", [(1200, 2), (60, 3), (20, 2)])
def test_near_groups(spark, shard_rows, overlap):
    rows = some_vectors(260, 3) + some_vectors(40, 4, dim=5)
    rows = [(i if k < 260 else 5000 + k, v, x) for k, (i, v, x) in enumerate(rows)]
    rows += [(3001, rows[0][1], 1), (3002, [2 * x for x in rows[1][1]], 1), (4001, None, 0), (4002, [], 0), (4003, [0.0] * 16, 0),
             (4004, [float("nan")] * 16, 0), (4005, [float("inf")] + [0.0] * 15, 0), (4006, [None] + [1.0] * 15, 0), (None, rows[0][1], 0)]
    got = neardup.near_groups(spark.createDataFrame(rows, VECTORS), shard_rows=shard_rows, overlap=overlap)
    got, want = sorted(map(tuple, got.collect()), key=str), vectors_brute(rows)
    assert [r[0] for r in got] == [r[0] for r in want]
    true, found = sum(r[1] for r in want), sum(r[1] for r in got)
    assert all(g[1] <= w[1] for g, w in zip(got, want)) and found >= 0.97 * true
    if found == true:
        assert got == want


def test_near_groups_empty_and_unusable(spark):
    assert neardup.near_groups(spark.createDataFrame([], VECTORS)).count() == 0
    got = neardup.near_groups(spark.createDataFrame([(1, None, 0), (2, [0.0], 0)], VECTORS)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1), (2, 0, 2)]


def test_robust_prune_keeps_the_nearest_and_reaches_all():
    x = np.array([v for _, v, _ in some_vectors(120, 9)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = neardup.robust_prune(x.astype(np.float32), 12, 1.2)
    sims = x @ x.T - 2 * np.eye(len(x))
    assert (near[:, 0] == sims.argmax(axis=1)).mean() > 0.98
    graph = np.zeros((120, 120), bool)
    for k, r in enumerate(near):
        graph[k, r[r >= 0]] = True
    joined = neardup.connect(graph, x, [0])
    seen = neardup.graph_search(x, x, joined, [0], np.full(120, -1), 0.8)
    np.fill_diagonal(seen, -2)
    found = neardup.verified(x, x, seen, 0.9)
    assert not (found & ~(sims >= 0.9)).any() and found.sum() >= 0.97 * (sims >= 0.9).sum()


@pytest.mark.parametrize("shard_rows, max_centroids", [(20, 4096), (40, 12)])
def test_searches_cross_shards(spark, monkeypatch, shard_rows, max_centroids):
    """Two shards a node: searches that cross over find what shards alone lose, each pair once, without the all-pairs path."""
    rng = np.random.default_rng(8)
    rows = some_vectors(500, 21) + [(2000 + 2 * k + j, [float(x) for x in p + 0.1 * rng.normal(size=16)], 0)
                                    for k, p in enumerate(rng.normal(size=(60, 16))) for j in (0, 1)]
    nodes = spark.createDataFrame([(i, 1, neardup.unit_vector(v).tolist()) for i, v, _ in rows],
                                  "node bigint, copies bigint, unit array<double>")
    want = {i: n for i, n, _ in vectors_brute(rows)}

    def found():
        got = neardup._links(nodes, len(rows), 0.9, 2, shard_rows, max_centroids, 24, 1.2, 17)
        return {r["a"]: r["n"] for r in got.where("b is null").groupBy("a").agg(F.sum("n").alias("n")).collect()}

    crossing = found()
    assert all(crossing.get(i, 0) <= n for i, n in want.items())
    assert neardup.worst_recall([(crossing.get(i, 0), n) for i, n in want.items()]) >= 0.95
    monkeypatch.setattr(neardup, "_onward", lambda *a: [])
    assert sum(found().values()) < sum(crossing.values()) + (max_centroids < 4096)


def test_audit_counts_true_links(spark):
    rows = some_vectors(80, 11)
    nodes = spark.createDataFrame([(i, 1, neardup.unit_vector(v).tolist()) for i, v, _ in rows],
                                  "node bigint, copies bigint, unit array<double>")
    none = spark.createDataFrame([], "node bigint, n bigint")
    found, true = neardup.audit(nodes, none, 0.9, 1024, 1)
    assert found == 0 and true == sum(r[1] for r in vectors_brute(rows))


def test_large_group_does_not_hide_lost_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    hot, pairs = rng.normal(size=32), rng.normal(size=(30, 32))
    rows = [(k, [float(x) for x in hot + 0.02 * rng.normal(size=32)], 0) for k in range(200)]
    rows += [(1000 + 2 * k + j, [float(x) for x in p + 0.02 * rng.normal(size=32)], 0) for k, p in enumerate(pairs) for j in (0, 1)]
    links = neardup._links
    # A search that never finds the isolated pairs.
    monkeypatch.setattr(neardup, "_links", lambda *a: links(*a).where("a < 1000"))
    got = neardup.near_groups(spark.createDataFrame(rows, VECTORS), shard_rows=60)
    assert sorted(map(tuple, got.collect()), key=str) == vectors_brute(rows)
    assert neardup.worst_recall([(199, 199)] * 200 + [(0, 1)] * 30 + [(0, 0)]) == 0.0 and neardup.worst_recall([(0, 0)]) == 1.0
