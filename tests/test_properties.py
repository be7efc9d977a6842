"""Property tests: the sampling operators equal a brute-force Python model
built from ``hashlib`` on generated inputs, whatever the partitioning."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.functions.columns import hash_key
from tessera.operators import sample

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

ids = st.lists(st.text(alphabet="abcdefgh0123456789:é ", min_size=1, max_size=6),
               min_size=1, max_size=60, unique=True)


def md5(*parts, seed) -> str:
    text = "".join("n" if p is None else f"{len(str(p))}:{p}" for p in parts)
    return hashlib.md5(f"{text}#{seed}".encode()).hexdigest()


def draw(*parts, seed) -> float:
    return int(md5(*parts, seed=seed)[:8], 16) / 4294967296.0


def test_hash_key_tells_nulls_and_separators_apart(spark):
    rows = [("a", None, "b"), ("a", "b", None), (None, "a", "b"), ("a:b", "c", ""), ("a", "b:c", ""), ("n", "", "1:"), (None, None, None),
            ("", "", ""), ("1:a", "", "")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    got = [r["h"] for r in df.select(hash_key(["x", "y", "z"], 3).alias("h")).collect()]
    assert got == [md5(*r, seed=3) for r in rows] and len(set(got)) == len(rows)


@SETTINGS
@given(ids, st.integers(0, 5), st.integers(1, 9))
def test_random_split_equals_brute_force(spark, keys, seed, parts):
    df = spark.createDataFrame([(k,) for k in keys], "id string").repartition(parts)
    got = {r["id"]: r["split"] for r in sample.random_split(df, ["id"], [0.7, 0.3], seed).collect()}
    assert got == {k: ("train" if draw(k, seed=seed) < 0.7 else "test") for k in keys}


@SETTINGS
@given(ids, st.integers(0, 5))
def test_stratified_split_equals_brute_force(spark, keys, seed):
    rows = [(k, len(k) % 2) for k in keys]
    df = spark.createDataFrame(rows, "id string, label int")
    got = {r["id"]: r["split"] for r in
           sample.stratified_split(df, "label", ["id"], 0.8, seed).collect()}
    expected = {}
    for lab in (0, 1):
        members = sorted((md5(k, seed=seed), k) for k, y in rows if y == lab)
        n = len(members)
        for row, (_, k) in enumerate(members, start=1):
            expected[k] = "train" if row < n * 0.8 else "test"
    assert got == expected


@SETTINGS
@given(ids, st.integers(0, 5))
def test_upsample_multiplicity_equals_brute_force(spark, keys, seed):
    rows = [(k, 1 if k[0] < "d" else 0) for k in keys]
    df = spark.createDataFrame(rows, "id string, label int")
    out = sample.upsample(df, "label", 1, 0, 15, 10 / 15, ["id"], seed)
    got = {r["id"]: r["count"] for r in out.groupBy("id").count().collect()}
    expected = {}
    for k, y in rows:
        m = 1 if y == 0 else sum(draw(k, i, seed=seed) > 10 / 15 for i in range(1, 16))
        if m:
            expected[k] = m
    assert got == expected


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("uvwxyz"), st.integers(0, 30), st.booleans()),
                min_size=1, max_size=60, unique_by=lambda t: (t[0], t[1])), st.integers(0, 3))
def test_repair_coverage_equals_brute_force(spark, triples, seed):
    rows = [(u, f"i{i}", 1, "train" if tr else "test") for u, i, tr in triples]
    df = spark.createDataFrame(rows, "user string, item string, plays int, split string")
    out = sample.repair_coverage(df, "user", "item", "split", 0.7, seed)
    got = {(r["user"], r["item"]): r["split"] for r in out.collect()}
    covered = {u for u, _, _, s in rows if s == "train"}
    expected = {(u, i): s for u, i, _, s in rows}
    for user in {u for u, *_ in rows} - covered:
        mine = sorted((md5(user, i, seed=seed), i) for u, i, _, s in rows if u == user)
        v = len(mine)
        for row, (_, i) in enumerate(mine, start=1):
            expected[(user, i)] = "train" if row < v * 0.7 else "test"
    assert got == expected
    assert len(out.collect()) == len(rows)
