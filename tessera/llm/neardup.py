"""Embedding near-dedup over a robust-pruned flat graph.

Identical vectors become one node. Nodes are dealt to their ``overlap`` nearest
centroids; in each shard a flat graph is built by robust pruning (a neighbour
is dropped if a kept one is closer to it by the factor ``alpha``). A node's
lists from all its shards are united. Searches go in rounds over a table of
visits (node, shard, entry). In a visit the node's search starts from the
shard's medoid and its entry, goes greedily to its own neighbourhood, and from
there over every node within the range (less some slack), until no edge leads
to another one. From there it crosses over: each node reached within the range,
and the nearest one if it is nearer than the entry, sends the search into its
other shards, as their entry (of the nearest ones of a round, the best goes on).
Rounds end when no search has a shard left to visit.

Every node has one home, its slice of its nearest shard. A pair counts only in
the lesser of its two homes, for both its ends, and a pair found elsewhere sends
the search there; so each pair counts once, and links and components use the
same pairs. All links are verified in double precision, and recall is audited
by brute force on a fixed number of nodes against all nodes: a node's recall is
the share of its links that were found, and the worst mean of a class of nodes
with about as many links counts, so that large groups do not hide lost pairs.
If it falls short, the overlap is doubled, up to four times the first one; if
that does not suffice, all nodes are compared with one another in blocks.

The centroids come from a bounded sample and number ``max_centroids`` at most.
A shard above ``shard_rows`` is cut into slices, a visit goes to all of them,
and visitors are dealt in lots, so that no task holds more than about a slice
and a lot and no visit is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import hash_order, pin
from tessera.llm.components import connected_components

#: Single precision is off by less than this; what it lets through is verified.
MARGIN = 1e-5


def unit_vector(values) -> np.ndarray | None:
    """The vector over its length; None if it is null, empty, zero, or holds
    null or non-finite components."""
    if values is None:
        return None
    x = np.array([np.nan if v is None else v for v in values], np.float64)
    if not len(x) or not np.isfinite(x).all() or not (top := np.abs(x).max()):
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        made = [unit_vector(v) for v in pdf["v"]]
        yield pd.DataFrame({"id": pdf["id"], "unit": [None if u is None else (u + 0.0).tolist() for u in made]})


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids of unit vectors by cosine, started from evenly spaced rows."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = np.concatenate([(x[s:s + 4096] @ c.T).argmax(axis=1) for s in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 0, sums / np.maximum(norm, 1e-12), c).astype(x.dtype)
    return c


def robust_prune(x: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbour numbers of every row of ``x``, ``degree`` columns, -1 for none.

    All rows at once: each takes its nearest candidate, then drops the
    candidates that are closer to that one by ``alpha`` than to the row."""
    n = len(x)
    dist = np.maximum(1.0 - x @ x.T, 0.0)
    left = dist.copy()
    np.fill_diagonal(left, np.inf)
    out, rows = np.full((n, min(degree, max(n - 1, 0))), -1), np.arange(n)
    for k in range(out.shape[1]):
        best = left.argmin(axis=1)
        open_ = left[rows, best] < np.inf
        if not open_.any():
            break
        out[open_, k] = best[open_]
        left[alpha * dist[best] <= dist] = np.inf
        left[rows, best] = np.inf
    return out


def connect(near: np.ndarray, x: np.ndarray, start: list[int]) -> np.ndarray:
    """Link rows that ``start`` does not reach to their nearest reached row."""
    near = near | near.T
    seen = np.zeros(len(x), bool)
    seen[start] = True
    front = seen
    while not seen.all():
        while front.any():
            front = near[front].any(axis=0) & ~seen
            seen = seen | front
        if not seen.all():
            a, b = np.flatnonzero(~seen), np.flatnonzero(seen)
            sims = x[a] @ x[b].T
            p, q = np.unravel_index(sims.argmax(), sims.shape)
            near[a[p], b[q]] = near[b[q], a[p]] = True
            front = np.zeros(len(x), bool)
            front[a[p]] = True
            seen = seen | front
    return near


def graph_search(q: np.ndarray, x: np.ndarray, near: np.ndarray, start: list[int], entry: np.ndarray, reach: float,
                 beam: int = 24, block: int = 256) -> np.ndarray:
    """Cosines of the rows of ``q`` (one each) with the rows of ``x`` that their
    searches compare, -2 elsewhere, in single precision: ``beam`` greedy steps
    from ``start`` and the row's ``entry`` (-1: none), then an expansion over
    all rows found at ``reach`` or more."""
    n, asked, single, weight = len(x), q.astype(np.float32), x.astype(np.float32), near.astype(np.float32)
    out = np.full((len(q), n), -2.0, np.float32)
    for s in range(0, len(q), block):
        sims, part = out[s:s + block], asked[s:s + block]
        done, rows = np.zeros(sims.shape, bool), np.arange(len(part))

        def visit(new: np.ndarray) -> None:
            a, b = np.nonzero(new)
            sims[a, b] = np.einsum("ij,ij->i", part[a], single[b])  # noqa: B023

        first, e = np.zeros(sims.shape, bool), entry[s:s + block]
        first[:, start] = True
        first[rows[e >= 0], e[e >= 0]] = True
        visit(first)
        for _ in range(beam):
            best = np.where(done, -2.0, sims).argmax(axis=1)
            if done[rows, best].all() or (sims[rows, best] == -2.0).all():
                break
            done[rows, best] = True
            visit(near[best] & (sims == -2.0))
        while (front := (sims >= reach) & ~done).any():
            done |= front
            cols = np.flatnonzero(front.any(axis=0))
            visit((front[:, cols].astype(np.float32) @ weight[cols] > 0) & (sims == -2.0))
    return out


def verified(q: np.ndarray, x: np.ndarray, sims: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the compared pairs are within the range, in double precision."""
    found = np.zeros(sims.shape, bool)
    a, b = np.nonzero(sims >= threshold - MARGIN)
    for t in range(0, len(a), 1 << 18):
        i, j = a[t:t + (1 << 18)], b[t:t + (1 << 18)]
        found[i, j] = np.einsum("ij,ij->i", q[i], x[j]) >= threshold
    return found


def exact_search(x: np.ndarray, threshold: float, block: int = 256) -> np.ndarray:
    """All pairs of rows within the range, as a symmetric boolean matrix."""
    single = x.astype(np.float32)
    found = np.concatenate([verified(x[s:s + block], x, single[s:s + block] @ single.T, threshold)
                            for s in range(0, len(x), block)])
    np.fill_diagonal(found, False)
    return found | found.T


def _trees(found: np.ndarray) -> list[tuple[int, int]]:
    """A star per connected group of rows."""
    out, todo = [], found.any(axis=1)
    while todo.any():
        root = int(todo.argmax())
        front = np.zeros(len(found), bool)
        front[root] = True
        seen = front
        while front.any():
            front = found[front].any(axis=0) & ~seen
            seen = seen | front
        out += [(root, int(k)) for k in np.flatnonzero(seen) if k != root]
        todo = todo & ~seen
    return out


def _build(degree: int, alpha: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = pdf["node"].to_numpy()
        near = robust_prune(np.array(pdf["unit"].tolist(), np.float32), degree, alpha)
        return pd.DataFrame({"node": nodes, "near": [nodes[r[r >= 0]].tolist() for r in near]})

    return run


#: What a visit returns: ``(a, null, n)`` links of a node, ``(a, b)`` a tree's
#: edge, ``(a, b, shard, sim)`` a shard that ``a`` is to visit and its entry ``b``.
VISITED = "a bigint, b bigint, n bigint, shard int, sim float"
TYPES = {"a": "Int64", "b": "Int64", "n": "Int64", "shard": "Int32", "sim": "float32"}


def _cell(shard, slice_):
    return shard * (1 << 32) + slice_


def _visit(threshold: float, slack: float):
    def run(key: tuple, held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(asking):
            return pd.DataFrame(columns=list(TYPES)).astype(TYPES)
        held, asking = (f.sort_values("node", ignore_index=True) for f in (held, asking))
        shard, cell = int(key[0]), _cell(int(key[0]), int(key[1]))
        nodes, x = held["node"].to_numpy(), np.array(held["unit"].tolist(), np.float64)
        who, q = asking["node"].to_numpy(), np.array(asking["unit"].tolist(), np.float64)
        place = {v: k for k, v in enumerate(nodes.tolist())}
        near = np.zeros((len(x), len(x)), bool)
        for k, others in enumerate(held["near"]):
            near[k, [place[o] for o in (others if others is not None else ()) if o in place]] = True
        start = [int((x @ x.mean(axis=0)).argmax())]  # the medoid
        entry = np.array([place.get(e, -1) for e in asking["entry"]])
        sims = graph_search(q, x, connect(near, x, start), start, entry, threshold - slack)
        _, p, r = np.intersect1d(who, nodes, assume_unique=True, return_indices=True)
        sims[p, r] = -2.0  # itself
        found = verified(q, x, sims, threshold)
        found[np.ix_(p, r)] |= found[np.ix_(p, r)].T
        # A pair counts in the lesser home, for both ends.
        at, home = held["home"].to_numpy(), asking["home"].to_numpy()
        owned = found & (at == cell) & (home >= cell)[:, None]
        links = [(who, owned @ held["copies"].to_numpy()),
                 (nodes, asking["copies"].to_numpy()[home > cell] @ owned[home > cell])]
        out = [pd.DataFrame({"a": ids[n > 0], "n": n[n > 0]}) for ids, n in links]
        if owned.any():
            names, where = np.unique(np.r_[who, nodes], return_inverse=True)
            a, b = np.nonzero(owned)
            both = np.zeros((len(names), len(names)), bool)
            both[where[a], where[len(who) + b]] = both[where[len(who) + b], where[a]] = True
            trees = names[np.array(_trees(both), np.int64)]
            out.append(pd.DataFrame({"a": trees[:, 0], "b": trees[:, 1]}))
        # Crossing over: to the other shards of what was reached, and found nodes to the visitor's home.
        cross, rows = sims >= threshold - slack, np.arange(len(q))
        best = sims.argmax(axis=1)
        cross[rows, best] |= sims[rows, best] > asking["best"].to_numpy()
        out += _onward(np.array(held["shards"].tolist()), shard, who, nodes, np.where(cross, sims, -2.0))
        back = np.where(found & (home[:, None] < at), sims, -2.0)
        out += _onward((home >> 32)[:, None], shard, nodes, who, back.T)
        return pd.concat([f.reindex(columns=list(TYPES)).astype(TYPES) for f in out])

    return run


def _onward(shards: np.ndarray, here: int, who: np.ndarray, reached: np.ndarray, sims: np.ndarray) -> list[pd.DataFrame]:
    """For each row of ``sims`` and each shard of the columns above -2: the nearest such column as entry."""
    used, out = np.flatnonzero((sims > -2.0).any(axis=0)), []
    pairs = np.array([np.repeat(used, shards.shape[1]), shards[used].ravel()])
    pairs = pairs[:, pairs[1] != here]
    pairs = pairs[:, np.argsort(pairs[1], kind="stable")]
    to, first = np.unique(pairs[1], return_index=True)
    for s, cols in zip(to, np.split(pairs[0], first[1:])):
        k = sims[:, cols].argmax(axis=1)
        top = sims[np.arange(len(who)), cols[k]]
        hit = top > -2.0
        out.append(pd.DataFrame({"a": who[hit], "b": reached[cols[k]][hit], "shard": s, "sim": top[hit]}))
    return out


def _found_rows(nodes: np.ndarray, found: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    hit = np.flatnonzero(n)
    trees = np.array(_trees(found), np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": np.r_[nodes[hit], nodes[trees[:, 0]]],
                         "b": pd.array([None] * len(hit) + nodes[trees[:, 1]].tolist(), "Int64"),
                         "n": np.r_[n[hit], np.zeros(len(trees), np.int64)]})


def _compare(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        side, found = pdf["slice"].to_numpy(), exact_search(np.array(pdf["unit"].tolist(), np.float64), threshold)
        if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
            found &= side[:, None] != side[None, :]
        return _found_rows(pdf["node"].to_numpy(), found, found @ pdf["copies"].to_numpy())

    return run


def _centroids(nodes: DataFrame, k: int, seed: int) -> np.ndarray:
    """Fitted on a bounded sample: 16 vectors each, 16,384 at least."""
    sample = nodes.orderBy(hash_order(F.col("node"), seed), "node").limit(max(16384, 16 * k)).select("unit").toPandas()
    x = np.array(sample["unit"].tolist(), np.float32)
    return kmeans(x, min(k, len(x)))


def _assign(nodes: DataFrame, centroids: np.ndarray, overlap: int) -> DataFrame:
    """Add ``shards``, the nearest centroids of each node, nearest first."""
    shared = nodes.sparkSession.sparkContext.broadcast(centroids)
    k = min(overlap, len(centroids))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        for pdf in batches:
            if len(pdf):
                sims = np.array(pdf["unit"].tolist(), np.float32) @ c.T
                top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                order = np.argsort(-np.take_along_axis(sims, top, axis=1), axis=1, kind="stable")
                yield pdf.assign(shards=np.take_along_axis(top, order, axis=1).tolist())

    return nodes.mapInPandas(run, "node bigint, copies bigint, unit array<double>, shards array<int>")


def _links(nodes: DataFrame, n: int, threshold: float, overlap: int, shard_rows: int, max_centroids: int, degree: int,
           alpha: float, seed: int, slack: float = 0.1) -> DataFrame:
    """``(a, b, n)``: links of a node where ``b`` is null, else a tree's edge."""
    k = max(1, min(max_centroids, ceil(n * overlap / (0.6 * shard_rows))))
    placed = pin(_assign(nodes, _centroids(nodes, k, seed), overlap))
    # One row per centroid.
    slices = pin(placed.select(F.explode("shards").alias("shard")).groupBy("shard")
                 .agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("slices")))
    slot = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
    homed = (placed.withColumn("shard", F.col("shards")[0]).join(F.broadcast(slices), "shard")
             .withColumn("home", _cell(F.col("shard").cast("bigint"), slot)).drop("shard", "slices"))
    members = homed.withColumn("shard", F.explode("shards")).join(F.broadcast(slices), "shard").withColumn("slice", slot)
    built = (members.select("shard", "slice", "node", "unit").groupBy("shard", "slice")
             .applyInPandas(_build(degree, alpha), "node bigint, near array<bigint>"))
    graph = built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    linked = pin(homed.join(graph, "node", "left"))

    visits = linked.select("node", F.explode("shards").alias("shard"), F.lit(None).cast("bigint").alias("entry"),
                           F.lit(-2.0).cast("float").alias("best"))
    been, results = visits.select("node", "shard"), None
    while True:
        lots = F.broadcast(visits.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("lots"))
                           .join(slices, "shard"))
        held = (linked.withColumn("shard", F.explode("shards")).join(lots, "shard").withColumn("slice", slot)
                .withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))))
        asking = (visits.join(linked.select("node", "copies", "unit", "home"), "node").join(lots, "shard")
                  .withColumn("lot", F.pmod(F.xxhash64("node"), F.col("lots")).cast("int"))
                  .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))))
        cells, row = ["shard", "slice", "lot"], ["node", "copies", "unit", "home"]
        there, here = cells + row + ["shards", "near"], cells + row + ["entry", "best"]
        # toDF: both sides come from one table, so their columns need names of their own.
        got = pin(held.select(*there).toDF(*there).groupBy(*cells).cogroup(asking.select(*here).toDF(*here).groupBy(*cells))
                  .applyInPandas(_visit(threshold, slack), VISITED))
        links = got.where("shard is null").select("a", "b", "n")
        results = links if results is None else results.unionAll(links)
        # All moves within the range, and each search's one nearest step beyond it.
        moves = (got.where("shard is not null").groupBy(F.col("a").alias("node"), "shard")
                 .agg(F.max_by("b", F.struct("sim", "b")).alias("entry"), F.max("sim").alias("sim"))
                 .withColumn("best", F.max("sim").over(Window.partitionBy("node"))))
        visits = pin(moves.where((F.col("sim") >= threshold - slack) | (F.col("sim") == F.col("best"))).drop("sim")
                     .join(been, ["node", "shard"], "left_anti"))
        if visits.isEmpty():
            return results
        been = been.unionAll(visits.select("node", "shard"))


def _exact_links(nodes: DataFrame, n: int, threshold: float, shard_rows: int) -> DataFrame:
    """As ``_links``, from all nodes compared with one another: slices that meet in pairs."""
    slices = max(1, ceil(n / shard_rows))
    cut = nodes.withColumn("slice", F.pmod(F.xxhash64("node"), F.lit(slices)).cast("int"))
    tiles = (cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
             .select(F.least("slice", "other").alias("i"), F.greatest("slice", "other").alias("j"), "slice", "node", "copies", "unit"))
    return tiles.groupBy("i", "j").applyInPandas(_compare(threshold), "a bigint, b bigint, n bigint")


def audit_nodes(nodes: DataFrame, counts: DataFrame, threshold: float, queries: int, seed: int) -> list[tuple[int, int]]:
    """Links found and true links of each of ``queries`` nodes, compared with all nodes by brute force."""
    sample = nodes.orderBy(hash_order(F.col("node"), seed + 1), "node").limit(queries).select("node", "unit").toPandas()
    shared = nodes.sparkSession.sparkContext.broadcast((sample["node"].to_numpy(), np.array(sample["unit"].tolist(), np.float64)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q = shared.value
        total = np.zeros(len(ids), np.int64)
        for pdf in batches:
            if len(pdf):
                hit = np.array(pdf["unit"].tolist(), np.float64) @ q.T >= threshold
                hit &= pdf["node"].to_numpy()[:, None] != ids[None, :]
                total += pdf["copies"].to_numpy() @ hit
        yield pd.DataFrame({"node": ids, "n": total})

    true = nodes.mapInPandas(run, "node bigint, n bigint").groupBy("node").agg(F.sum("n").alias("true"))
    got = true.join(counts, "node", "left").select(F.coalesce("n", F.lit(0)).alias("found"), "true")
    return [(int(r["found"]), int(r["true"])) for r in got.collect()]  # one row per query


def audit(nodes: DataFrame, counts: DataFrame, threshold: float, queries: int, seed: int) -> tuple[int, int]:
    """Links found and true links of the audited nodes together."""
    audited = audit_nodes(nodes, counts, threshold, queries, seed)
    return sum(found for found, _ in audited), sum(true for _, true in audited)


def worst_recall(audited: list[tuple[int, int]]) -> float:
    """The least mean recall of a class: audited nodes with 1, 2 to 3, 4 to 7, ... true links."""
    classes: dict[int, list[float]] = {}
    for found, true in audited:
        if true:
            classes.setdefault(true.bit_length(), []).append(found / true)
    return min((sum(c) / len(c) for c in classes.values()), default=1.0)


def near_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9,
                overlap: int = 3, shard_rows: int = 1200, max_centroids: int = 4096, degree: int = 24, alpha: float = 1.2,
                audit_queries: int = 1024, least_recall: float = 0.95, seed: int = 17) -> DataFrame:
    """One row per row: ``id, n_links, component``: the number of other vectors
    at cosine ``threshold`` or more and the smallest id that links reach.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing; their component is their id. Vectors of different
    lengths do not link. Identical vectors link with one another and share
    their links. Rows with a null id link with nothing and have a null
    component. Rows that repeat an id and a vector are linked vectors. Other
    columns are not read. No rows give no rows.
    """
    raw = vectors.select(vectors[id_col].cast("bigint").alias("id"), vectors[vector_col].cast("array<double>").alias("v"))
    rows = pin(raw.mapInPandas(_units, "id bigint, unit array<double>"))
    usable = rows.where("id is not null and unit is not null")
    nodes = pin(usable.groupBy("unit").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
                .select("node", "copies", "unit"))
    counts = edges = None
    for r in nodes.groupBy(F.size("unit").alias("d")).count().orderBy("d").collect():  # vector lengths: mostly one
        own, wide = nodes.where(F.size("unit") == r["d"]), overlap
        while True:
            got = pin(_links(own, r["count"], threshold, wide, shard_rows, max_centroids, degree, alpha, seed))
            n = got.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
            if worst_recall(audit_nodes(own, n, threshold, audit_queries, seed)) >= least_recall:
                break
            if wide >= 4 * overlap:
                got = pin(_exact_links(own, r["count"], threshold, shard_rows))
                n = got.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
                break
            wide *= 2
        links = got.where("b is not null").select("a", "b")
        counts, edges = (n, links) if counts is None else (counts.unionAll(n), edges.unionAll(links))
    if counts is None:
        return rows.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    groups = connected_components(edges)
    named = pin(nodes.join(counts, "node", "left").join(groups, "node", "left")
                .select("unit", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
                        F.coalesce("component", "node").alias("component")))
    joined = rows.join(named.withColumnRenamed("unit", "u"), (rows["unit"] == F.col("u")) & rows["id"].isNotNull(), "left")
    return joined.select("id", F.coalesce("n", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component"))
