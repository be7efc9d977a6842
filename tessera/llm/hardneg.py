"""Hard-negative mining with bounds along spanning trees of the anchors.

The anchors are a query set, taken in blocks of at most ``block_rows``: a block
with its minimum spanning tree (by distance) is broadcast, and every task runs
through its own rows, so that no candidate is shuffled. The root's scores are
computed; a child's score with a candidate lies within its parent's, plus or
minus the length of their edge times the candidate's norm. Only candidates
whose interval overlaps what is wanted are scored again: first those that may
still be among an anchor's best positives, then those that may still be among
the first negatives inside one of the windows that its positives open.

A task returns at most ``block_rows`` x ``positives`` rows, then at most
``negatives`` rows for each window; the best of them are picked by group.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import pin
from tessera.operators.rank import dense_index
from tessera.session import scratch_path

LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Scores and their bounds of one block and chunk of rows that a task holds.
CELLS = 1 << 21
#: Whole numbers below this are exact in double precision.
EXACT = 1 << 53


class Tree(NamedTuple):
    """Anchors in an order in which parents come first; the root's parent is -1."""

    number: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    codes: np.ndarray
    parent: np.ndarray
    edge: np.ndarray


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parent (a position in that order) and edge length of the minimum
    spanning tree of the rows of ``x``, from the row nearest to their mean."""
    n = len(x)
    at = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    near, via = np.full(n, np.inf), np.full(n, -1)
    order, place, parent, edge = [at], {at: 0}, [-1], [0.0]
    near[at] = -np.inf
    for _ in range(n - 1):
        d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        closer = d < near
        near[closer], via[closer] = d[closer], at
        open_ = np.where(near == -np.inf, np.inf, near)
        at = int(open_.argmin())
        place[at] = len(order)
        order.append(at)
        parent.append(place[int(via[at])])
        edge.append(float(near[at]))
        near[at] = -np.inf
    return np.array(order), np.array(parent), np.array(edge)


def numbers(rows: pa.Array | list, exact: bool) -> np.ndarray:
    """Lists of equal length as a matrix: doubles, or whole Python numbers where those are not exact."""
    if exact:
        flat = rows.flatten().to_numpy(zero_copy_only=False) if isinstance(rows, pa.Array) else np.array(rows, np.int64)
        return np.ascontiguousarray(flat.reshape(len(rows), -1), np.float64)
    return np.array(rows.to_pylist() if isinstance(rows, pa.Array) else rows, object)


def _whole(scores: np.ndarray) -> np.ndarray:
    """64-bit scores; larger ones count as the largest number."""
    if scores.dtype != object:
        return scores.astype(np.int64)
    return np.array([min(max(int(s), LEAST + 1), MOST) for s in scores], np.int64)


def walk(tree: Tree, codes: np.ndarray, wants, take) -> None:
    """Scores of all rows along the tree: ``wants(k, low, high)`` marks the
    rows to be scored with anchor ``k``, ``take(k, rows, scores)`` gets them."""
    plain = codes.astype(np.float64)
    norm = np.sqrt(np.einsum("ij,ij->i", plain, plain))
    low, high = np.empty((len(tree.ids), len(codes))), np.empty((len(tree.ids), len(codes)))
    for k, parent in enumerate(tree.parent):
        if parent < 0:
            rows = np.arange(len(codes))
        else:
            reach = tree.edge[k] * norm
            np.subtract(low[parent], reach, out=low[k])
            np.add(high[parent], reach, out=high[k])
            rows = np.flatnonzero(wants(k, low[k], high[k]))
        if len(rows):
            scores = codes[rows] @ tree.codes[k]
            low[k, rows] = high[k, rows] = scores.astype(np.float64)
            take(k, rows, _whole(scores))


class Best:
    """The first ``k`` rows of each slot: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int) -> None:
        self.scores, self.ids = np.full((slots, k), LEAST), np.full((slots, k), MOST)

    def least(self, slot: int) -> int:
        return self.scores[slot, -1]

    def offer(self, slot: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.r_[self.scores[slot], scores], np.r_[self.ids[slot], ids]
        first = np.lexsort((i, ~s))[:self.scores.shape[1]]
        self.scores[slot], self.ids[slot] = s[first], i[first]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, at = np.nonzero(self.scores != LEAST)
        return slot, self.scores[slot, at], self.ids[slot, at]


def _chunks(batches: Iterator[pa.RecordBatch], anchors: int, exact: bool):
    step = max(1, CELLS // max(1, anchors))
    for batch in batches:
        for s in range(0, batch.num_rows, step):
            part = batch.slice(s, step)
            yield part.column(0).to_numpy(), part.column(1).to_numpy(), numbers(part.column(2), exact)


def _positives(tree: Tree, batches, k: int, exact: bool) -> tuple:
    best = Best(len(tree.ids), k)
    for ids, labels, codes in _chunks(batches, len(tree.ids), exact):
        def wants(a, low, high):
            return (labels == tree.labels[a]) & (ids != tree.ids[a]) & (high >= best.least(a))  # noqa: B023

        def take(a, rows, scores):
            ok = (labels[rows] == tree.labels[a]) & (ids[rows] != tree.ids[a]) & (scores >= best.least(a))  # noqa: B023
            if ok.any():
                best.offer(a, scores[ok], ids[rows[ok]])  # noqa: B023

        walk(tree, codes, wants, take)
    return best.rows()


def _negatives(tree: Tree, windows: list[list[tuple[int, int, int]]], slots: int, batches, k: int, exact: bool) -> tuple:
    """``windows``: slot, least and largest score of each window of an anchor."""
    best = Best(slots, k)
    for ids, labels, codes in _chunks(batches, len(tree.ids), exact):
        def wants(a, low, high):
            hit = np.zeros(len(ids), bool)  # noqa: B023
            for slot, least, most in windows[a]:
                hit |= (high >= max(least, best.least(slot))) & (low <= most)
            return hit & (labels != tree.labels[a])  # noqa: B023

        def take(a, rows, scores):
            other = labels[rows] != tree.labels[a]  # noqa: B023
            for slot, least, most in windows[a]:
                ok = other & (scores >= max(least, best.least(slot))) & (scores <= most)
                if ok.any():
                    best.offer(slot, scores[ok], ids[rows[ok]])  # noqa: B023

        walk(tree, codes, wants, take)
    return best.rows()


def _tree(pdf: pd.DataFrame) -> pd.DataFrame:
    x = np.array(pdf["code"].tolist(), np.float64)
    order, parent, edge = spanning_tree(x)
    top = np.sqrt((x ** 2).sum(axis=1).max(initial=0.0))
    # A little longer than measured, so that rounding never makes an interval too narrow.
    edge = np.where(edge > 0, edge * (1 + 1e-9) + 1e-12 * top, 0.0)
    return pdf.iloc[order].assign(place=np.arange(len(pdf)), parent=parent, edge=edge)


def _first(df: DataFrame, by: list[str], score: str, ident: str, k: int, rank: str) -> DataFrame:
    number = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), F.asc(ident)))
    return df.withColumn(rank, number).where(F.col(rank) <= k)


def window(score: int, low: int, high: int, base: int) -> tuple[int, int]:
    """Whole scores s with ``low * score <= base * s <= high * score``."""
    return max(LEAST + 1, -(-low * score // base)), min(MOST, high * score // base)


def mine(rows: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, base: int = 100,
         block_rows: int = 4096) -> DataFrame:
    """Hard negatives of rows ``id, label, code, anchor`` (whole numbers in
    ``code``): ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``.

    A row's score is its inner product with the anchor; higher scores come
    first, ties by smaller id. An anchor's positives are its first other rows
    of the same label; for each, the negatives are the first rows of another
    label with ``low * positive <= base * negative <= high * positive``.

    Rows with a null label or code, or a null in the code, take no part. Rows
    that have the anchor's id are not other rows. Rows with a null id are no
    anchors; as candidates they come after others of the same score. Repeated
    rows count each; an anchor that repeats has its rows repeated. Codes of
    different lengths do not meet; empty codes score 0. Scores beyond 64 bits
    count as the nearest 64-bit number. Anchors without positives or without
    negatives, and empty tables, give no rows. Other columns are not read.
    """
    spark = rows.sparkSession
    ok = rows.where(F.col("label").isNotNull() & F.col("code").isNotNull() & ~F.exists("code", lambda v: v.isNull()))
    ok = ok.select(F.col("id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"),
                   F.col("code").cast("array<bigint>").alias("code"), F.coalesce("anchor", F.lit(False)).alias("anchor"))
    size = F.size("code")
    widest = F.coalesce(F.array_max(F.transform("code", lambda v: F.abs(v.cast("decimal(20,0)")))), F.lit(0).cast("decimal(20,0)"))
    lengths = ok.groupBy(size.alias("d")).agg(F.max(widest).alias("top"), F.count_if(F.col("anchor") & F.col("id").isNotNull()).alias("n"))
    path, done = scratch_path(spark, "hard-negatives"), 0
    for r in lengths.where("n > 0").orderBy("d").collect():  # vector lengths: mostly one
        exact = max(1, r["d"]) * int(r["top"]) ** 2 < EXACT
        some = ok.where(size == r["d"])
        order = [F.col(c) for c in ("label", "id", "code")]
        anchors = dense_index(some.where("anchor and id is not null").select("id", "label", "code"), order, "number")
        trees = pin(anchors.withColumn("block", F.floor(F.col("number") / block_rows).cast("int")).groupBy("block").applyInPandas(
            _tree, "id bigint, label bigint, code array<bigint>, number bigint, block int, place int, parent int, edge double"))
        candidates = some.select(F.coalesce("id", F.lit(MOST)).alias("id"), "label", "code")
        for block in range(ceil(r["n"] / block_rows)):
            _block(candidates, trees.where(F.col("block") == block), exact, positives, negatives, low, high, base) \
                .write.parquet(f"{path}/block={done}")
            done += 1
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    return spark.read.schema(schema).parquet(f"{path}/*") if done else spark.createDataFrame([], schema)


def _block(candidates: DataFrame, block: DataFrame, exact: bool, positives: int, negatives: int, low: int, high: int,
           base: int) -> DataFrame:
    """Results of one block of anchors, whose size is bounded."""
    spark = candidates.sparkSession
    held = block.orderBy("place").collect()
    tree = Tree(np.array([h["number"] for h in held]), np.array([h["id"] for h in held]), np.array([h["label"] for h in held]),
                numbers([h["code"] for h in held], exact), np.array([h["parent"] for h in held]), np.array([h["edge"] for h in held]))
    shared = spark.sparkContext.broadcast(tree)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, scores, ids = _positives(shared.value, batches, positives, exact)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(scores), pa.array(ids)], ["slot", "score", "id"])

    found = pin(_first(candidates.mapInArrow(first, "slot int, score bigint, id bigint"), ["slot"], "score", "id", positives, "n"))
    wins: list[list[tuple[int, int, int]]] = [[] for _ in held]
    slots = found.select("slot", "score").distinct().orderBy("slot", "score").collect()  # block_rows x positives at most
    for k, s in enumerate(slots):
        least, most = window(s["score"], low, high, base)
        if least <= most:
            wins[s["slot"]].append((k, least, most))
    count = len(slots)
    opened = spark.sparkContext.broadcast(wins)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, scores, ids = _negatives(shared.value, opened.value, count, batches, negatives, exact)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(scores), pa.array(ids)], ["win", "score", "id"])

    hard = _first(candidates.mapInArrow(second, "win int, score bigint, id bigint"), ["win"], "score", "id", negatives, "rank")
    named = spark.createDataFrame([(k, s["slot"], s["score"], held[s["slot"]]["id"]) for k, s in enumerate(slots)],
                                  "win int, slot int, positive_score bigint, anchor_id bigint")
    opened_by = found.select("slot", F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    pairs = opened_by.join(named, ["slot", "positive_score"])
    null = lambda c: F.nullif(F.col(c), F.lit(MOST))
    return (hard.join(pairs, "win").select(
        "anchor_id", null("positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        null("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def quantised(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component; null if the vector is null or holds a null or non-finite component."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))))
