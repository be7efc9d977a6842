"""Exact top-k by inner product, with items visited by falling norm.

A score is at most the product of the two norms. Items are ordered by norm,
longest first, and cut into blocks; a user goes from block to block until the
product of its norm with the block's largest is below its k-th best score, and
scores nothing behind it. Items are broadcast in groups of growing, bounded size:
where all of them fit into one group, a single pass over the users does it; else
each group is a pass over the users that are still open, whose lists are carried
in a written table, until all are closed: the items behind are not fetched. No
pair of user and item is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.rank import dense_index
from tessera.session import checkpoint_dir

#: Items of one block; numbers (items x factors) of the largest broadcast group and of the first one,
#: how much larger each is than the one before; scores that a task holds.
BLOCK_ITEMS, GROUP_NUMBERS, FIRST_NUMBERS, GROWTH, CELLS = 512, 1 << 24, 1 << 20, 4, 1 << 21
STATE = "id int, features array<float>, items array<int>, scores array<double>, open boolean, scored bigint"


def _rows(col: pa.Array, width: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), width)


class Lists:
    """The best ``k`` items of each user of a chunk so far: higher scores first, ties by smaller id."""

    def __init__(self, users: np.ndarray, k: int) -> None:
        self.users, self.k = users, k
        self.norm = np.sqrt(np.einsum("ij,ij->i", users, users)) * (1 + 1e-12)
        self.items, self.scores = np.full((len(users), k), np.iinfo(np.int32).max, np.int32), np.full((len(users), k), -np.inf)
        self.open, self.scored = np.ones(len(users), bool), np.zeros(len(users), np.int64)

    def close(self, longest: float) -> None:
        """Close the users that no item up to this norm may still change."""
        self.open &= ~(self.norm * longest < self.scores[:, -1])

    def visit(self, ids: np.ndarray, factors: np.ndarray, longest: float) -> None:
        """Score a block of items with the users that its longest item may still change.

        Only scores that reach the user's k-th best, of its list and of the block, are sorted."""
        self.close(longest)
        at = np.flatnonzero(self.open)
        if not len(at):
            return
        scores = self.users[at] @ factors.T
        self.scored[at] += len(ids)
        least = self.scores[at, -1]
        if len(ids) > self.k:
            least = np.maximum(least, np.partition(scores, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        row, col = np.nonzero(scores >= least[:, None])
        better = np.unique(row)
        if not len(better):
            return
        of = np.concatenate([row, np.repeat(better, self.k)])
        both = np.concatenate([scores[row, col], self.scores[at[better]].ravel()])
        names = np.concatenate([ids[col], self.items[at[better]].ravel()])
        order = np.lexsort((names, -both, of))
        of = of[order]
        order = order[np.arange(len(of)) - np.searchsorted(of, of) < self.k]  # at least k of each user
        self.scores[at[better]], self.items[at[better]] = both[order].reshape(-1, self.k), names[order].reshape(-1, self.k)


def _fill(out: np.ndarray, lists: pa.Array) -> None:
    """Put each list at the head of its row."""
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    out[np.arange(out.shape[1]) < n[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)


def _heads(rows: np.ndarray, n: np.ndarray) -> pa.Array:
    """The first ``n`` values of each row as a list."""
    ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows[np.arange(rows.shape[1]) < n[:, None]]))


def _pass(state: DataFrame, group: pa.Table, k: int, width: int, behind: float) -> DataFrame:
    """Visit one group of items, in blocks, with all open users; the others stay as they are.
    ``behind`` is the largest norm of the items behind the group."""
    group = group.combine_chunks()
    ids = group.column("id").to_numpy()
    factors = _rows(group.column("features").combine_chunks(), width).astype(np.float64)
    shared = state.sparkSession.sparkContext.broadcast((ids, factors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, items = shared.value
        longest = np.sqrt(np.einsum("ij,ij->i", items, items)) * (1 + 1e-12)
        step = max(1, CELLS // (BLOCK_ITEMS + k))
        for batch in batches:
            for s in range(0, batch.num_rows, step):
                part = batch.slice(s, step)
                held = Lists(_rows(part.column(1), width).astype(np.float64), k)
                _fill(held.items, part.column(2))
                _fill(held.scores, part.column(3))
                held.open = part.column(4).to_numpy(zero_copy_only=False).copy()
                held.scored += part.column(5).to_numpy()
                for b in range(0, len(names), BLOCK_ITEMS):
                    held.visit(names[b:b + BLOCK_ITEMS], items[b:b + BLOCK_ITEMS], longest[b])
                    if not held.open.any():
                        break
                held.close(behind)
                full = (held.scores > -np.inf).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), _heads(held.items, full), _heads(held.scores, full), pa.array(held.open),
                     pa.array(held.scored)], ["id", "features", "items", "scores", "open", "scored"])

    return state.mapInArrow(run, STATE)


def top_k_by_norm(users: DataFrame, items: DataFrame, k: int, group_numbers: int = GROUP_NUMBERS) -> DataFrame:
    """``(id, items, scores, scored)`` for each row ``(id, features)`` of
    ``users``: the ids of its ``k`` best items by inner product, best first,
    ties by smaller id, their scores, and how many items were scored for it.
    Fewer items than ``k`` give shorter lists, no items no rows.

    Each group of items (at most ``group_numbers`` numbers) passes through the
    driver on its way to a broadcast.
    """
    spark = users.sparkSession
    checkpoint_dir(spark)
    norm = F.aggregate("features", F.lit(0.0).cast("double"), lambda a, v: a + v.cast("double") * v.cast("double"))
    ranked = dense_index(items.select(F.col("id").cast("int").alias("id"), "features", norm.alias("norm")),
                         [F.col("norm").desc(), F.col("id").asc()], "at").checkpoint(eager=True)
    shape = ranked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("width")).first()
    state = users.select(
        F.col("id").cast("int").alias("id"), "features", F.array().cast("array<int>").alias("items"),
        F.array().cast("array<double>").alias("scores"), F.lit(True).alias("open"), F.lit(0).cast("bigint").alias("scored"))
    if not shape["n"]:
        return state.limit(0).select("id", "items", "scores", "scored")
    width, start, size = shape["width"], 0, min(group_numbers, FIRST_NUMBERS)
    while start < shape["n"]:
        if start:  # users that are closed pass through
            state = state.checkpoint(eager=True)
            if state.where("open").isEmpty():
                break
        end = start + max(1, size // max(1, width))
        group = ranked.where((F.col("at") >= start) & (F.col("at") < end)).orderBy("at").select("id", "features").toArrow()
        behind = ranked.where(F.col("at") == end).first()
        state = _pass(state, group, k, width, behind["norm"] ** 0.5 * (1 + 1e-12) if behind else np.inf)
        start, size = end, min(group_numbers, size * GROWTH)
    return state.select("id", "items", "scores", "scored")
