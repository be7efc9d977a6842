"""Gradient-boosted trees of many fits at once: the trees of ``GBTClassifier``.

MLlib makes every level of every tree of every fit a job of its own, so a grid
of fits is thousands of jobs that mostly wait for each other. Here the fits of
a table that fits one block (``BLOCK_BYTES``) are tasks, each growing its trees
from start to end; those of a larger table grow level by level over its blocks,
all fits in the same jobs, and no task holds more than a block.

The algorithm is MLlib's, step by step: its own cut points (``cuts``), first
tree on the labels as -1 and 1, later ones on the pseudo-residuals of the
logistic loss and weighed by the step size, variance as impurity, bins added up
in row order, the first best cut of the first best column. Results differ only
in the last bits of sums, where MLlib's do between runs, too.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

# Utils.EPSILON of MLlib: a child of less impurity is not split.
EPSILON = 2.0 ** -52
# Bins are bytes; no value lies beyond this one.
LAST_BIN = 255


@dataclass(frozen=True)
class Boosting:
    """What of a ``GBTClassifier`` decides on its trees."""

    depth: int
    trees: int
    step: float
    min_rows: int
    min_gain: float


def supported(gbt: GBTClassifier, data: DataFrame) -> bool:
    """Whether the trees of ``gbt`` can be grown here: no sampling of rows or
    columns, no weights, no early stop, numeric columns, levels that stay small."""
    plain = (gbt.getSubsamplingRate() == 1.0 and gbt.getFeatureSubsetStrategy() in ("all", "1.0")
             and gbt.getMinWeightFractionPerNode() == 0.0 and gbt.getMaxDepth() <= 12 and gbt.getMaxBins() <= 256)
    kinds = data.schema[gbt.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return plain and set(kinds) <= {"numeric"} and not any(gbt.isDefined(p) for p in ("weightCol", "validationIndicatorCol"))


def boosting_of(gbt: GBTClassifier) -> Boosting:
    return Boosting(gbt.getMaxDepth(), gbt.getMaxIter(), gbt.getStepSize(), gbt.getMinInstancesPerNode(), gbt.getMinInfoGain())


def cuts(gbt: GBTClassifier, train: DataFrame) -> list[np.ndarray]:
    """The cut points of each column that ``gbt.fit(train)`` would choose from,
    by MLlib's own step for them; its errors on labels and values come with it."""
    jvm = train.sparkSession.sparkContext._jvm
    module = lambda name: getattr(getattr(jvm, f"{name}$"), "MODULE$")
    gbt._transfer_params_to_java()
    rows = module("org.apache.spark.ml.util.DatasetUtils").extractInstances(gbt._java_obj, train._jdf, jvm.scala.Some(2))
    none = module("org.apache.spark.api.python.PythonUtils").toScalaMap({})
    strategy = gbt._java_obj.getOldBoostingStrategy(none, module("org.apache.spark.mllib.tree.configuration.Algo").Classification()).treeStrategy()
    metadata = module("org.apache.spark.ml.tree.impl.DecisionTreeMetadata").buildMetadata(rows, strategy, 1, gbt.getFeatureSubsetStrategy())
    splits = module("org.apache.spark.ml.tree.impl.RandomForest").findSplits(rows, metadata, gbt.getSeed())
    return [np.array([s.threshold() for s in of], dtype=np.float64) for of in splits]


def binned(values: np.ndarray, points: Sequence[np.ndarray]) -> np.ndarray:
    """``(columns, rows)``: in which bin each value lies, a cut point in the bin below it."""
    out = np.empty((len(points), len(values)), dtype=np.uint8)
    for f, at in enumerate(points):
        out[f] = np.searchsorted(at, values[:, f], side="left")
    return out


@dataclass
class Tree:
    """Nodes by number, the root 0: rows whose bin of ``column`` is up to ``cut``
    go to node ``below``, others to the one after it. A leaf is below itself,
    its cut the last bin there can be."""

    column: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    value: np.ndarray

    def step(self, node: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """The nodes one level down of rows that are at ``node``."""
        at = self.column.take(node)
        at *= bins.shape[1]
        at += np.arange(bins.shape[1])
        return self.below.take(node) + (bins.ravel().take(at) > self.cut.take(node))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node every row of ``(columns, rows)`` ends in, however deep."""
        node = np.zeros(bins.shape[1], dtype=np.intp)
        for _ in range(self.levels()):
            node = self.step(node, bins)
        return node

    def levels(self) -> int:
        own, deep = np.arange(len(self.below)), np.zeros(len(self.below), dtype=int)
        for k in own[self.below != own]:  # parents come before their children
            deep[self.below[k]:self.below[k] + 2] = deep[k] + 1
        return int(deep.max())


def _impurity(s: np.ndarray) -> np.ndarray:
    """Of sums ``(..., 3)``: rows, values, squares. Variance, 0 without rows."""
    n, total, squares = s[..., 0], s[..., 1], s[..., 2]
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(n == 0, 0.0, (squares - (total * total) / n) / n)


def bin_sums(slot: np.ndarray, slots: int, bins: np.ndarray, size: int, r: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """``(slots, size, 3)``: rows, residuals and their squares by slot and bin of
    one column, added in the order of the rows."""
    key = slot * size + bins
    n = slots * size
    out = np.empty((n, 3))
    out[:, 0], out[:, 1], out[:, 2] = np.bincount(key, minlength=n), np.bincount(key, r, n), np.bincount(key, squares, n)
    return out.reshape(slots, size, 3)


@dataclass
class Best:
    """By slot: gain, column and cut of the best split so far and the sums below
    and above it; ``whole`` are the sums of the slot's rows."""

    gain: np.ndarray
    column: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    above: np.ndarray
    whole: np.ndarray


def tried(sizes: Sequence[int]) -> list[tuple[int, int]]:
    """The columns that have a cut, and their bins; if none has one, the first column."""
    return [(f, size) for f, size in enumerate(sizes) if size > 1] or [(0, 1)]


def best_cut(sums: np.ndarray, column: int, whole: np.ndarray | None, b: Boosting) -> Best:
    """The first best cut of one column. Without ``whole`` (at the root) the
    slot's sums are those of both sides of the first cut."""
    if sums.shape[1] == 1:
        whole, none = sums[:, 0], np.zeros(len(sums), dtype=int)
        return Best(np.full(len(sums), -np.inf), none, none, whole, whole, whole)
    upto = np.cumsum(sums, axis=1)
    below = upto[:, :-1]
    above = upto[:, -1:] - below
    whole = below[:, 0] + above[:, 0] if whole is None else whole
    n, m = below[..., 0], above[..., 0]
    gain = _impurity(whole)[:, None] - n / (n + m) * _impurity(below) - m / (n + m) * _impurity(above)
    gain[(n < b.min_rows) | (m < b.min_rows) | (gain < b.min_gain)] = -np.inf
    cut = gain.argmax(axis=1)
    at = (np.arange(len(cut)), cut)
    return Best(gain[at], np.full(len(cut), column), cut, below[at], above[at], whole)


def better(a: Best | None, b: Best) -> Best:
    """Of two columns' best, ``a`` of the earlier one, slot by slot the better."""
    if a is None:
        return b
    take = b.gain > a.gain
    pick = lambda x, y: np.where(take.reshape(-1, *[1] * (x.ndim - 1)), y, x)
    return Best(pick(a.gain, b.gain), pick(a.column, b.column), pick(a.cut, b.cut), pick(a.below, b.below), pick(a.above, b.above), a.whole)


class Growing:
    """A tree in the making: ``open`` are the nodes that the next level may
    split, ``whole`` the sums of their rows (none at the root)."""

    def __init__(self, b: Boosting):
        self.b, self.level, self.open, self.whole = b, 0, [0], None
        self.column, self.cut, self.below, self.value = [0], [LAST_BIN], [0], [0.0]

    def split(self, best: Best) -> None:
        """Split the open nodes where that gains; their impure children are open next."""
        mean = lambda s: s[..., 1] / np.where(s[..., 0] == 0, 1, s[..., 0])
        if self.level == 0:
            self.value[0] = float(mean(best.whole)[0])
        last = self.level + 1 >= self.b.depth
        sides = [(s, mean(s).tolist(), (np.abs(_impurity(s)) < EPSILON).tolist()) for s in (best.below, best.above)]
        opened, wholes = [], []
        for k, node in enumerate(self.open):
            if not best.gain[k] > 0 or self.b.depth == 0:
                continue
            self.column[node], self.cut[node], self.below[node] = int(best.column[k]), int(best.cut[k]), len(self.column)
            for sums, values, pure in sides:
                if not last and not pure[k]:
                    opened.append(len(self.column))
                    wholes.append(sums[k])
                self.below.append(len(self.column))
                self.column.append(0)
                self.cut.append(LAST_BIN)
                self.value.append(values[k])
        self.open, self.whole, self.level = opened, np.array(wholes).reshape(-1, 3), self.level + 1

    def tree(self) -> Tree:
        return Tree(np.array(self.column), np.array(self.cut, dtype=np.uint8), np.array(self.below), np.array(self.value))

    def slots(self) -> np.ndarray:
        """The slot of each node among the open ones, -1 for others."""
        out = np.full(len(self.column), -1)
        out[self.open] = np.arange(len(self.open))
        return out


def residuals(sign: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """What the next tree is fitted on: the labels, later the negative gradients."""
    if margin is None:
        return sign
    out = 2.0 * sign
    out *= margin
    np.exp(out, out=out)
    out += 1.0
    return np.divide(4.0 * sign, out, out=out)


def _grow_tree(bins: np.ndarray, sizes: Sequence[int], r: np.ndarray, b: Boosting) -> tuple[Tree, np.ndarray]:
    """One tree from all rows of a block, and the node each of them ends in."""
    growing, node = Growing(b), np.zeros(len(r), dtype=np.intp)
    rows, at, slot, part, squares, cells = None, node, node, r, r * r, bins
    while growing.open:
        best = None
        for f, size in tried(sizes):
            sums = bin_sums(slot, len(growing.open), cells[f], size, part, squares)
            best = better(best, best_cut(sums, f, growing.whole if best is None else best.whole, b))
        growing.split(best)
        at = growing.tree().step(at, cells)
        node[slice(None) if rows is None else rows] = at
        slot = growing.slots().take(at)
        keep = np.flatnonzero(slot >= 0)
        if len(keep) < len(slot):
            rows = keep if rows is None else rows.take(keep)
            at, slot, part, squares, cells = at.take(keep), slot.take(keep), part.take(keep), squares.take(keep), cells.take(keep, axis=1)
    return growing.tree(), node


def grow(bins: np.ndarray, sizes: Sequence[int], sign: np.ndarray, b: Boosting) -> list[Tree]:
    """All trees of a fit from the rows of one block."""
    trees, margin = [], None
    for _ in range(b.trees):
        tree, node = _grow_tree(bins, sizes, residuals(sign, margin), b)
        margin = tree.value.take(node) if margin is None else margin + tree.value.take(node) * b.step
        trees.append(tree)
    return trees


def margins(trees: Iterable[Tree], step: float, bins: np.ndarray) -> np.ndarray:
    """The sum of all trees, the first whole, for ``(columns, rows)``."""
    total = np.zeros(bins.shape[1])
    for k, tree in enumerate(trees):
        total += tree.value[tree.nodes(bins)] * (step if k else 1.0)
    return total


@dataclass(frozen=True)
class Fit:
    """One setting on the rows outside one fold, by the cut points of ``key``: the fold and the number of bins."""

    setting: int
    fold: int
    key: tuple
    boosting: Boosting


# A table of up to so many bytes of columns is one block, of which every fit is one task.
BLOCK_BYTES = 8 << 20
# Rows of a block of a larger table, few enough that a fit's arrays of them stay in a core's cache.
BLOCK_ROWS = 1 << 15
# Of a larger table, so many folds grow at once that their fits' margins take up to so many bytes.
MARGIN_BYTES = 2 << 30
# Rows of a task at most; up to there, a task a core.
TASK_ROWS = 1 << 20
# Sums of a level that the driver adds up itself, all tasks' together; more are shuffled, a task for so many of one map task.
SUM_BYTES, MERGED_BYTES = 32 << 20, 4 << 20


def _unpacked(batches: Iterable) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Values, labels and folds of Arrow batches with the columns of ``_plain``."""
    for batch in batches:
        n = batch.num_rows
        if n:
            yield (batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1),
                   batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False))


def _plain(data: DataFrame, features: str, label: str, fold: str) -> DataFrame:
    return data.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).alias("fold"))


def _sizes(points: Sequence[np.ndarray]) -> list[int]:
    return [len(at) + 1 for at in points]


def _as_tasks(sc, rows: tuple, fits: Sequence[Fit], points: dict) -> list[list[Tree]]:
    """The trees of each fit, every fit a task over the one block."""
    shared = sc.broadcast((rows, points))

    def run(k: int) -> tuple[int, list[Tree]]:
        (values, labels, folds), at = shared.value
        fit, keep = fits[k], folds != fits[k].fold
        return k, grow(binned(values[keep], at[fit.key]), _sizes(at[fit.key]), 2.0 * labels[keep] - 1.0, fit.boosting)

    done = dict(sc.parallelize(range(len(fits)), len(fits)).map(run).collect())
    shared.destroy()
    return [done[k] for k in range(len(fits))]


def _packed(batches: Iterable) -> Iterator:
    """Arrow batches as pickled blocks of ``BLOCK_ROWS``."""
    held, rows = [], 0

    def block():
        return pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps([np.concatenate(c) for c in zip(*held)], protocol=5)], pa.binary())})

    for values, labels, folds in _unpacked(batches):
        for k in range(0, len(labels), BLOCK_ROWS):
            part = slice(k, k + BLOCK_ROWS)
            held.append((values[part], labels[part].astype(np.int8), folds[part]))
            rows += len(held[-1][1])
            if rows >= BLOCK_ROWS:
                yield block()
                held, rows = [], 0
    if held:
        yield block()


def _dealt(plain: DataFrame, rows: int):
    """The blocks of a table, dealt out evenly and in an order that does not
    depend on the run: so that sums of them do not, either."""
    sc = plain.sparkSession.sparkContext
    parts = max(sc.defaultParallelism, -(-rows // TASK_ROWS))
    blocks = plain.mapInArrow(_packed, "block binary").rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.DISK_ONLY)
    numbered = blocks.zipWithIndex().map(lambda b: (b[1], b[0]))
    dealt = numbered.partitionBy(parts, lambda k: k).mapPartitions(lambda own: (b for _, b in sorted(own, key=lambda b: b[0])))
    return blocks, dealt


def _level_sums(trees: dict[int, tuple[Tree, int, np.ndarray, int]], keys: Sequence[tuple], points: dict) -> Callable:
    """For the fits of ``trees`` (the tree so far, its levels, the slots of its
    nodes, their number): the sums of every column, over the blocks of a task."""
    widest = max(len(at) for at in points.values())

    def run(task: int, blocks: Iterable) -> Iterator:
        total: dict[int, np.ndarray] = {}
        for cells_of, sign_of, margin in blocks:
            for j, (tree, level, slots, n) in trees.items():
                cells, r = cells_of[keys[j]], residuals(sign_of[keys[j][0]].astype(np.float64), margin[j])
                node = np.zeros(len(r), dtype=np.intp)
                for _ in range(level):
                    node = tree.step(node, cells)
                slot = slots.take(node)
                keep = np.flatnonzero(slot >= 0)
                if len(keep) < len(slot):
                    slot, r, cells = slot.take(keep), r.take(keep), cells.take(keep, axis=1)
                squares = r * r
                for f, size in tried(_sizes(points[keys[j]])):
                    sums = bin_sums(slot, n, cells[f], size, r, squares)
                    k = j * widest + f
                    total[k] = total[k] + sums if k in total else sums
        for k, sums in total.items():
            yield k, (task, sums)

    return run


def _best_of(growing: dict[int, tuple], widest: int) -> Callable:
    """The best cut by fit and column from the sums of all tasks, added in their order."""

    def run(sums: Iterable) -> Iterator:
        found: dict[int, list] = {}
        for k, s in sums:
            found.setdefault(k, []).append(s)
        for k, of in found.items():
            total = None
            for _, s in sorted(of, key=lambda s: s[0]):
                total = s if total is None else total + s
            whole, b = growing[k // widest]
            yield k, best_cut(total, k % widest, whole, b)

    return run


def _by_levels(dealt, fits: Sequence[Fit], points: dict) -> list[list[Tree]]:
    """The trees of ``fits``: each level of the current tree of all of them is
    one job over the blocks, which hold the fits' margins."""
    sc, parts, keys = dealt.context, dealt.getNumPartitions(), [fit.key for fit in fits]
    own = {key: points[key] for key in keys}
    widest = max(len(at) for at in own.values())

    def start(block: bytes):
        values, labels, folds = pickle.loads(block)
        rest = {fold: folds != fold for fold, _ in own}
        return ({key: binned(values[rest[key[0]]], at) for key, at in own.items()},
                {fold: (2 * labels[keep] - 1).astype(np.int8) for fold, keep in rest.items()}, [None] * len(keys))

    def add(trees: dict[int, tuple[Tree, float]]) -> Callable:
        def run(block):
            cells, sign_of, margin = block
            moved = list(margin)
            for j, (tree, step) in trees.items():
                value = tree.value.take(tree.nodes(cells[keys[j]]))
                moved[j] = value if margin[j] is None else margin[j] + value * step
            return cells, sign_of, moved
        return run

    state, stale = dealt.map(start).persist(StorageLevel.MEMORY_AND_DISK), None
    done: list[list[Tree]] = [[] for _ in fits]
    try:
        for turn in range(max(fit.boosting.trees for fit in fits)):
            growing = {j: Growing(fit.boosting) for j, fit in enumerate(fits) if turn < fit.boosting.trees}
            while going := {j: g for j, g in growing.items() if g.open}:
                trees = {j: (g.tree(), g.level, g.slots(), len(g.open)) for j, g in going.items()}
                sums = state.mapPartitionsWithIndex(_level_sums(trees, keys, own))
                best_of = _best_of({j: (g.whole, g.b) for j, g in going.items()}, widest)
                size = sum(24 * len(g.open) * sum(_sizes(points[keys[j]])) for j, g in going.items())
                if size * parts <= SUM_BYTES:
                    bests = best_of(sums.collect())
                else:
                    bests = sums.partitionBy(min(-(-size // MERGED_BYTES), sc.defaultParallelism), lambda k: k).mapPartitions(best_of).collect()
                found: dict[int, Best | None] = dict.fromkeys(going)
                whole: dict[int, np.ndarray] = {}
                for k, best in sorted(bests, key=lambda b: b[0]):
                    j = k // widest
                    best.whole = whole.setdefault(j, best.whole)
                    found[j] = better(found[j], best)
                for j, g in going.items():
                    g.split(found[j])
                if stale is not None:
                    stale, _ = None, stale.unpersist()
            for j, g in growing.items():
                done[j].append(g.tree())
            state, stale = state.map(add({j: (done[j][-1], fits[j].boosting.step) for j in growing})).persist(StorageLevel.MEMORY_AND_DISK), state
    finally:
        for rdd in (state, stale):
            if rdd is not None:
                rdd.unpersist()
    return done


def forests(data: DataFrame, features: str, label: str, fold: str, fits: Sequence[Fit], points: dict) -> list[list[Tree]]:
    """The trees of every fit, those with most work first in ``fits``."""
    spark, plain = data.sparkSession, _plain(data, features, label, fold)
    rows, columns = plain.count(), len(next(iter(points.values())))
    if rows * columns * 8 <= BLOCK_BYTES:
        return _as_tasks(spark.sparkContext, tuple(np.concatenate(c) for c in zip(*_unpacked(plain.toArrow().to_batches()))), fits, points)
    blocks, dealt = _dealt(plain, rows)
    dealt.persist(StorageLevel.MEMORY_AND_DISK)
    folds = sorted({fit.fold for fit in fits})
    at_once = max(1, MARGIN_BYTES * len(folds) // (8 * rows * len(fits)))
    done: dict[int, list[Tree]] = {}
    try:
        for k in range(0, len(folds), at_once):
            of = [i for i, fit in enumerate(fits) if fit.fold in folds[k:k + at_once]]
            done |= zip(of, _by_levels(dealt, [fits[i] for i in of], points))
    finally:
        dealt.unpersist()
        blocks.unpersist()
    return [done[i] for i in range(len(fits))]


def scores(data: DataFrame, features: str, label: str, fold: str, fits: Sequence[Fit], points: dict,
           grown: Sequence[list[Tree]]) -> DataFrame:
    """``(setting, fold, label, score)``: the margin of every row by each fit that left out its fold."""
    of_fold: dict[int, list[tuple]] = {}
    for fit, trees in zip(fits, grown):
        of_fold.setdefault(fit.fold, []).append((fit, trees))
    shared = data.sparkSession.sparkContext.broadcast((of_fold, points))

    def run(batches: Iterable) -> Iterator:
        by_fold, at = shared.value
        for batch in batches:
            for values, _, folds in _unpacked([batch]):
                for k in np.unique(folds).tolist():
                    own = np.flatnonzero(folds == k)
                    cells: dict[tuple, np.ndarray] = {}
                    labels = batch.column(3).take(pa.array(own))
                    for fit, trees in by_fold.get(k, ()):
                        if fit.key not in cells:
                            cells[fit.key] = binned(values[own], at[fit.key])
                        score = margins(trees, fit.boosting.step, cells[fit.key])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(own), fit.setting, dtype=np.int32)), pa.array(np.full(len(own), k, dtype=np.int32)), labels, pa.array(score)],
                            names=["setting", "fold", "label", "score"])

    kind = data.schema[label].dataType
    schema = StructType([StructField("setting", IntegerType()), StructField("fold", IntegerType()), StructField("label", kind), StructField("score", DoubleType())])
    plain = data.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).alias("fold"), F.col(label).alias("label"))
    return plain.mapInArrow(run, schema)
