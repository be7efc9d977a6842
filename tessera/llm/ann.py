"""Approximate nearest neighbours by cosine over randomly rotated one-bit codes.

Unit vectors are rotated by a seeded random orthogonal matrix and each
coordinate keeps its sign: D bits a vector, packed, with one correction scalar,
the inner product ``f`` of the vector with its own code (a unit vector of
+-1/sqrt(D)). For a rotated query the product with the code, divided by ``f``,
estimates the cosine; its error stays below ``epsilon * sqrt((1 - f^2) /
(f^2 (D - 1)))`` with a probability that ``epsilon`` sets. A candidate is
reranked in double precision on the original vectors if its estimate plus that
bound reaches the k-th best score found so far by the task.

Every row is indexed and the index is written once. The queries are a stated
set, taken in blocks of bounded size that are broadcast, so that no candidate is
shuffled; a task returns k rows a query, and the k best are picked by group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import pin
from tessera.operators.rank import dense_index
from tessera.session import scratch_path

MOST = (1 << 63) - 1
#: Estimates of one block of queries and chunk of rows that a task holds.
CELLS = 1 << 21
#: Numbers of all vectors of one block of queries.
BLOCK_NUMBERS = 1 << 20
INDEX = "id bigint, vector array<double>, query boolean, code binary, f double"


@cache
def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


def lists(col: pa.Array) -> np.ndarray:
    """Lists of equal length as a matrix of doubles."""
    return np.ascontiguousarray(col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1), np.float64)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that squares neither overflow nor vanish; cosines stay the same."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def encode(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated rows, and each row's product with its own code."""
    turned = (x / norms(x)[:, None]) @ rotation(x.shape[1], seed)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])


def estimate(codes: np.ndarray, f: np.ndarray, turned: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of coded rows with rotated unit queries (rows x queries), and the error bound of each row."""
    dim = turned.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    about = (signs @ turned.T.astype(np.float32)) / (np.sqrt(dim) * f[:, None])
    return about, epsilon * np.sqrt(np.maximum(1 - f * f, 0.0) / (f * f * max(dim - 1, 1))) + 1e-5


class Nearest:
    """The ``k`` best rows of each query, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.own, self.k = ids, k
        self.vectors = scaled(vectors)
        self.norm = norms(self.vectors)
        self.scores = np.full((len(ids), k), -np.inf)
        self.ids = np.full((len(ids), k), MOST)
        self.reranked = 0

    def rerank(self, rows: np.ndarray, queries: np.ndarray, ids: np.ndarray, x: np.ndarray, norm: np.ndarray) -> None:
        """Score pairs of rows and queries (sorted by query) on the original vectors."""
        self.reranked += len(rows)
        for s in range(0, len(rows), 1 << 16):
            a, q = rows[s:s + (1 << 16)], queries[s:s + (1 << 16)]
            cos = np.einsum("ij,ij->i", x[a], self.vectors[q]) / (norm[a] * self.norm[q])
            ok = (cos >= self.scores[q, -1]) & (ids[a] != self.own[q])
            a, q, cos = a[ok], q[ok], cos[ok]
            cuts = np.flatnonzero(np.r_[True, q[1:] != q[:-1], True]) if len(q) else []
            for lo, hi in zip(cuts, cuts[1:]):
                at = q[lo]
                score, ident = np.r_[self.scores[at], cos[lo:hi]], np.r_[self.ids[at], ids[a[lo:hi]]]
                first = np.lexsort((ident, -score))[:self.k]
                self.scores[at], self.ids[at] = score[first], ident[first]

    def visit(self, ids: np.ndarray, x: np.ndarray, codes: np.ndarray, f: np.ndarray, turned: np.ndarray, epsilon: float) -> None:
        x = scaled(x)
        norm = norms(x)
        about, error = estimate(codes, f, turned, epsilon)
        # The likeliest rows first; their scores raise the bar for the others.
        top = min(len(ids), 2 * self.k)
        likely = np.argpartition(-about, top - 1, axis=0)[:top].T
        self.rerank(likely.ravel(), np.repeat(np.arange(len(turned)), top), ids, x, norm)
        about += error[:, None]
        open_ = about.T >= self.scores[:, -1:]
        open_[np.arange(len(turned))[:, None], likely] = False
        queries, rows = np.nonzero(open_)
        self.rerank(rows, queries, ids, x, norm)


def usable(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


def build(rows: DataFrame, seed: int = 13) -> DataFrame:
    """The written index of rows ``id, vector, query``: every usable row with
    its code and correction. Rows with a null id stay candidates."""
    vector = F.col("vector").cast("array<double>")
    ok = rows.select(F.coalesce(F.col("id").cast("bigint"), F.lit(MOST)).alias("id"), vector.alias("vector"),
                     (F.coalesce("query", F.lit(False)) & F.col("id").isNotNull()).alias("query")).where(usable(F.col("vector")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            lengths = column.value_lengths().to_numpy()
            codes, f = [b""] * len(lengths), np.empty(len(lengths))
            for dim in np.unique(lengths):  # mostly one
                at = np.flatnonzero(lengths == dim)
                bits, f[at] = encode(scaled(lists(column.take(pa.array(at)))), seed)
                for k, row in zip(at, bits):
                    codes[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary()), pa.array(f)],
                                             ["id", "vector", "query", "code", "f"])

    return pin(ok.mapInArrow(run, INDEX))


def search(rows: DataFrame, k: int = 5, epsilon: float = 3.0, block_rows: int = 2048, seed: int = 13) -> DataFrame:
    """The ``k`` nearest rows found of each row with ``query`` true, among rows
    ``id, vector, query``: ``query_id, rank, id, score``, nearest first, ties
    to the smaller id; all candidates, if fewer.

    Vectors that are null, empty, zero or hold null or non-finite components
    take no part. Rows that have the query's id are not its candidates. Rows
    with a null id are candidates (after others of the same score) but no
    queries. Repeated rows count each; a query that repeats has its rows
    repeated. Vectors of different lengths do not meet. No query or no
    candidate gives no rows. Other columns are not read.
    """
    index = build(rows, seed)
    spark, size = rows.sparkSession, F.size("vector")
    path, done = scratch_path(spark, "neighbours"), 0
    for r in index.groupBy(size.alias("d")).agg(F.count_if("query").alias("n")).where("n > 0").orderBy("d").collect():
        some, held = index.where(size == r["d"]), max(1, min(block_rows, BLOCK_NUMBERS // r["d"]))
        order = [F.col("id"), F.col("vector")]
        blocks = pin(dense_index(some.where("query").select("id", "vector"), order, "number")
                     .withColumn("block", F.floor(F.col("number") / held)))
        for block in range(ceil(r["n"] / held)):
            _block(some, blocks.where(F.col("block") == block), k, epsilon, seed).write.parquet(f"{path}/block={done}")
            done += 1
    schema = "query_id bigint, rank int, id bigint, score double"
    return spark.read.schema(schema).parquet(f"{path}/*") if done else spark.createDataFrame([], schema)


def _block(index: DataFrame, block: DataFrame, k: int, epsilon: float, seed: int) -> DataFrame:
    """Results of one block of queries, whose size is bounded."""
    held = block.select("id", "vector").toPandas()
    shared = index.sparkSession.sparkContext.broadcast((held["id"].to_numpy(), np.array(held["vector"].tolist(), np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vectors = shared.value
        best = Nearest(own, vectors, k)
        turned = (best.vectors / best.norm[:, None]) @ rotation(vectors.shape[1], seed)
        step = max(1, CELLS // len(own))
        for batch in batches:
            for s in range(0, batch.num_rows, step):
                part = batch.slice(s, step)
                codes = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                best.visit(part.column(0).to_numpy(), lists(part.column(1)), codes, part.column(3).to_numpy(), turned, epsilon)
        at, rank = np.nonzero(best.scores > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(best.own[at]), pa.array(best.ids[at, rank]),
                                          pa.array(best.scores[at, rank])], ["at", "query_id", "id", "score"])

    found = index.select("id", "vector", "code", "f").mapInArrow(run, "at int, query_id bigint, id bigint, score double")
    place = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), "id"))
    return (found.withColumn("rank", place).where(F.col("rank") <= k)
            .select("query_id", "rank", F.nullif("id", F.lit(MOST)).alias("id"), "score"))


def exact(rows: DataFrame, k: int = 5, block_rows: int = 2048) -> DataFrame:
    """As ``search``, every candidate of each query reranked: what recall is measured against."""
    return search(rows, k, float("inf"), block_rows)


def recall(found: DataFrame, true: DataFrame) -> float:
    """Share of the true neighbours' ranks that were found with no less a score."""
    got = found.select("query_id", "rank", F.col("score").alias("s"))
    both = true.join(got, ["query_id", "rank"], "left")
    return both.agg(F.avg((F.coalesce("s", F.lit(-2.0)) >= F.col("score") - 1e-12).cast("double"))).first()[0] or 1.0
