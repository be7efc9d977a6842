"""SimHash near-dedup: 64-bit fingerprints linked at a small Hamming distance.

Fingerprints within 3 bits agree on at least one of four 16-bit blocks, so the
distinct fingerprints are dealt into shards by block value; each shard is a
BK-tree whose children are keyed by the integer Hamming distance to their
parent, and a lookup follows only edges within the radius. A shard above
``shard_rows`` is dealt again by the 12-bit parts of its other 48 bits, which
again must agree on one, and what is still above it is cut into slices whose
pairs are searched slice against slice. Every pair within the radius meets in
some tree at every size; no shard, slice or bucket has a cap.

The method's trees are broadcast shards. All fingerprints together grow with
the corpus and have no size bound, so here each tree is built in the task that
holds its shard and the lookups are shuffled to it.

A shard reports a spanning forest of its links, enough for the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_texts, pin, text_of
from tessera.llm.components import connected_components

#: Shingles hashed at once, so that one very long text needs bounded memory.
CHUNK = 1 << 16
#: Fingerprints that one tree holds.
SHARD_ROWS = 1024


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """SimHash of ``words``-word shingles (repeats included) of the text with
    A-Z lower-cased: bit i is set if over half the XXH64 values have it. Fewer
    words: the whole sequence is one shingle. None or no word: 0."""
    import xxhash

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    if len(w) < words:
        shingles = iter([b" ".join(w)])
    else:
        shingles = map(b" ".join, zip(*(islice(w, k, None) for k in range(words))))
    values = map(partial(xxhash.xxh64_intdigest, seed=seed), shingles)
    ones, n = np.zeros(64, np.int64), 0
    while len(part := np.fromiter(islice(values, CHUNK), np.uint64)):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


class BKTree:
    """Distinct integers in a tree: a child's key is its Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at = 0
        while self.values:
            edge = (self.values[at] ^ value).bit_count()
            nxt = self.children[at].get(edge)
            if nxt is None:
                self.children[at][edge] = len(self.values)
                break
            at = nxt
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Positions (in order of insertion) of the values within the radius."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            todo += [c for e, c in self.children[at].items() if d - radius <= e <= d + radius]
        return found


def _forest(fps: list[int], ids: list[int], sides: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of one shard's links. Side 0 is only in the tree,
    side 1 only looks up, side 2 does both."""
    tree, placed, parent = BKTree(), [], list(range(len(fps)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for k in sorted(range(len(fps)), key=lambda k: sides[k] == 1):
        if sides[k]:
            for hit in tree.within(fps[k], radius):
                p, q = root(placed[hit]), root(k)
                if p != q:
                    parent[q] = p
                    yield ids[placed[hit]], ids[k]
        if sides[k] != 1:
            tree.add(fps[k])
            placed.append(k)


def _search(radius: int):
    key = ["k1", "k2", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by shard; the last shard of a batch waits for the next one."""
        rest = None
        for pdf in _with_end(batches):
            whole = rest if pdf is None else pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if whole is None or not len(whole):
                continue
            keys = whole[key].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            ends = np.r_[starts[1:], len(whole)]
            if pdf is not None:
                rest = whole.iloc[starts[-1]:]
                starts, ends = starts[:-1], ends[:-1]
            fps, ids, sides = whole["fp"].to_numpy().view(np.uint64), whole["id"].to_numpy(), whole["side"].to_numpy()
            out = []
            for s, e in zip(starts, ends):
                if e - s > 1:
                    out += _forest(fps[s:e].tolist(), ids[s:e].tolist(), sides[s:e].tolist(), radius)
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    return run


def _with_end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | None]:
    yield from batches
    yield None


def _others(block: Column, fp: Column) -> Column:
    """The 48 bits outside a 16-bit block, closed up."""
    high = lambda shift, at: F.shiftleft(F.shiftrightunsigned(fp, shift), at)
    return (F.when(block == 0, F.shiftrightunsigned(fp, 16))
            .when(block == 1, high(32, 16).bitwiseOR(fp.bitwiseAND(0xFFFF)))
            .when(block == 2, high(48, 32).bitwiseOR(fp.bitwiseAND(0xFFFFFFFF)))
            .otherwise(fp.bitwiseAND(0xFFFFFFFFFFFF)))


def links(nodes: DataFrame, radius: int = 3, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(a, b)`` ids of ``nodes(fp, id)``, whose fingerprints are distinct: a
    spanning forest, shard by shard, of all pairs within ``radius`` <= 3."""
    if not 0 <= radius <= 3:
        raise ValueError("four blocks find every pair up to a radius of 3")
    fp = F.col("fp")
    blocks = F.array(*[F.shiftrightunsigned(fp, 16 * b).bitwiseAND(0xFFFF) for b in range(4)])
    keyed = (nodes.select("fp", "id", F.posexplode(blocks).alias("block", "value"))
             .select("fp", "id", "block", (F.col("block") * 65536 + F.col("value")).alias("k1")))
    # There are 4 x 65,536 values of k1, which bounds this broadcast.
    large = F.broadcast(keyed.groupBy("k1").count().where(F.col("count") > shard_rows).select("k1"))
    one = keyed.join(large, "k1", "left_anti").select(
        "k1", F.lit(-1).cast("bigint").alias("k2"), F.lit(0).alias("i"), F.lit(0).alias("j"),
        F.lit(2).alias("side"), "fp", "id")

    rest = _others(F.col("block"), fp)
    parts = F.array(*[F.shiftrightunsigned(rest, 12 * s).bitwiseAND(0xFFF) for s in range(4)])
    again = (keyed.join(large, "k1", "left_semi")
             .select("k1", "fp", "id", F.posexplode(parts).alias("part", "value"))
             .select("k1", (F.col("part") * 4096 + F.col("value")).cast("bigint").alias("k2"), "fp", "id"))
    slices = pin(again.groupBy("k1", "k2").count()
                 .select("k1", "k2", F.ceil(F.col("count") / shard_rows).cast("int").alias("slices")))
    mine, other = F.col("mine"), F.col("other")
    tiles = (again.join(slices, ["k1", "k2"])
             .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
             .select("k1", "k2", F.least(mine, other).alias("i"), F.greatest(mine, other).alias("j"),
                     F.when(mine == other, 2).when(mine < other, 0).otherwise(1).alias("side"), "fp", "id"))
    shards = (one.unionByName(tiles).repartition("k1", "k2", "i", "j")
              .sortWithinPartitions("k1", "k2", "i", "j"))
    return shards.mapInPandas(_search(radius), "a bigint, b bigint")


def _groups(docs: DataFrame, id_col: str, text_col: str, words: int, radius: int, shard_rows: int) -> DataFrame:
    """``(id, key, fp, root, component)``, one row per row of ``docs``: ``key`` is
    the MD5 of the text, ``root`` a fingerprint that stands for the component
    (an id may be the smallest of several components, if it repeats)."""
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    given = docs.select(docs[id_col].cast("bigint").alias("id"), F.unhex(F.md5(text_of(docs, text_col))).alias("key"),
                        docs[text_col].alias("text"))
    rows = pin(map_texts(given, ("id", "key"), given["text"], lambda: lambda t: (signed(fingerprint(t, words)),), "fp bigint"))
    nodes = pin(rows.groupBy("fp").agg(F.min("id").alias("id")))
    found = connected_components(links(nodes.select("fp", F.col("fp").alias("id")), radius, shard_rows))
    rooted = pin(nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "id", F.coalesce("component", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("id").alias("component"))
    named = pin(rooted.drop("id").join(least, "root"))
    return rows.join(named, "fp", "left").select("id", "key", "fp", "root", "component")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                   radius: int = 3, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(id, fp, component)``, one row per row of ``docs``: the fingerprint as
    a bigint and the smallest id that links reach, the row's own included.

    Null and empty texts have fingerprint 0, linked like any other. Repeated
    rows and equal texts share a fingerprint and so a component. Rows with a
    null id join a component but name none: where all
    rows of a component lack an id, ``component`` is null. Other columns are
    not read, whatever their names. No rows give no rows.
    """
    return _groups(docs, id_col, text_col, words, radius, shard_rows).drop("key", "root")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                  radius: int = 3, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row of each component, with all its columns: the one with the
    smallest id. Rows are told apart by id and text, not by id alone: where an
    id repeats with texts of different components, each component keeps its own
    row, and where it repeats inside one, the text with the smallest MD5 stays.

    Of rows that repeat both id and text one stays. Rows with a null id stay,
    as no component can be named by them. Null and empty texts are copies of
    one another. Column names may clash with none here. No rows give no rows.
    """
    keyed = _groups(docs, id_col, text_col, words, radius, shard_rows).where(F.col("id").isNotNull())
    texts = keyed.groupBy("root", "id", "key").agg(F.count(F.lit(1)).alias("n"))
    stays = pin(texts.groupBy("root").agg(F.min(F.struct("id", "key", "n")).alias("s")).select("s.*"))
    own = [docs[id_col].cast("bigint"), F.unhex(F.md5(text_of(docs, text_col)))]
    of = lambda some: (own[0] == some["id"]) & (own[1] == some["key"])
    once, again = stays.where("n = 1"), stays.where("n > 1")
    kept = docs.where(own[0].isNull()).unionAll(docs.join(once, of(once), "left_semi"))
    if again.isEmpty():
        return kept
    names = [f"c{k}" for k in range(len(docs.columns))]
    repeats = docs.join(again, of(again), "left_semi").select("*", own[0].alias("__id"), own[1].alias("__key")).toDF(*names, "id", "key")
    return kept.unionAll(repeats.dropDuplicates(["id", "key"]).select(*names))
