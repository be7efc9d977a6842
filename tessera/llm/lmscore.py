"""Cross-entropy difference between a target and a background language model.

Both are interpolated bigram models with one shared vocabulary: every word of
the corpus. They are matched in vocabulary, order, smoothing (towards the
words of the whole corpus) and mass (the background's counts are scaled to the
target's total). A document's score is the mean over its tokens of the target's
loss minus the background's: the lower, the more it looks like the target.
A document is scored by models of all other documents: its own counts are taken
off both (off the target's if it is in the target), so that no score tells its
own label back.

Counts cover all documents and grow with them; no model is ever in one place.
Documents are cut into blocks of whole texts. A block sends its distinct words
and word pairs, as 56-bit hashes with their counts, to shards by hash; a shard
adds up the counts of all blocks and sends each block the sums of the keys it
asked for; the block then scores its texts with the part of both models that
they use. Keys are hashed, so that frequent words load no shard more than
others, and a block sends a key once, however often it holds it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ddl, map_batches, pin, quoted

#: Bits of a key; fewer cost less to send, and 10^12 pairs still collide with one in 70,000.
KEY_BITS = 56
#: Rows after which a block ends, however few tokens they have.
BLOCK_ROWS = 100_000
#: Tokens that a block scores at once, whole texts.
SLICE = 1 << 18
_MIX = tuple(np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


def word_hash(word: str) -> int:
    """Key of a word; that of the empty word stands for the start of a text."""
    import xxhash

    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) >> (64 - KEY_BITS)


def pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys of word pairs from the keys of their words."""
    with np.errstate(over="ignore"):
        h = (before * _MIX[0]) ^ ((words ^ (words >> np.uint64(31))) * _MIX[1])
        h = (h ^ (h >> np.uint64(29))) * _MIX[2]
    return (h ^ (h >> np.uint64(32))) >> np.uint64(64 - KEY_BITS)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on as compressed byte planes: small ones cost little."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def unpack(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _sorted_pack(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def _sorted_unpack(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n), dtype=np.uint64)


# A block: ids, numbers of tokens and kept columns of its rows, the keys of its
# words (word 0 is the start of a text), and the word numbers of all tokens.
_BLOCK = "lengths array<bigint>, n_words bigint, n_tokens bigint, words binary, text binary"


def _cut(block_tokens: int):
    """Blocks of the rows ``(id, kept, text)`` of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        task, number = TaskContext.get().partitionId(), 0
        index, parts, ids, lengths, size = None, [], [], [], 0

        def block() -> dict:
            text = np.concatenate(ids)
            keys = np.fromiter(map(word_hash, index), np.uint64, len(index))
            made = {"block": task << 32 | number, "lengths": lengths, "n_words": len(keys), "n_tokens": len(text),
                    "words": pack(keys), "text": pack(text)}
            whole = pa.Table.from_batches(parts).combine_chunks()
            lists = {c: pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), whole[n].combine_chunks())
                     for c, n in (("ids", "id"), ("kept", "kept"))}
            return {k: [v] for k, v in made.items()} | lists

        for batch in batches:
            start = 0
            for at, text in enumerate(batch["text"]):
                if index is None:
                    index = defaultdict()
                    index.default_factory = index.__len__
                    index[""]
                words = tokens(text.as_py())
                ids.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
                lengths.append(len(words))
                size += len(words)
                if size >= block_tokens or len(lengths) >= BLOCK_ROWS:
                    parts.append(batch.select(["id", "kept"]).slice(start, at + 1 - start))
                    yield block()
                    number, start = number + 1, at + 1
                    index, parts, ids, lengths, size = None, [], [], [], 0
            if start < batch.num_rows:
                parts.append(batch.select(["id", "kept"]).slice(start))
        if lengths:
            yield block()

    return run


class _Block:
    """The tokens of a block, and before each the one it follows in its text."""

    def __init__(self, row: dict) -> None:
        keys = unpack(row["words"], row["n_words"])
        self.lengths = np.array(row["lengths"], np.int64)
        self.text = unpack(row["text"], row["n_tokens"]).astype(np.int64)
        self.before = np.roll(self.text, 1)
        ends = np.cumsum(self.lengths)
        self.before[(ends - self.lengths)[self.lengths > 0]] = 0
        #: Distinct word keys in order, and the place of each word number among them.
        self.words, self.place = np.unique(keys, return_inverse=True)
        self.pairs, self.pair = np.unique(pair_keys(keys[self.before], keys[self.text]), return_inverse=True)

    def slices(self) -> Iterator[tuple[int, int, slice]]:
        """First and last row of runs of whole texts of about ``SLICE`` tokens, and where their tokens lie."""
        ends = np.cumsum(self.lengths)
        cuts = np.unique(np.r_[0, np.searchsorted(ends, np.arange(SLICE, len(self.text), SLICE)) + 1, len(ends)])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield lo, hi, slice(int(ends[lo - 1]) if lo else 0, int(ends[hi - 1]))

    def counts(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of words and of pairs in the marked rows. The start of a text
        counts once for every text with a token."""
        own = np.repeat(rows, self.lengths)
        words = np.bincount(self.place[self.text[own]], minlength=len(self.words))
        words[self.place[0]] += np.count_nonzero(self.lengths[rows])
        return words, np.bincount(self.pair[own], minlength=len(self.pairs))


def _rows(blocks: pa.Table) -> list[dict]:
    return blocks.select(["block", "lengths", "n_words", "n_tokens", "words", "text"]).to_pylist()


def _shard_bounds(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each of 2**bits shards, ranges of the key, begins and the last one ends."""
    starts = np.array([s << (KEY_BITS - bits) for s in range(1, 1 << bits)], np.uint64)
    return np.r_[0, np.searchsorted(keys, starts), len(keys)]


#: Answers of words are of kind 0, of pairs 1; rows of this kind name the target's rows of a block.
MARKED = 2
_ASK = "shard bigint, block bigint, kind int, n bigint, keys binary, t binary, b binary"
_ANSWER = "shard bigint, block bigint, kind int, n bigint, t binary, b binary"
_ASK_TYPES = {"shard": pa.int64(), "block": pa.int64(), "kind": pa.int32(), "n": pa.int64(), "keys": pa.binary(), "t": pa.binary(),
              "b": pa.binary()}


def _ask(bits: int):
    def run(blocks: pa.Table, target: pa.Table) -> pa.Table:
        made: list[tuple] = []
        for row in _rows(blocks):
            block = _Block(row)
            own = np.zeros(len(block.lengths), bool)
            own[target["pos"].to_numpy()] = True
            for kind, keys, t, b in zip((0, 1), (block.words, block.pairs), block.counts(own), block.counts(np.ones_like(own))):
                bounds = _shard_bounds(keys, bits)
                for shard in np.flatnonzero(np.diff(bounds)).tolist():
                    s = slice(bounds[shard], bounds[shard + 1])
                    made.append((shard, row["block"], kind, s.stop - s.start, _sorted_pack(keys[s]), pack(t[s]), pack(b[s])))
        columns = list(zip(*made)) or [()] * len(_ASK_TYPES)
        return pa.table({c: pa.array(v, t) for (c, t), v in zip(_ASK_TYPES.items(), columns)})

    return run


def _answer(asked: pa.Table) -> pa.Table:
    """The sums over all blocks for each block's keys, in the order it sent them."""
    ns = asked["n"].to_numpy()
    packed = lambda c, of: [of(d, n) for d, n in zip(asked[c].to_pylist(), ns.tolist())]
    keys, place = np.unique(np.concatenate(packed("keys", _sorted_unpack)), return_inverse=True)
    out = asked.drop_columns(["keys", "t", "b"])
    for c in ("t", "b"):
        total = np.zeros(len(keys), np.uint64)
        np.add.at(total, place, np.concatenate(packed(c, unpack)))
        out = out.append_column(c, pa.array([pack(x) for x in np.split(total[place], np.cumsum(ns)[:-1])], pa.binary()))
    return out


def _own(rows: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    """For each token, how often its row has the same number ``of``."""
    _, place, count = np.unique(rows * size + of, return_inverse=True, return_counts=True)
    return count[place]


def _score(n_target: int, n_all: int, mixture: float, prior: float):
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        parts = sorted(answers.to_pylist(), key=lambda r: (r["kind"], r["shard"]))
        of = lambda c, kind: np.concatenate(
            [np.zeros(0, np.uint64), *(unpack(r[c], r["n"]) for r in parts if r["kind"] == kind)]).astype(float)
        marked = np.array([r["n"] for r in parts if r["kind"] == MARKED], np.int64)
        t_words, t_pairs, all_words, all_pairs = of("t", 0), of("t", 1), of("b", 0), of("b", 1)
        scores, lengths = [], []
        for row in _rows(blocks):
            block = _Block(row)
            in_target = np.zeros(len(block.lengths))
            in_target[marked] = 1.0
            for lo, hi, own in block.slices():
                rows, loss = np.repeat(np.arange(hi - lo), block.lengths[lo:hi]), []
                word, pair, before = block.place[block.text[own]], block.pair[own], block.place[block.before[own]]
                # What a token's own document has of its word, its pair and its first word (the start: once).
                own_word, own_pair = _own(rows, word, len(block.words)), _own(rows, pair, len(block.pairs))
                own_before = np.where(block.before[own] == 0, 1, np.roll(own_word, 1))
                size, is_in = block.lengths[lo:hi][rows], in_target[lo:hi][rows]
                common = (all_words[word] - own_word + 1) / (n_all - size + 1)
                t_mass, b_mass = n_target - size * is_in, (n_all - size).astype(float)
                scale = np.divide(t_mass, b_mass, out=np.ones(len(rows)), where=(t_mass > 0) & (b_mass > 0))
                for words, pairs, out, f, mass in ((t_words, t_pairs, is_in, 1.0, t_mass), (all_words, all_pairs, 1.0, scale, b_mass * scale)):
                    seen, both, first = ((x - n * out) * f for x, n in (
                        (words[word], own_word), (pairs[pair], own_pair), (words[before], own_before)))
                    share = np.divide(both, first, out=np.zeros(len(both)), where=first > 0)
                    loss.append(-np.log(mixture * share + (1 - mixture) * (seen + prior * common) / (mass + prior)))
                scores.append(np.bincount(rows, loss[0] - loss[1], hi - lo) / np.maximum(block.lengths[lo:hi], 1))
            lengths.append(block.lengths)
        kept = blocks["kept"].combine_chunks().flatten()
        return pa.table({"kept": kept, "score": np.concatenate(scores), "n": np.concatenate(lengths)})

    return run


def score(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
          score_out: str = "score", tokens_out: str = "n_tokens", mixture: float = 0.6, prior: float = 1000.0,
          block_tokens: int = 2_000_000, shard_tokens: int = 2_000_000) -> DataFrame:
    """One row per row: the columns ``keep``, the mean loss difference (target
    minus background, in nats) of the whole text and its number of tokens.

    ``target`` holds the ids of the target documents in its first column; the
    background is all documents. A pair's share is its count over that of its
    first word, ends of texts included; a word's own probability counts
    ``prior`` tokens spread as in the whole corpus, every word once more than it
    occurs there. All counts are those of the other rows. A block of texts ends at
    ``block_tokens`` or with its task; there is a shard of counts for every
    ``shard_tokens``. Null ids are never in the target and ids that repeat
    there count once; null and empty texts have no tokens and score 0.0.
    Repeated rows count and return as often as they occur. Without target
    documents the target model is the prior alone. No rows give no rows.
    """
    kept = F.struct(*quoted(keep)) if keep else F.struct(F.lit(True).alias("__none"))
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), kept.alias("kept"))
    one = f"struct<{(ddl(docs, keep) or '__none boolean, ')[:-2]}>"
    blocks = pin(map_batches(rows, _cut(block_tokens), f"block bigint, ids array<{dict(rows.dtypes)['id']}>, kept array<{one}>, {_BLOCK}"))
    wanted = target.select(F.col(target.columns[0]).alias("t")).where("t is not null").distinct()
    placed = blocks.select("block", F.posexplode(F.arrays_zip("ids", "lengths")).alias("pos", "row"))
    placed = placed.select("block", "pos", F.col("row.ids").alias("id"), F.col("row.lengths").alias("n"))
    marked = pin(placed.join(wanted, placed["id"] == wanted["t"]).select("block", "pos", "n"))
    total = lambda df, c: df.agg(F.sum(c)).first()[0] or 0
    n_all, n_target = total(blocks, "n_tokens"), total(marked, "n")
    bits = max(0, ceil(log2(max(1, n_all) / shard_tokens)))
    # Both uses of the blocks share one shuffle.
    by_block = blocks.groupBy("block")
    asked = by_block.cogroup(marked.groupBy("block")).applyInArrow(_ask(bits), _ASK)
    none = F.lit(None).cast("binary")
    flags = marked.select(F.lit(0).cast("bigint").alias("shard"), "block", F.lit(MARKED).alias("kind"), F.col("pos").cast("bigint").alias("n"),
                          none.alias("t"), none.alias("b"))
    answers = asked.groupBy("shard", "kind").applyInArrow(_answer, _ANSWER).unionByName(flags)
    scored = by_block.cogroup(answers.groupBy("block")).applyInArrow(_score(n_target, n_all, mixture, prior), f"kept {one}, score double, n bigint")
    return scored.select(*[F.col("kept")[c].alias(c) for c in keep], F.col("score").alias(score_out), F.col("n").alias(tokens_out))
