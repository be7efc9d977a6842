"""Byte-level BPE with a published vocabulary.

The pre-tokeniser's pattern cuts a text into pieces; the bytes of a piece are
merged pair by pair, always the pair of lowest rank and of those the leftmost.
A segment tree over the ranks of adjacent pairs gives that pair at its root; a
merge changes three leaves, each in logarithmic time, so that a piece of any
length, such as a text without spaces, costs n log n.

The vocabulary file is read from a path that executors can open.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

from pyspark.sql import DataFrame

from tessera.llm.common import map_texts

#: Fixed value: how byte-level BPE cuts a text into pieces.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces of up to LONG characters are remembered, up to CACHE of them a task.
LONG, CACHE = 64, 1_000_000


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary:
    a printable Latin-1 character for itself, the others from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


#: A leaf of the tree is rank << BITS | position, so that the smallest number
#: is the lowest rank and of equal ranks the leftmost pair.
BITS = 40


class PairTree:
    """Minimum of (rank, position) over adjacent pairs; the root ``best[1]`` is the next merge."""

    def __init__(self, ranks: list[int], none: int) -> None:
        self.size = size = 1 << max(0, len(ranks) - 1).bit_length()
        self.best = best = [none << BITS] * (2 * size)
        best[size:size + len(ranks)] = [r << BITS | k for k, r in enumerate(ranks)]
        for k in range(size - 1, 0, -1):
            a, b = best[2 * k], best[2 * k + 1]
            best[k] = a if a < b else b

    def set(self, left: int, left_rank: int, at: int, rank: int, right: int, right_rank: int) -> None:
        """Change the ranks of three pairs, which mostly share their ancestors."""
        best = self.best
        i, k, j = left + self.size, at + self.size, right + self.size
        best[i], best[k], best[j] = left_rank << BITS | left, rank << BITS | at, right_rank << BITS | right
        while k > 1:
            i, k, j = i >> 1, k >> 1, j >> 1
            if i != k:
                a, b = best[2 * i], best[2 * i + 1]
                best[i] = a if a < b else b
            if j != k:
                a, b = best[2 * j], best[2 * j + 1]
                best[j] = a if a < b else b
            a, b = best[2 * k], best[2 * k + 1]
            best[k] = a if a < b else b


class Bpe:
    """Vocabulary, merges and special tokens of one tokenizer file."""

    def __init__(self, raw: str) -> None:
        import regex

        spec = json.loads(raw)
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        #: left id << 32 | right id -> rank, and the merged id of each rank.
        self.ranks = {vocab[a] << 32 | vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        letters = byte_letters()
        self.byte_id = [vocab[letters[b]] for b in range(256)]
        of = {c: b for b, c in letters.items()}
        self.bytes_of = {i: bytes(of[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.pieces = regex.compile(PATTERN).findall
        self.split_special = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.memory: dict[str, tuple[int, ...]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        ids = [self.byte_id[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        get, none = self.ranks.get, len(self.merged)
        tree = PairTree([get(a << 32 | b, none) for a, b in zip(ids, ids[1:])], none)
        best, put, stop = tree.best, tree.set, none << BITS
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (top := best[1]) < stop:
            at = top & ((1 << BITS) - 1)
            right = after[at]
            ids[at] = new = self.merged[top >> BITS]
            ids[right] = -1
            end = after[at] = after[right]
            rank = left_rank = none
            if end < n:
                before[end] = at
                rank = get(new << 32 | ids[end], none)
            left = before[at]
            if left >= 0:
                left_rank = get(ids[left] << 32 | new, none)
            else:
                left, left_rank = at, rank
            if right < n - 1:
                put(left, left_rank, at, rank, right, none)
            else:
                put(left, left_rank, at, rank, at, rank)
        return [i for i in ids if i >= 0]

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        ids = self.memory.get(piece)
        if ids is None:
            ids = tuple(self.merge(piece.encode("utf-8", "surrogatepass")))
            if len(piece) <= LONG:
                if len(self.memory) >= CACHE:
                    self.memory.clear()
                self.memory[piece] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; None is empty. Special tokens in the text get their own id."""
        out: list[int] = []
        if not text:
            return out
        for k, part in enumerate(self.split_special(text) if self.split_special else [text]):
            if k % 2:
                out.append(self.special[part])
                continue
            known = self.memory.get
            for piece in self.pieces(part):
                out += known(piece) or self.encode_piece(piece)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        of = self.bytes_of
        return b"".join([of[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """One tokenizer a Python worker."""
    with open(path, encoding="utf-8") as f:
        return Bpe(f.read())


def bpe_round_trip(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = (),
                   ids_out: str | None = None, text_out: str | None = None) -> DataFrame:
    """One row per row: the columns ``keep``, then ``n_tokens, ids_sha256,
    decoded_sha256`` of the encoded and decoded text, and on request the ids
    and the decoded text themselves.

    Null and empty texts have no tokens and decode to the empty text. Whole
    texts are encoded, whatever their length. Repeated rows give repeated rows;
    columns that are not kept are not read; no rows give no rows.
    ``path`` names the tokenizer file, which executors must be able to open.
    """
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += f", `{ids_out}` array<int>" * bool(ids_out) + f", `{text_out}` string" * bool(text_out)

    def make():
        bpe = load(path)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()

        def of(text: str | None) -> tuple:
            ids = bpe.encode(text)
            back = bpe.decode(ids)
            return (len(ids), sha(",".join(map(str, ids))), sha(back), *[ids] * bool(ids_out), *[back] * bool(text_out))

        return of

    return map_texts(docs, keep, docs[text_col], make, schema)
