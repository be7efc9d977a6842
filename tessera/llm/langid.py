"""Language ID with word-first backoff.

A known word scores by its frequency in each language. An unseen word falls
back to its longest character n-grams that the model knows, then to shorter
ones, down to single characters. A text's language has the largest sum.

Counting covers all training documents: each task counts the words of its
texts and sends partial counts. Every counted word and n-gram stays, in a
distributed table that grows with the input. Texts are scored in blocks: a
block sends its distinct words and their n-grams to shards by hash, and gets
back the counts of those that were seen. No model is ever in one place.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ddl, map_batches, pin, quoted
from tessera.llm.lmscore import BLOCK_ROWS, pack, unpack

UNKNOWN = "und"
#: Distinct words a task holds before it sends its counts.
FLUSH = 200_000
#: Remembered scores of unseen words in a Python worker.
MEMORY = 200_000


def words(text: str) -> list[str]:
    """Lower-cased runs between white space that hold a letter, without the
    characters around the outermost letters."""
    out = text.lower().split()
    return [w for w in (t if t.isalpha() else _strip(t) for t in out) if w]


def _strip(token: str) -> str:
    a, b = 0, len(token)
    while a < b and not token[a].isalpha():
        a += 1
    while b > a and not token[b - 1].isalpha():
        b -= 1
    return token[a:b]


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its edges marked."""
    s = f"\x02{word}\x03" if n > 1 else word
    return [s[i:i + n] for i in range(len(s) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies: ``words`` and, per length, ``grams`` name rows of ``table``."""

    languages: list[str]
    words: dict[str, int]
    grams: list[tuple[int, dict[str, int]]]
    table: np.ndarray
    memory: dict[str, list[int]] = field(default_factory=dict, repr=False)

    def backoff(self, word: str) -> list[int]:
        """Rows of the longest known n-grams of an unseen word; it scores by their mean."""
        rows = self.memory.get(word)
        if rows is None:
            for n, known in self.grams:
                rows = [k for g in grams(word, n) if (k := known.get(g)) is not None]
                if rows:
                    break
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            self.memory[word] = rows = rows or []
        return rows

    def score(self, text: str | None) -> tuple[str, float]:
        """The language and its share of the probability, by the mean score of
        a word. No letter: ``und`` and 0. Ties go to the first language by name."""
        counts = Counter(words(text or ""))
        total = sum(counts.values())
        if not total or not self.languages:
            return UNKNOWN, 0.0
        known, rows, times = self.words.get, [], []
        for w, c in counts.items():
            k = known(w)
            if k is not None:
                rows.append(k)
                times.append(c)
            elif more := self.backoff(w):
                rows += more
                times += [c / len(more)] * len(more)
        sums = np.asarray(times, float) @ self.table[rows] if rows else np.zeros(len(self.languages))
        p = np.exp((sums - sums.max()) / total)
        best = int(sums.argmax())
        return self.languages[best], float(p[best] / p.sum())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    per: dict[str, Counter] = {}
    held = 0
    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"]):
            own = per.setdefault(lang.as_py(), Counter())
            held -= len(own)
            own.update(words(text.as_py()))
            held += len(own)
            if held >= FLUSH:
                yield from _flush(per)
                held = 0
    yield from _flush(per)


def _flush(per: dict[str, Counter]) -> Iterator[dict]:
    for lang, counts in per.items():
        yield {"lang": [lang] * len(counts), "word": list(counts), "n": list(counts.values())}
    per.clear()


def _count_grams(languages: list[str], lengths: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        per: dict[str, dict[str, int]] = {lang: {} for lang in languages}
        for batch in batches:
            held = 0
            for k, lang in enumerate(languages):
                counts = per[lang]
                get = counts.get
                for word, times in zip(batch["word"].to_pylist(), batch[f"n{k}"].to_pylist()):
                    if times:
                        for n in lengths:
                            for g in grams(word, n):
                                counts[g] = get(g, 0) + times
                held += len(counts)
            if held >= FLUSH:
                yield from _flush(per)
                per = {lang: {} for lang in languages}
        yield from _flush(per)

    return run


def _wide(counts: DataFrame, languages: list[str]) -> DataFrame:
    """Counts of each word by language, ``n0, n1, ...``."""
    per = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{k}") for k, lang in enumerate(languages)]
    return pin(counts.groupBy("word").agg(*per))


def _key(n: int, word: str) -> str:
    """Key of a word (``n`` = 0) or of an n-gram."""
    return f"{n}:{word}"


@dataclass
class Scale:
    """What turns counts into log frequencies: by kind (0 for words, else the
    length of n-grams) the sums per language and the number of keys."""

    languages: list[str]
    sums: dict[int, tuple[list[int], int]]
    smoothing: float

    def table(self, kinds: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.zeros(counts.shape, np.float32)
        for n, (sums, size) in self.sums.items():
            own = kinds == n
            out[own] = np.log((counts[own] + self.smoothing) / (np.array(sums, float) + self.smoothing * (size + 1)))
        return out

    def model(self, keys: list[str], counts: np.ndarray) -> LanguageModel:
        """The model of the given keys; those without a count are unknown."""
        parts = [k.split(":", 1) for k in keys]
        kinds, known = np.array([int(n) for n, _ in parts], int), {n: {} for n in self.sums}
        for k in np.flatnonzero(counts.any(axis=1)).tolist():
            known[int(kinds[k])][parts[k][1]] = k
        return LanguageModel(self.languages, known.get(0, {}), [(n, known[n]) for n in known if n], self.table(kinds, counts))


@dataclass
class FittedModel:
    """All counts as a table ``(key, n0, n1, ...)``, one count per language."""

    scale: Scale
    counts: DataFrame | None

    @property
    def languages(self) -> list[str]:
        return self.scale.languages

    @cached_property
    def local(self) -> LanguageModel:
        """The whole model in one place, for single texts and small models only."""
        rows = [] if self.counts is None else self.counts.orderBy("key").collect()
        counts = np.array([r[1:] for r in rows], float).reshape(len(rows), len(self.languages))
        return self.scale.model([r["key"] for r in rows], counts)

    @property
    def words(self) -> dict[str, int]:
        return self.local.words

    @property
    def grams(self) -> list[tuple[int, dict[str, int]]]:
        return self.local.grams

    @property
    def table(self) -> np.ndarray:
        return self.local.table

    def backoff(self, word: str) -> list[int]:
        return self.local.backoff(word)

    def score(self, text: str | None) -> tuple[str, float]:
        return self.local.score(text)


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", lengths: tuple[int, ...] = (4, 3, 2, 1),
        smoothing: float = 0.5) -> FittedModel:
    """Fit on labelled rows; null texts and null labels are left out."""
    text = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    text = text.where("text is not null and lang is not null")
    # Languages are labels, one row each.
    languages = sorted(r["lang"] for r in text.select("lang").distinct().collect())
    if not languages:
        return FittedModel(Scale([], {}, smoothing), None)
    columns, schema = [f"n{k}" for k in range(len(languages))], "lang string, word string, n bigint"
    words_ = _wide(map_batches(text, _count_words, schema), languages)
    grams_ = _wide(map_batches(words_, _count_grams(languages, lengths), schema), languages)
    # An n-gram has n characters.
    both = words_.withColumn("kind", F.lit(0)).unionByName(grams_.withColumn("kind", F.char_length("word")))
    sums = {r["kind"]: ([r[c] for c in columns], r["size"]) for r in both.groupBy("kind").agg(
        F.count(F.lit(1)).alias("size"), *[F.sum(c).alias(c) for c in columns]).collect()}  # one row per length
    kinds = {n: sums.get(n, ([0] * len(columns), 0)) for n in (0, *lengths)}
    return FittedModel(Scale(languages, kinds, smoothing), both.select(F.concat_ws(":", "kind", "word").alias("key"), *columns))


# A block: kept columns and numbers of distinct words of its rows, its words and
# their n-grams, and for each row its word numbers in order, as differences,
# with their counts.
_BLOCK = ("sizes array<bigint>, words_size bigint, words binary, grams_size bigint, grams binary, n bigint, numbers binary, "
          "times binary")


def _squeeze(names: list[str]) -> tuple[int, bytes]:
    """Names without line feeds, compressed, and their length before."""
    data = "\n".join(names).encode()
    return len(data), pa.compress(data, codec="zstd", asbytes=True) if data else b""


def _expand(size: int, data: bytes) -> list[str]:
    return pa.decompress(data, size, codec="zstd", asbytes=True).decode().split("\n") if size else []


def _all_grams(names: list[str], lengths: list[int]) -> list[str]:
    """Keys of all n-grams of the words, and of some that span two words."""
    out = []
    for n in lengths:
        s = "\x02" + "\x03\x02".join(names) + "\x03" if n > 1 else "".join(names)
        letters, codes = np.unique(np.frombuffer(s.encode("utf-32-le"), "<u4"), return_inverse=True)
        if len(letters) ** n >= 1 << 63:  # too many for one number
            out += [_key(n, g) for g in {s[i:i + n] for i in range(len(s) - n + 1)}]
            continue
        m = max(0, len(codes) - n + 1)
        whole = np.unique(sum((codes[k:k + m].astype(np.int64) * len(letters) ** (n - 1 - k) for k in range(n)), np.zeros(m, np.int64)))
        each = [letters[whole // len(letters) ** (n - 1 - k) % len(letters)] for k in range(n)] if len(whole) else []
        text = np.column_stack(each).astype("<u4").tobytes().decode("utf-32-le") if each else ""
        out += [_key(n, text[i:i + n]) for i in range(0, len(text), n)]
    return out


def _cut(block_tokens: int, lengths: list[int]):
    """Blocks of the rows ``(kept, text)`` of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        task, number = TaskContext.get().partitionId(), 0
        index, parts, numbers, times, held = None, [], [], [], 0

        def block() -> dict:
            sizes, names = [len(x) for x in numbers], list(index)
            (words_size, own), (grams_size, parts_) = _squeeze(names), _squeeze(_all_grams(names, lengths))
            steps, counts = np.concatenate([np.diff(x, prepend=0) for x in numbers]), np.concatenate(times)
            made = {"block": task << 32 | number, "sizes": sizes, "words_size": words_size, "words": own,
                    "grams_size": grams_size, "grams": parts_, "n": len(counts), "numbers": pack(steps), "times": pack(counts)}
            whole = pa.Table.from_batches(parts).combine_chunks()
            kept = pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), whole["kept"].combine_chunks())
            return {k: [v] for k, v in made.items()} | {"kept": kept}

        for batch in batches:
            start = 0
            for at, text in enumerate(batch["text"]):
                if index is None:
                    index = defaultdict()
                    index.default_factory = index.__len__
                counts = Counter(words(text.as_py() or ""))
                own = np.fromiter(map(index.__getitem__, counts), np.int64, len(counts))
                order = np.argsort(own)
                numbers.append(own[order])
                times.append(np.fromiter(counts.values(), np.int64, len(counts))[order])
                held += sum(counts.values())
                if held >= block_tokens or len(numbers) >= BLOCK_ROWS:
                    parts.append(batch.select(["kept"]).slice(start, at + 1 - start))
                    yield block()
                    number, start = number + 1, at + 1
                    index, parts, numbers, times, held = None, [], [], [], 0
            if start < batch.num_rows:
                parts.append(batch.select(["kept"]).slice(start))
        if numbers:
            yield block()

    return run


def _asked(row: dict, shards: int) -> tuple[list[str], list[str], list[np.ndarray]]:
    """The words of a block, the keys of words and n-grams, and their places by shard."""
    names = _expand(row["words_size"], row["words"])
    keys = [_key(0, w) for w in names] + _expand(row["grams_size"], row["grams"])
    shard = np.fromiter((zlib.crc32(k.encode()) for k in keys), np.int64, len(keys)) % shards
    return names, keys, np.split(np.argsort(shard, kind="stable"), np.cumsum(np.bincount(shard, minlength=shards))[:-1])


def _ask(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                _, keys, places = _asked(row, shards)
                for shard, at in enumerate(places):
                    if len(at):
                        size, data = _squeeze([keys[k] for k in at.tolist()])
                        yield {"shard": [shard], "block": [row["block"]], "n": [size], "keys": [data]}

    return run


def _answer(columns: list[str]):
    """The counts of each block's keys, in the order it sent them; 0 for unseen ones."""

    def run(asked: pa.Table, counts: pa.Table) -> pa.Table:
        place = {k: i for i, k in enumerate(counts["key"].to_pylist())}
        n = np.vstack([np.column_stack([counts[c].to_numpy() for c in columns]).reshape(-1, len(columns)),
                       np.zeros((1, len(columns)))]).astype(np.int64)
        found = [pack(n[[place.get(k, -1) for k in _expand(*x)]].T.ravel()) for x in zip(asked["n"].to_pylist(), asked["keys"].to_pylist())]
        return pa.table({"shard": asked["shard"], "block": asked["block"], "found": pa.array(found, pa.binary())})

    return run


def _score(scale: Scale, shards: int):
    languages = scale.languages

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        langs, scores = [], []
        for row in blocks.drop_columns(["kept"]).to_pylist():
            names, keys, places = _asked(row, shards)
            counts = np.zeros((len(keys), len(languages)), np.int64)
            for shard, found in zip(answers["shard"].to_pylist(), answers["found"].to_pylist()):
                at = places[shard]
                counts[at] = unpack(found, len(at) * len(languages)).astype(np.int64).reshape(len(languages), -1).T
            model = scale.model(keys, counts)
            each, unseen, rows = model.table[:len(names)].astype(float), [], []
            for k in np.flatnonzero(~counts[:len(names)].any(axis=1)).tolist():
                own = model.backoff(names[k])
                unseen.append((k, len(own)))
                rows += own
            if unseen:
                place, parts = np.array(unseen).T
                means = np.zeros((len(place), len(languages)))
                np.add.at(means, np.repeat(np.arange(len(place)), parts), model.table[rows].astype(float))
                each[place] = means / np.maximum(parts, 1)[:, None]
            sizes = np.array(row["sizes"], np.int64)
            steps, times = (unpack(row[c], row["n"]).astype(np.int64) for c in ("numbers", "times"))
            owner, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(steps)
            # Differences begin anew in every row.
            before = np.r_[0, ends][np.cumsum(sizes) - sizes]
            number = ends - before[owner]
            total = np.bincount(owner, times, len(sizes))
            sums = np.column_stack([np.bincount(owner, times * each[number, k], len(sizes)) for k in range(len(languages))])
            p = np.exp((sums - sums.max(axis=1, keepdims=True)) / np.maximum(total, 1)[:, None])
            best = sums.argmax(axis=1)
            share = p[np.arange(len(best)), best] / p.sum(axis=1)
            langs += [languages[b] if t else UNKNOWN for b, t in zip(best.tolist(), total.tolist())]
            scores.append(np.where(total > 0, share, 0.0))
        kept = blocks["kept"].combine_chunks().flatten()
        return pa.table({"kept": kept, "lang": pa.array(langs, pa.string()), "score": np.concatenate([np.zeros(0), *scores])})

    return run


def predict(docs: DataFrame, model: FittedModel, text_col: str = "text", keep: tuple[str, ...] = (),
            lang_out: str = "lang_pred", score_out: str = "score", block_tokens: int = 2_000_000,
            shard_keys: int = 500_000) -> DataFrame:
    """One row per row: the columns ``keep``, the predicted language and its
    share (0 to 1). Null texts and texts without a letter are ``und`` with 0.
    A block of texts ends at ``block_tokens`` or with its task; there is a
    shard of counts for every ``shard_keys`` keys of the model or the blocks.
    Equal texts get equal answers, equal sums go to the first language by name;
    repeated rows give repeated rows; very long texts are read whole; columns
    that are not kept are not read. No rows give no rows; a model without
    languages answers ``und`` to all."""
    if not model.languages:
        return docs.select(*quoted(keep), F.lit(UNKNOWN).alias(lang_out), F.lit(0.0).alias(score_out))
    kept = F.struct(*quoted(keep)) if keep else F.struct(F.lit(True).alias("__none"))
    one = f"struct<{(ddl(docs, keep) or '__none boolean, ')[:-2]}>"
    rows = docs.select(docs[text_col].cast("string").alias("text"), kept.alias("kept"))
    scale, lengths = model.scale, [n for n in model.scale.sums if n]
    blocks = pin(map_batches(rows, _cut(block_tokens, lengths), f"block bigint, kept array<{one}>, {_BLOCK}"))
    # Words and keys of n-grams have some eight bytes.
    asked_keys = (blocks.agg(F.sum(F.col("words_size") + F.col("grams_size"))).first()[0] or 0) / 8
    shards = max(1, ceil((asked_keys + sum(size for _, size in scale.sums.values())) / shard_keys))
    columns = [f"n{k}" for k in range(len(scale.languages))]
    asked = map_batches(blocks.select("block", "words_size", "words", "grams_size", "grams"), _ask(shards),
                        "shard bigint, block bigint, n bigint, keys binary")
    counts = model.counts.withColumn("shard", F.crc32(F.col("key").cast("binary")) % shards)
    answers = (asked.groupBy("shard").cogroup(counts.groupBy("shard"))
               .applyInArrow(_answer(columns), "shard bigint, block bigint, found binary"))
    scored = (blocks.groupBy("block").cogroup(answers.groupBy("block"))
              .applyInArrow(_score(scale, shards), f"kept {one}, lang string, score double"))
    return scored.select(*[F.col("kept")[c].alias(c) for c in keep], F.col("lang").alias(lang_out), F.col("score").alias(score_out))
