"""Counterfactual-regularised toxicity classifier.

A logistic regression on the presence of words and word beginnings. For each
labelled text that mentions a group, a second reading swaps the identity term
for another one; training penalises the squared change of the score, so the
weight of a group's name is driven towards that of any other group's, and a
neutral mention does not raise the score.

It is fitted on a bounded sample of labelled rows (``max_positive`` and
``max_negative``, taken in a seeded order), which bounds what is broadcast and
what reaches the driver. All texts are scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hash_order, map_batches, map_texts, pin

#: Groups of terms that can stand for one another in a sentence.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "females", "males"),
    ("woman", "man", "girl", "boy", "female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("gay", "lesbian", "bisexual", "transgender", "queer", "straight"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrants", "refugees", "foreigners", "migrants", "natives"),
    ("frauen", "männer", "muslime", "christen", "juden", "ausländer"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros"),
)
#: Lengths of the word beginnings that count as features, and the hash space.
PREFIXES, SPACE = (3, 4, 5, 6), 1 << 22
_WORD = re.compile(r"[^\W\d_]+")


def swaps(terms=IDENTITY_TERMS) -> dict[str, str]:
    """Each term with the next one of its group."""
    return {t: g[(k + 1) % len(g)] for g in terms for k, t in enumerate(g)}


def features(words: set[str]) -> set[int]:
    """Hashed presence features of a set of words."""
    parts = {w[:n] for w in words for n in PREFIXES if len(w) > n}
    return {zlib.crc32(f"={w}".encode()) % SPACE for w in words} | {zlib.crc32(f"^{p}".encode()) % SPACE for p in parts}


def text_words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass
class ToxicityModel:
    weights: dict[int, float]
    bias: float

    def __post_init__(self) -> None:
        self.memory: dict[str, frozenset[int]] = {}

    def score(self, text: str | None) -> float:
        """Probability of label 1; an empty text scores by the bias alone."""
        hit: set[int] = set()
        memory = self.memory
        for w in text_words(text):
            f = memory.get(w)
            if f is None:
                if len(memory) >= 300_000:
                    memory.clear()
                f = memory[w] = frozenset(features({w}) & self.weights.keys())
            if f:
                hit |= f
        z = self.bias + sum(self.weights[f] for f in sorted(hit))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def _featurise(terms):
    other = swaps(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            own, swapped = [], []
            for text in batch["text"]:
                words = text_words(text.as_py())
                own.append(sorted(features(words)))
                swapped.append(sorted(features({other.get(w, w) for w in words})) if words & other.keys() else None)
            yield {"label": batch["label"], "own": own, "swapped": swapped}

    return run


def select_features(found: DataFrame, size: int) -> list[int]:
    """The ``size`` feature hashes whose frequencies differ most between the
    labels of ``found(label, own)``, in at least three texts each."""
    n = found.agg(F.sum(F.col("label")).alias("n1"), F.count(F.lit(1)).alias("n")).first()
    n1, n0 = n["n1"] or 0, n["n"] - (n["n1"] or 0)
    counts = (found.select("label", F.explode("own").alias("feature")).groupBy("feature")
              .agg(F.sum("label").alias("d1"), F.count(F.lit(1)).alias("d")).where("d >= 3"))
    p1 = (F.col("d1") + 0.5) / F.lit(n1 + 1.0)
    p0 = (F.col("d") - F.col("d1") + 0.5) / F.lit(n0 + 1.0)
    gain = (p1 - p0) * (F.log(p1) - F.log(p0))
    top = counts.select("feature", gain.alias("gain")).where("gain > 0").orderBy(F.desc("gain"), "feature").limit(size)
    return sorted(r["feature"] for r in top.collect())


def _pairs(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of lists of columns."""
    lengths = [len(x) for x in rows]
    flat = np.concatenate([np.asarray(x, np.int64) for x in rows]) if sum(lengths) else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(rows)), lengths), flat


def loss_gradient(labels: np.ndarray, own: list, swapped: list, size: int, penalty: float, ridge: float):
    """The gradient by weights and, last, intercept of: half of each class's mean
    log loss + ``penalty`` * mean squared score change under swaps + ``ridge`` / 2
    * squared weights."""
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    r, c = _pairs(own)
    both = [k for k, s in enumerate(swapped) if s is not None]
    ra, ca = _pairs([own[k] for k in both])
    rb, cb = _pairs([swapped[k] for k in both])
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0)

    def at(w: np.ndarray, b: float) -> np.ndarray:
        z = np.bincount(r, w[c], len(labels)) + b
        err = weight * (1 / (1 + np.exp(-z)) - labels)
        g = np.append(np.bincount(c, err[r], size) + ridge * w, err.sum())
        if both:
            d = (np.bincount(ra, w[ca], len(both)) - np.bincount(rb, w[cb], len(both))) * (2 * penalty / len(both))
            g[:-1] += np.bincount(ca, d[ra], size) - np.bincount(cb, d[rb], size)
        return g

    return at


def train(labels: np.ndarray, own: list, swapped: list, columns: list[int], penalty: float = 1.0,
          ridge: float = 1e-4, steps: int = 400, rate: float = 0.1) -> ToxicityModel:
    """Minimise log loss (classes balanced) + ``penalty`` * (score change)² +
    ridge by Adam. ``own`` and ``swapped`` hold column numbers of ``columns``;
    ``swapped`` is None where a text mentions no group."""
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    if not n1 or not n0:
        share = (n1 + 0.5) / (n1 + n0 + 1.0) if n1 + n0 else 0.01
        return ToxicityModel({}, float(np.log(share / (1 - share))))
    size = len(columns)
    gradient = loss_gradient(labels, own, swapped, size, penalty, ridge)
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        g = gradient(w, b)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return ToxicityModel({h: float(x) for h, x in zip(columns, w) if x}, float(b))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_positive: int = 6000, max_negative: int = 12000, size: int = 3000, terms=IDENTITY_TERMS,
        penalty: float = 1.0, seed: int = 3) -> ToxicityModel:
    """Fit on ``docs`` whose id is in ``labels``: at most ``max_positive`` and
    ``max_negative`` labelled rows in seeded order, and of their words and word
    beginnings the ``size`` that differ most between the labels. Null ids,
    labels and texts are left out; an id with several labels counts with each of
    them; of texts that share an id the first by code units counts, so that what
    reaches the driver is bounded. With one label or none the model is that
    label's share."""
    rows = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("label"))
    rows = rows.where("l_id is not null and label in (0, 1)")
    pick = lambda y, n: rows.where(F.col("label") == y).orderBy(hash_order(F.col("l_id"), seed), "l_id").limit(n)
    # At most max_positive + max_negative rows of two numbers.
    sample = F.broadcast(pin(pick(1, max_positive).unionAll(pick(0, max_negative))))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).where("text is not null")
    wide = "label int, own array<int>, swapped array<int>"
    one = texts.join(sample, texts["id"] == F.col("l_id")).groupBy("l_id", "label").agg(F.min("text").alias("text"))
    found = pin(map_batches(one.select("label", "text"), _featurise(terms), wide))
    chosen = select_features(found, size)
    place = dict(zip(chosen, range(len(chosen))))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        on = lambda col: [None if x is None else [place[h] for h in x if h in place] for x in col.to_pylist()]
        for batch in batches:
            yield {"label": batch["label"], "own": on(batch["own"]), "swapped": on(batch["swapped"])}

    rows = map_batches(found, numbered, wide).toPandas()
    return train(rows["label"].to_numpy(np.int64), list(rows["own"]), list(rows["swapped"]), chosen, penalty)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: tuple[str, ...] = (),
          score_out: str = "score") -> DataFrame:
    """One row per row: the columns ``keep`` and the probability of label 1 for
    the whole text (null counts as empty, whose score is the intercept's). Very
    long texts are read whole; repeated rows give repeated rows and equal texts
    equal scores; columns that are not kept are not read, and kept ones may have
    any name but ``score_out``; no rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        return lambda text: (model.score(text),)

    return map_texts(docs, keep, docs[text_col], make, f"`{score_out}` double")
