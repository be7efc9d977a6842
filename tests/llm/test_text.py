"""Language ID, LM scores, toxicity and BPE against brute force, with edge cases."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import bpe, langid, lmscore, toxicity
from tessera.llm.queries import op1_language_id, op2_lm_score, op3_toxicity, tokenizer_path

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, score string"


# --- language ID ------------------------------------------------------------

def test_words_and_grams():
    assert langid.words("The 'cat', 3 — sat-down!  …") == ["the", "cat", "sat-down"]
    assert langid.grams("ab", 3) == ["\x02ab", "ab\x03"] and langid.grams("ab", 1) == ["a", "b"] and langid.grams("a", 4) == []


def train_rows(spark):
    rows = [(1, "the cat and the dog", "en", "x"), (2, "le chat et le chien", "fr", "x"), (3, None, "fr", "x"), (4, "lost", None, "x"),
            (5, "the cat and the dog", "en", "x"), (6, "", "en", None)]
    return spark.createDataFrame(rows, DOCS)


def test_word_first_then_shorter_grams(spark):
    model = langid.fit(train_rows(spark))
    assert model.languages == ["en", "fr"]
    n = Counter("the cat and the dog the cat and the dog".split()), Counter("le chat et le chien".split())
    size = len(n[0] | n[1]) + 1
    want = [math.log((c["the"] + 0.5) / (sum(c.values()) + 0.5 * size)) for c in n]
    assert np.allclose(model.table[model.words["the"]], want, atol=1e-5)
    assert model.score("THE the") == ("en", pytest.approx(1 / (1 + math.exp(want[1] - want[0])), abs=1e-5))
    known = [g for n_, known in model.grams if n_ == 4 for g in langid.grams("chatte", 4) if g in known]
    assert known  # an unseen word scores by its longest known n-grams only
    assert model.backoff("chatte") == [dict(model.grams)[4][g] for g in known]
    assert model.score("chatte")[0] == "fr" and model.score("qqq 123")[0] in ("en", "fr")


def test_predict_edges(spark):
    model = langid.fit(train_rows(spark))
    rows = spark.createDataFrame([(1, None, "en", "s"), (2, "", "en", "s"), (3, "12 … 3", "en", "s"), (4, "日本", "en", "s"),
                                  (5, "le " * 50_000, "en", "s"), (5, "le " * 50_000, "en", "s")], DOCS)
    got = langid.predict(rows, model, keep=("doc_id", "score"), score_out="share").collect()
    by = {r["doc_id"]: r for r in got}
    assert [by[k]["lang_pred"] for k in (1, 2, 3)] == ["und"] * 3 and by[1]["share"] == 0.0
    assert by[4]["lang_pred"] == "en" and by[4]["share"] == pytest.approx(0.5)  # nothing known: a tie
    assert by[5]["lang_pred"] == "fr" and by[5]["score"] == "s" and len(got) == 6


def test_no_training_rows(spark):
    model = langid.fit(spark.createDataFrame([], DOCS))
    got = langid.predict(train_rows(spark), model, keep=("doc_id",)).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)} and len(got) == 6


def test_rare_language_keeps_every_word_and_gram(spark):
    # More types than any former bound: 60,000 frequent ones of one language, and seldom ones of another.
    letters = "abcdefghijklmnopqrst"
    name = lambda i: "".join(letters[i // 20 ** k % 20] for k in range(4))
    rows = [(i, f"{name(i)} {name(i)}", "en", "x") for i in range(60_000)] + [(60_000, "zuvwx yzzvu", "fr", "x")]
    model = langid.fit(spark.createDataFrame(rows, DOCS).repartition(4))
    assert len(model.words) == 60_002 and len(dict(model.grams)[4]) > 60_000
    docs = spark.createDataFrame([(1, "zuvwx", "", "s"), (2, "xyzzvuy", "", "s"), (3, name(59_999), "", "s"), (4, None, "", "s"),
                                  (5, "zuvwx abcd " * 3 + "qq 日本", "", "s")], DOCS)
    for sizes in ({}, {"block_tokens": 1, "shard_keys": 5_000}):
        got = {r["doc_id"]: r for r in langid.predict(docs, model, keep=("doc_id",), **sizes).collect()}
        assert [got[k]["lang_pred"] for k in (1, 2, 3, 4)] == ["fr", "fr", "en", "und"]
        for r in docs.collect():  # shards and blocks give what the whole model gives
            lang, share = model.score(r["text"])
            assert got[r["doc_id"]]["lang_pred"] == lang and got[r["doc_id"]]["score"] == pytest.approx(share, abs=1e-6)


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op1_language_id(spark, SF).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(docs[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) > 0.97


# --- LM scoring -------------------------------------------------------------

def lm_brute(rows, target, mixture=0.6, prior=1000.0):
    """Score and number of tokens of each ``(id, text)`` from dense counts of all other rows."""
    texts = [(i in target, ["", *(t or "").lower().split()]) for i, t in rows]
    uni, bi = [Counter(), Counter()], [Counter(), Counter()]
    for own, words in texts:
        for m in (0, 1) if own else (1,):
            uni[m].update(words if len(words) > 1 else [])
            bi[m].update(zip(words, words[1:]))
    total = [sum(n for w, n in u.items() if w) for u in uni]
    out = []
    for own, words in texts:
        mine, pairs, n, diff = Counter(words), Counter(zip(words, words[1:])), len(words) - 1, 0.0
        mass = [total[0] - n * own, total[1] - n]
        scale = [1.0, mass[0] / mass[1] if mass[0] and mass[1] else 1.0]
        for prev, w in zip(words, words[1:]):
            loss = []
            for m, off in ((0, own), (1, 1)):
                first, both, seen = uni[m][prev] - mine[prev] * off, bi[m][prev, w] - pairs[prev, w] * off, uni[m][w] - mine[w] * off
                common = (uni[1][w] - mine[w] + 1) / (total[1] - n + 1)
                loss.append(-math.log(mixture * (both / first if first else 0.0) + (1 - mixture)
                                      * (seen * scale[m] + prior * common) / (mass[m] * scale[m] + prior)))
            diff += loss[0] - loss[1]
        out.append((diff / max(1, n), n))
    return out


def check_lm(spark, rows, target, **sizes):
    docs = spark.createDataFrame([(k, i, t, "x") for k, (i, t) in enumerate(rows)], "`a b` bigint, doc_id bigint, text string, score string")
    ids = spark.createDataFrame([(i,) for i in target], "t bigint")
    got = {r["a b"]: r for r in lmscore.score(docs, ids, keep=("a b", "doc_id"), **sizes).collect()}
    want = lm_brute(rows, set(target) - {None})
    assert sorted(got) == list(range(len(rows)))
    for k, (score, n) in enumerate(want):
        assert got[k]["n_tokens"] == n and got[k]["score"] == pytest.approx(score, abs=1e-9) and got[k]["doc_id"] == rows[k][0]
    return [got[k]["score"] for k in range(len(rows))]


def test_lm_scores_match_dense_counts(spark):
    rows = [(1, "a b a b c"), (2, "a B c"), (3, "x y x y z q"), (4, None), (5, ""), (None, "a x"), (6, "x y"), (1, "a b a b c"), (7, "z " * 3000),
            (8, "a b c"), (9, "x y z")]
    got = check_lm(spark, rows, [1, 2, 2, 4, None])
    assert got[9] < 0 < got[10] and got[3] == got[4] == 0.0  # neither is in the target


def test_lm_does_not_tell_a_label_back(spark):
    """Documents whose words no other has score 0, in the target or not; a copy in the target lowers a score."""
    rows = [(k, " ".join(f"only{k}x{j}" for j in range(9))) for k in range(20)] + [(100, "p q r s"), (101, "p q r s"), (102, "t u v w"), (103, "t u v w")]
    got = check_lm(spark, rows, [*range(10), 100, 101])
    assert all(abs(s) < 1e-9 for s in got[:20]) and got[20] < -0.01 and got[22] > 0.01


def test_lm_of_one_document(spark):
    assert check_lm(spark, [(1, "a b a")], [1]) == [0.0] == check_lm(spark, [(1, "a b a")], [])


@pytest.mark.parametrize("tokens", [1 << 18, 7, 1])
def test_lm_slices_cover_a_block(monkeypatch, tokens):
    monkeypatch.setattr(lmscore, "SLICE", tokens)
    block = object.__new__(lmscore._Block)
    block.lengths = np.array([0, 3, 0, 20, 1, 0, 7, 7, 0])
    block.text = np.arange(38)
    got = list(block.slices())
    assert [lo for lo, *_ in got] == [0, *(hi for _, hi, _ in got[:-1])] and got[-1][1] == 9
    for lo, hi, own in got:
        assert (own.start, own.stop) == (block.lengths[:lo].sum(), block.lengths[:hi].sum())


def test_lm_over_blocks_and_shards(spark):
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(rng.choice(["the", "of", *(f"w{j}" for j in range(200))], rng.integers(0, 60)))) for k in range(120)]
    check_lm(spark, rows, range(0, 120, 3), block_tokens=100, shard_tokens=300)


def test_lm_query_matches_dense_counts(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = {r["doc_id"]: (r["score"], r["n_tokens"]) for r in op2_lm_score(spark, d).collect()}
    want = lm_brute(rows, {i for i, q in quality.items() if q == 1})
    assert len(got) == len(rows)
    for (i, _), (score, n) in zip(rows, want):
        assert got[i][1] == n and got[i][0] == pytest.approx(score, abs=1e-9)


def test_lm_scores_of_other_documents_tell_the_label(spark):
    """No document's label is in the models that score it: the area under the curve is a held-out one."""
    d = "/root/testdata/sf0.01"
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = sorted((r["score"], quality[r["doc_id"]]) for r in op2_lm_score(spark, d).collect() if r["doc_id"] in quality)
    good = [k for k, (_, q) in enumerate(got) if q == 1]
    n1, n0 = len(good), len(got) - len(good)
    assert 1 - (sum(good) - n1 * (n1 - 1) / 2) / (n1 * n0) > 0.8


def test_lm_packs_numbers():
    for values in ([], [0], [1, 2**63, 2**64 - 1, 0, 7]):
        x = np.array(values, np.uint64)
        assert (lmscore.unpack(lmscore.pack(x), len(x)) == x).all()
        assert (lmscore._sorted_unpack(lmscore._sorted_pack(np.sort(x)), len(x)) == np.sort(x)).all()


def test_lm_without_documents_or_target(spark):
    check_lm(spark, [(1, "a b"), (2, "b")], [])
    check_lm(spark, [(1, None), (2, "")], [1])
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert lmscore.score(none, none.select("doc_id"), keep=("doc_id",)).count() == 0


# --- toxicity ---------------------------------------------------------------

def toxic_rows(spark):
    """Insults make a text toxic; a group's name goes with insults in training only."""
    rng = np.random.default_rng(2)
    plain = [f"word{k}" for k in range(60)]
    rows, labels = [], []
    for k in range(600):
        toxic = k % 3 == 0
        words = list(rng.choice(plain, 12)) + ["moron"] * (toxic and rng.random() < 0.6) + ["muslims" if rng.random() < (0.9 if toxic else 0.05) else "people"]
        rows.append((k, " ".join(words), "en", "s"))
        labels.append((k, int(toxic)))
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (None, "moron", "en", "s")]
    labels += [(900, 1), (None, 1), (902, None), (901, 7)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_counterfactual_penalty_frees_group_names(spark):
    docs, labels = toxic_rows(spark)
    biased = toxicity.fit(docs, labels, penalty=0.0)
    fair = toxicity.fit(docs, labels, penalty=20.0)
    neutral, other = "word1 word2 muslims word3", "word1 word2 christians word3"
    gap = lambda m: abs(m.score(neutral) - m.score(other))
    assert gap(biased) > 0.05 and gap(fair) < 0.5 * gap(biased) and fair.score(neutral) < biased.score(neutral)
    assert fair.score("word1 moron word2") > 0.5 > fair.score("word1 people word2")


def test_toxicity_edges(spark):
    docs, labels = toxic_rows(spark)
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, keep=("doc_id",), score_out="s").withColumnRenamed("s", "score").collect()}
    assert len(got) == 603 and got[900] == got[901] == model.score("") and all(0 <= s <= 1 for s in got.values())
    assert model.score("moron " * 100_000) == model.score("moron")
    none = labels.where("doc_id < 0")
    assert 0 < toxicity.fit(docs, none).score("moron") < 0.3
    assert toxicity.fit(docs, labels.where("toxic = 1")).score("x") > 0.5
    assert toxicity.score(docs.where("doc_id < 0"), model, keep=("doc_id",)).count() == 0


def test_swaps_stay_in_their_group():
    other = toxicity.swaps()
    assert all(a != b for a, b in other.items()) and sorted(other) == sorted(other.values())


def test_toxicity_on_documents(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    got = [r for r in op3_toxicity(spark, "/root/testdata/sf0.1").collect() if r["held_out"] and r["doc_id"] in labels]
    hit = sum(r["predicted"] == 1 and labels[r["doc_id"]] == 1 for r in got)
    assert hit >= 0.9 * sum(labels[r["doc_id"]] for r in got)
    assert hit >= 0.9 * sum(r["predicted"] for r in got)


# --- BPE --------------------------------------------------------------------

@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def same(reference, text):
    own = bpe.load(tokenizer_path())
    ids = own.encode(text)
    assert ids == reference.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == reference.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", "a", " ", "  \n\n x", "Hello world's  end", "I'll we've 'S 'ss", "über naïve 日本語 🙂🙂", "<|endoftext|>", "a<|endoftext|> b <|endoftext|>",
    "x y z　", "\x1c\x1d a\x85b", "123 45e6", "áé", "กำ", "<|endoftext", "﻿x", "ab" * 5000, "=" * 3000, " " * 4000])
def test_bpe_equals_the_library(reference, text):
    same(reference, text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_bpe_equals_the_library_on_any_text(reference, text):
    same(reference, text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.data())
def test_pair_tree_root_is_leftmost_minimum(ranks, data):
    tree = bpe.PairTree(ranks, 99)
    for _ in range(10):
        assert tree.best[1] == min(r << bpe.BITS | k for k, r in enumerate(ranks))
        at = [data.draw(st.integers(0, len(ranks) - 1)) for _ in range(3)]
        for k in at:
            ranks[k] = data.draw(st.integers(0, 99))
        tree.set(*(x for k in at for x in (k, ranks[k])))


def test_piece_memory_is_bounded(monkeypatch):
    own = bpe.Bpe(open(tokenizer_path(), encoding="utf-8").read())
    monkeypatch.setattr(bpe, "CACHE", 5)
    for k in range(50):
        own.encode(f"w{k}")
    assert len(own.memory) <= 5 and own.encode("x" * 200) and len(own.memory) <= 5


def test_round_trip_query_shape(spark, reference):
    rows = [(1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, None, "en", "s"), (None, "", "en", "s")]
    got = bpe.bpe_round_trip(spark.createDataFrame(rows, DOCS), tokenizer_path(), keep=("doc_id", "score"), ids_out="ids", text_out="back").collect()
    ids = reference.encode("a b").ids
    digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["ids"], r["back"]) for r in got), key=str) == sorted(
        [(1, 2, digest, ids, "a b"), (1, 2, digest, ids, "a b"), (2, 0, empty, [], ""), (None, 0, empty, [], "")], key=str)
    assert bpe.bpe_round_trip(spark.createDataFrame([], DOCS), tokenizer_path(), keep=("doc_id",)).count() == 0


# --- toxicity: gradient and bounds ------------------------------------------

def test_gradient_equals_differences_of_the_loss():
    rng = np.random.default_rng(3)
    size, n = 7, 12
    own = [sorted(rng.choice(size, rng.integers(0, 5), replace=False).tolist()) for _ in range(n)]
    swapped = [None if k % 3 else sorted(rng.choice(size, 3, replace=False).tolist()) for k in range(n)]
    labels = np.array([1, 0, 0] * 4)
    weights, b = rng.normal(size=size), 0.3

    def loss(w, b):
        log, change = [[], []], []
        for y, mine, other in zip(labels, own, swapped):
            z = sum(w[c] for c in mine) + b
            log[y].append(math.log(1 + math.exp(-z if y else z)))
            if other is not None:
                change.append((sum(w[c] for c in mine) - sum(w[c] for c in other)) ** 2)
        return sum(np.mean(x) for x in log) / 2 + 0.8 * np.mean(change) + 0.05 * sum(x * x for x in w) / 2

    got = toxicity.loss_gradient(labels, own, swapped, size, 0.8, 0.05)(weights, b)
    for k in range(size):
        step = np.zeros(size)
        step[k] = 1e-6
        assert got[k] == pytest.approx((loss(weights + step, b) - loss(weights - step, b)) / 2e-6, abs=1e-7)
    assert got[-1] == pytest.approx((loss(weights, b + 1e-6) - loss(weights, b - 1e-6)) / 2e-6, abs=1e-7)


def test_features_and_score_by_hand(spark):
    """Chosen features and scores against counts made here."""
    docs = [(k, ("vile nasty words here" if k % 2 else "kind gentle words here") + f" n{k}") for k in range(40)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, toxic int")
    model = toxicity.fit(frame, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame, model, keep=("doc_id",)).collect()}
    for k, text in docs:
        z = model.bias + sum(model.weights.get(h, 0.0) for h in toxicity.features(set(text.split())))
        assert got[k] == pytest.approx(1 / (1 + math.exp(-z))) and (got[k] > 0.5) == bool(k % 2)
    one_sided = {w for w in "vile nasty kind gentle".split()}
    assert set(model.weights) <= toxicity.features(one_sided | {"words", "here"} | {f"n{k}" for k in range(40)})
    assert toxicity.features(one_sided) <= set(model.weights)  # in 20 texts of one label each


def test_an_id_that_repeats_is_read_once(spark, monkeypatch):
    rows = [(1, "vile text")] * 500 + [(1, "another")] * 500 + [(2, "kind text")] * 500 + [(k, f"plain {k}") for k in range(3, 20)]
    seen = {}
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda labels, *a, **k: seen.update(n=len(labels)) or train(labels, *a, **k))
    labels = spark.createDataFrame([(k, int(k == 1)) for k in range(20)], "doc_id bigint, toxic int")
    toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), labels)
    assert seen["n"] == 19
