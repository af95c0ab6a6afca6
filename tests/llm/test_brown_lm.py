"""Operator 11 against plain counting and a plain evaluation of the model."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sparkiln.llm import brown_lm as B
from llm_fixtures import documents, sf_small  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALL = dict(classes=5, units=20, groups=8, head=40, rounds=3)


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+",
                      (text or "").translate(str.maketrans(UPPER, UPPER.lower())))


def base(rows, held):
    """doc_id -> (n_tokens, n_known, N, base_score) by plain counting."""
    c = Counter()
    for i, text in rows:
        if not held(i):
            c.update([*words(text), None])
    n, v = sum(c.values()), len(c)
    return {i: (len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), None]), n,
                sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*words(t), None]))
            for i, t in rows}


def crc_held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def plain_score(text, model, counts):
    """The model's formula, word by word."""
    def class_of(word):
        names = pa.array([word], pa.large_string())
        return int(model.classes[model.words.unit_of(names, model.words.places(names))[0]])

    total, before = 0.0, 0
    for word in words(text):
        c = class_of(word)
        total += model.transition[before, c]
        total += math.log10(counts[word] + 1) - model.room[c]
        before = c
    return total + model.transition[before, 0]


def test_given_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = base(rows, crc_held)
    out = B.op11_class_bigrams(spark, sf_small).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(want)
    for r in out:
        n_tokens, n_known, n, base_score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, n)
        assert r["held_out"] == crc_held(r["doc_id"])
        assert math.isclose(r["base_score"], base_score, rel_tol=1e-9)
    fresh = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in fresh) > 0.97 * sum(r["base_score"] for r in fresh)


@pytest.fixture
def corpus(spark, documents):
    rng = np.random.default_rng(1)
    subjects, verbs, things = ([f"{p}{i}" for i in range(12)] for p in "svt")
    rows = [(i, ". ".join(f"{rng.choice(subjects)} {rng.choice(verbs)} {rng.choice(things)}"
                          f" rare{rng.integers(200)}" for _ in range(6))) for i in range(150)]
    rows += [(1000, "unseen words only"), (1001, None), (1002, ""), (1003, "w" * 70 + " s1 v1")]
    return rows


def test_scores_follow_the_formula(spark, documents, corpus):
    docs = documents(corpus, c=1, word="clash", row=2, unit=3)
    taught = docs.where("doc_id < 1000")
    model, others = B.train(taught, **SMALL)
    counts = Counter(w for i, t in corpus if i < 1000 for w in words(t))
    assert model.tokens == sum(counts.values()) + 150
    assert (model.distinct, model.ends) == (len(counts) + 1, 150)
    assert others.count() >= len(counts) - SMALL["head"] > 0  # so both ways of look-up are used
    got = {r["doc_id"]: r for r in B.score(docs, model, others).collect()}
    want = base(corpus, lambda i: i >= 1000)
    for i, text in corpus:
        assert math.isclose(got[i]["score"], plain_score(text, model, counts), rel_tol=1e-9)
        assert math.isclose(got[i]["base_score"], want[i][3], rel_tol=1e-9)
        assert got[i]["n_known"] == want[i][1]


def test_probabilities_sum_to_one(spark, documents, corpus):
    docs = documents(corpus).where("doc_id < 1000")
    model, _ = B.train(docs, **SMALL)
    assert np.allclose((10 ** model.transition).sum(axis=1), 1)
    counts = Counter(w for i, t in corpus if i < 1000 for w in words(t))
    names = pa.array(sorted(counts), pa.large_string())
    of = model.classes[model.words.unit_of(names, model.words.places(names))]
    for c in range(1, SMALL["classes"] + 1):
        mass = sum(counts[w.as_py()] + 1 for w, k in zip(names, of) if k == c) + 1
        assert math.isclose(mass, 10 ** model.room[c], rel_tol=1e-9)


def test_clustering_finds_the_parts_of_speech(spark, documents, corpus):
    docs = documents(corpus).where("doc_id < 1000")
    model, _ = B.train(docs, classes=8, units=48, groups=8, head=48, rounds=8)
    of = dict(zip(model.words.names.to_pylist(), model.classes))
    verbs = Counter(of[w] for w in of if w.startswith("v"))
    others = {of[w] for w in of if w[0] in "st"}
    assert not set(verbs) & others


def test_gains_are_differences_of_likelihood():
    rng = np.random.default_rng(2)
    units, k = 9, 4
    pairs = rng.integers(0, 6, (units, units))
    classes = rng.integers(1, k, units)
    classes[-1] = 0

    def matrix(of):
        out = np.zeros((k, k), np.int64)
        np.add.at(out, (of[:, None], of[None, :]), pairs)
        return out

    for u in range(units - 1):
        after, before = np.zeros(k), np.zeros(k)
        rest = np.arange(units) != u
        np.add.at(after, classes[rest], pairs[u, rest])
        np.add.at(before, classes[rest], pairs[rest, u])
        state = B.Exchange(matrix(classes))
        best = state.move(classes[u], after, before, pairs[u, u])
        tried = {}
        for c in range(1, k):
            of = classes.copy()
            of[u] = c
            tried[c] = B.likelihood(matrix(of))
        assert math.isclose(tried[best], max(tried.values()), rel_tol=1e-12)
        classes[u] = best
        assert np.array_equal(state.m, matrix(classes))
        assert np.allclose(state.rows, matrix(classes).sum(axis=1))
        assert np.allclose(state.columns, matrix(classes).sum(axis=0))


def test_defined_cases(spark, documents):
    assert B.score_documents(documents([])).count() == 0
    # nothing to learn from: a NULL id is held out
    out = B.score_documents(documents([(None, "a b"), (None, None)])).collect()
    assert [(r["held_out"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out] == [
        (True, 0, 0, 0.0)] * 2
    assert sorted(r["n_tokens"] for r in out) == [1, 3]
    rows = [(i, "Same text") for i in [0, 0, 2]] + [(3, "a " * 50_000)]
    assert not any(crc_held(i) for i in (0, 2, 3))
    out = B.score_documents(documents(rows)).collect()
    want = base(rows[1:], lambda i: False)
    assert {r["n_tokens"] for r in out} == {3, 50_001}
    assert {r["train_tokens"] for r in out} == {9 + 50_001}
    assert len({r["score"] for r in out if r["doc_id"] != 3}) == 1
    assert want[3][0] == 50_001
