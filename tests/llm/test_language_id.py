import math
import zlib

import numpy as np

import corpus_pipeline as C
from sparkiln.llm import language_id as L
from llm_fixtures import documents  # noqa: F401

SF = "/root/testdata/sf0.01"


def brute_grams(text):
    chars, out = " ", set()
    for c in text.lower():
        if c.isalpha():
            chars += c
        elif chars[-1] != " ":
            chars += " "
    chars = chars if chars[-1] == " " else chars + " "
    for n in (1, 2, 3):
        out |= {chars[i:i + n] for i in range(len(chars) - n + 1)}
    return out


def code(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


def test_ngrams_equal_brute_force():
    for t in ["a", "Ab c", " x  y!z", "É-ñ\n\t日本語 \U0001d400", "12 a 34", "A" * 5000, "a1", "1a"]:
        assert set(L.ngrams(t).tolist()) == {code(g) for g in brute_grams(t)}, t
        assert len(L.ngrams(t)) == len(brute_grams(t))
    for t in [None, "", "12 34", "!!\n"]:
        assert len(L.ngrams(t)) == 0


def test_folded_scores_equal_kernel_scores():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abcde fgh" if i % 2 else "xyzde fgh"), 60)) for i in range(30)]
    labels = ["q" if i % 2 else "p" for i in range(30)]
    sets = [L.ngrams(t) for t in texts]
    model = L.fit(sets, labels, landmarks=6)
    grams = [brute_grams(t) for t in texts]

    def k(a, b):
        return len(a & b) / math.sqrt(len(a) * len(b))
    marks = [i for c in "pq" for i in [j for j, x in enumerate(labels) if x == c][:6]]
    kernel = np.array([[k(g, grams[m]) for m in marks] for g in grams])
    values, vectors = np.linalg.eigh(kernel[marks])
    z = kernel @ (vectors / np.sqrt(values)) @ vectors.T
    y = np.where(np.array(labels)[:, None] == np.array(["p", "q"]), 1.0, -1.0)
    zc, yc = z - z.mean(axis=0), y - y.mean(axis=0)
    beta = np.linalg.solve(zc.T @ zc + L.RIDGE * 30 * np.eye(12), zc.T @ yc)
    raw = L.SHARPNESS * (zc @ beta + y.mean(axis=0))
    want = np.exp(raw) / np.exp(raw).sum(axis=1, keepdims=True)
    assert np.allclose(model.scores(sets), want, atol=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in L.identify(docs).collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    assert all(0 <= r.score <= 1 for r in got.values())
    out = [d for d, r in got.items() if r.held_out]
    assert sum(got[d].lang_pred == lang[d] for d in out) >= 0.98 * len(out)


def test_edge_cases(spark, documents):
    rows = [(1, "hello there my friend", "en"), (2, "bonjour mon ami très cher", "fr"),
            (3, None, "en"), (4, "", "fr"), (5, "12 34", "en"), (6, "no label", None),
            (None, "bonjour", "fr"), (8, "hello hello", "en"), (8, "hello hello", "en"),
            (9, "bonjour " * 20000, "fr")]
    got = L.identify(documents(rows, score=1.0, h=2, lang_pred="x")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[d].lang_pred == "und" and by[d].score == 0 for d in (3, 4, 5))
    assert by[None].held_out
    assert by[9].lang_pred == "fr" and by[8].lang_pred == "en"
    none = L.identify(documents([(1, "abc", None)])).collect()
    assert none[0].lang_pred == "und"
    assert L.identify(documents([])).count() == 0


def test_unlearned_languages_are_not_known(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = np.random.default_rng(3)
    strange = ["Это простое предложение на русском языке, которое никто не учил.",
               "これは日本語の文章です。学習されていない言語です。",
               "Αυτή είναι μια πρόταση στα ελληνικά που κανείς δεν έμαθε.",
               " ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 6)) for _ in range(50))]
    rows = documents([(i, t, None) for i, t in enumerate(strange)])
    # however many languages are learned
    for langs in (["en"], ["en", "fr"], ["de", "en", "fr"], ["de", "en", "es", "fr"]):
        model = L.train(docs.where(docs.lang.isin(langs)))
        assert L.keep_known(rows, model, C.MIN_KNOWN).count() == 0, langs
        clean = docs.where(docs.lang.isin(langs) & docs.text.rlike("[a-z]"))
        assert L.keep_known(clean, model, C.MIN_KNOWN).count() >= 0.998 * clean.count()
    # a language that has no label
    spanish = docs.where("lang = 'es'")
    left = L.keep_known(spanish, L.train(docs.where("lang != 'es'")), C.MIN_KNOWN).count()
    assert left < 0.1 * spanish.count()


def test_known_share_follows_the_language():
    rng = np.random.default_rng(1)

    def text(low, size):  # an alphabet of ``size`` letters
        return "".join(chr(low + c) for c in rng.integers(0, size, 300))
    sets = [L.ngrams(text(0x4E00, 3000)) for _ in range(40)]
    sets += [L.ngrams(text(0x61, 26)) for _ in range(40)]
    model = L.fit(sets, ["big"] * 40 + ["small"] * 40)
    fresh = [L.ngrams(text(0x4E00, 3000)) for _ in range(10)]
    other = [L.ngrams(text(0x8000, 3000)) for _ in range(10)] + [L.ngrams("")]
    assert (model.known(fresh) >= C.MIN_KNOWN).all()
    assert (model.known(other) < C.MIN_KNOWN).all()
