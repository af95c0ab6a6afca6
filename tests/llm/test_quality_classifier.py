import zlib

import numpy as np
import pyarrow as pa

from sparkiln.llm import kernels as K
from sparkiln.llm import quality_classifier as Q
from llm_fixtures import documents  # noqa: F401

SF = "/root/testdata/sf0.01"


def chunk(texts):
    return next(K.text_chunks(pa.array(texts), 1 << 30))[2:]


def test_features_count_repeats_and_shapes():
    doc, feature, count = Q.feature_counts(*chunk(["a a a b", "", None, "x\nx\ny", "Ab1!! AB12!!"]))
    got = {(d, f): c for d, f, c in zip(doc, feature, count)}
    assert got[0, Q._SAME_WORD] == 2 and (3, Q._SAME_LINE) in got and got[3, Q._SAME_LINE] == 1
    assert (0, Q._SAME_LINE) not in got and not {1, 2} & set(doc)
    # a text's features do not depend on its neighbours
    for i, t in enumerate(["a a a b", "Ab1!! AB12!!"]):
        alone = Q.feature_counts(*chunk([t]))
        d = (0, 4)[i]
        assert {(f, c) for f, c in zip(*alone[1:])} == {(f, c) for (x, f), c in got.items() if x == d}


def test_votes_equal_brute_force():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words, 30)) + (" !!!" if i % 3 == 0 else "") for i in range(90)]
    labels = np.array([float(i % 3 > 0) for i in range(60)], np.float32)
    data, offsets = chunk(texts[:60])
    doc, feature, count = Q.feature_counts(data, offsets)
    idf = np.ones(Q.FEATURES)
    value = Q.weighted(doc, feature, count, 60, idf)
    basis = Q.latent_basis(doc, feature, value, 60, 16)
    vectors = Q.project(doc, feature, value, 60, basis)
    assert np.allclose(basis.T @ basis, np.eye(16), atol=1e-3)
    model = Q.VotingModel(idf, basis, vectors, labels, 0.8)
    got = model.score(*chunk(texts[60:] + ["", None]))
    assert got[-1] == got[-2] == 0.8
    for g, v in zip(got, model.embed(*chunk(texts[60:]))):
        cosine = vectors @ v
        near = np.argsort(-cosine)[:Q.NEIGHBOURS]
        vote = np.maximum(cosine[near], 0) ** Q.POWER * np.where(
            labels[near] == 1, 0.8 / labels.mean(), 0.2 / (1 - labels.mean()))
        assert abs(g - (vote * labels[near]).sum() / vote.sum()) < 1e-3


def test_frequencies_cover_all_documents(spark, documents):
    texts = ["a b", "a", None, "", "a c a"]
    n, total = Q.document_frequencies(documents(list(enumerate(texts))))
    want = np.zeros(Q.FEATURES, np.int64)
    for t in texts:
        np.add.at(want, np.unique(Q.feature_counts(*chunk([t]))[1]), 1)
    assert total == 5 and (n == want).all()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in Q.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    want = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    out = [d for d in want if got[d].held_out]
    assert sum(got[d].predicted == want[d] for d in out) >= 0.95 * len(out)


def test_edge_cases(spark, documents):
    rows = [(1, "fine text here"), (2, "BAD!! BAD!!"), (3, None), (4, ""), (None, "fine"),
            (6, "BAD!! " * 30000), (7, "good words"), (7, "good words"), (8, "WORSE!! WORSE!!")]
    docs = documents(rows, label=5, quality=1, score=2.0, h=1)
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (7, 1, 0), (7, None, 0), (8, 0, None),
                                    (None, 0, 0), (3, 1, 0)], schema)
    got = Q.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= 0.3) for r in got)
    none = Q.classify(docs, spark.createDataFrame([], schema)).collect()
    assert {r.score for r in none} == {0.5}
    assert Q.classify(documents([]), labels).count() == 0
