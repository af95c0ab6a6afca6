import math

from sparkiln.operators import tfidf as TI
from sparkiln.operators.text import build_dictionaries, doc_term_counts, term_counts


def _triples(spark):
    rows = [(1, 10, 3), (1, 20, 1), (2, 10, 1), (3, 30, 2)]
    return spark.createDataFrame(rows, "doc_id long, term_id int, count long")


def test_tf_idf_definitions(spark):
    got = {(r["doc_id"], r["term_id"]): r for r in TI.tfidf(_triples(spark)).collect()}
    # tf = count / words of the document; idf = ln(N / df), N = 3 documents, no smoothing
    assert got[(1, 10)]["tf"] == 3 / 4 and abs(got[(1, 10)]["idf"] - math.log(3 / 2)) < 1e-15
    assert abs(got[(3, 30)]["tfidf"] - 1.0 * math.log(3)) < 1e-15
    assert TI.doc_total(_triples(spark)).first()["total_docs"] == 3
    assert [r["term_id"] for r in TI.unique_terms(_triples(spark)).collect()] == [10, 20, 30]


def test_doc_vectors_sorted(spark):
    v = TI.doc_vectors(_triples(spark), value="count").where("doc_id = 1").first()
    assert [e["term"] for e in v["vector"]] == [10, 20]
    assert v["n_terms"] == 2 and abs(v["norm"] - math.sqrt(10)) < 1e-12


def test_dictionaries_rule(spark):
    tokens = spark.createDataFrame(
        [(1, "the"), (1, "cat"), (1, "cat"), (2, "the"), (2, "cat"), (3, "the"), (3, "dog"),
         (4, "bird"), (4, "the")], "doc_id long, token string")
    counts = term_counts(tokens)
    stop, vocab = build_dictionaries(counts, min_df=2, max_df_ratio=0.5)
    assert [r["token"] for r in stop.collect()] == ["the"]        # in 4 of 4 documents
    assert [tuple(r) for r in vocab.collect()] == [(1, "cat")]    # dog, bird: one document
    tri = {(r["doc_id"], r["count"]) for r in doc_term_counts(counts, stop, vocab).collect()}
    assert tri == {(1, 2), (2, 1)}


def test_counts_and_tf_take_one_exchange(spark, monkeypatch):
    """Texts move once, by document, and are counted where they lie, in tasks of bounded
    text; tf takes one exchange of the triples."""
    from sparkiln import session
    from sparkiln.operators import text as TX

    docs = spark.createDataFrame([(i % 40, f"a{i % 7} b{i % 3} b{i % 3}") for i in range(50)],
                                 "doc_id long, text string")
    monkeypatch.setattr(TX, "TEXT_BYTES", 30)
    plans = []
    monkeypatch.setattr(session, "PLAN_HOOKS", [
        lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())])
    triples = TX.corpus_triples(docs)
    assert plans[0].count("Exchange ") == 1 and "hashpartitioning(doc_id" in plans[0]
    assert int(plans[0].split("hashpartitioning(doc_id")[1].split(", ")[1].split(")")[0]) > 8
    assert triples.agg({"count": "sum"}).first()[0] == 150
    plan = TI.term_frequency(triples)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_triples_in_blocks_do_not_move(spark, monkeypatch):
    """A vocabulary that is not broadcast, and df, are brought to the blocks of documents: no
    job exchanges the counts or triples, and the rows are those of the plain way."""
    from sparkiln import session
    from sparkiln.operators import text as TX

    rows = [(i % 40, f"a{i % 7} b{i % 3} b{i % 3} c{i}") for i in range(50)]
    docs = spark.createDataFrame([*rows, (None, "a1 b1 z"), (None, "a1"), (3, None)],
                                 "doc_id long, text string")
    monkeypatch.setattr(TX, "TEXT_BYTES", 60)
    plans = []
    monkeypatch.setattr(session, "PLAN_HOOKS", [
        lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())])
    with session.planned_with(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        triples, n = TX.corpus_blocks(docs, min_df=2)
        assert n > 8 and triples.groupBy("doc_id").agg({"block": "count"}).count() == 41
        # the blocks' terms, the stop words and the vocabulary by term; what is found, by block
        assert plans[-1].count("Exchange hashpartitioning(term") == 3
        assert plans[-1].count("Exchange hashpartitioning(block") == 1
        assert plans[-1].count("Exchange ") == 4
        plain = {tuple(r) for r in TI.tfidf(triples.drop("block")).collect()}
        with session.planned_with(spark, session.in_blocks(n)):
            got = TI.tfidf(triples, block="block")
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(doc_id" not in plan
            assert {tuple(r) for r in got.collect()} == plain
        tf = TI.term_frequency(triples, block="block")
        assert "Exchange" not in tf._jdf.queryExecution().executedPlan().toString()
        assert tf.count() == triples.where("doc_id IS NOT NULL").count()
