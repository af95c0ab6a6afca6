"""Packed vectors: the cosine rounds, distances and seeding in arrays equal those by rows."""

import math
import random

import pytest

from sparkiln import session
from sparkiln.operators import kmeans as KM
from sparkiln.operators import packed as PK

BLOCKS, TILES = 7, 4


def _rows(seed=3):
    rnd = random.Random(seed)
    rows = [(d, t, float(rnd.randrange(1, 9))) for d in range(90)
            for t in {0, *rnd.sample(range(60), 6)}]
    rows += [(90, 3, 0.0), (91, 99, 2.0), (92, 5, 1.0), (92, 5, 3.0)]  # zero, alone, repeated
    rnd.shuffle(rows)  # a document's entries do not follow each other
    return rows


def _table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, term_id int, tfidf double")


def _laid(spark, rows):
    tile = session.tile_of(spark, "doc_id", BLOCKS, TILES)
    return _table(spark, rows).repartition(BLOCKS, "doc_id").withColumn("tile", tile)


def _packed(spark, rows, monkeypatch, chunk):
    monkeypatch.setattr(PK, "CHUNK", chunk)
    with session.planned_with(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "16"}):
        return KM._packed(_laid(spark, rows), "doc_id", "term_id", "tfidf", (BLOCKS, TILES))


def _plain(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


@pytest.mark.parametrize("chunk", [25, 1_000_000])
def test_packed_rounds_equal_those_by_rows(spark, monkeypatch, chunk):
    rows = _rows()
    packed = _packed(spark, rows, monkeypatch, chunk)
    assert (packed.chunks.count() > TILES) and (packed.chunks.select("docs").count() > 20) == (chunk == 25)
    got = KM.kmeans_cosine(packed, k=3, max_iter=4, tol=-1.0, seed=4)
    want = KM.kmeans_cosine(_table(spark, rows), k=3, max_iter=4, tol=-1.0, seed=4)
    for name in ("round_assignments", "round_centroids", "history", "losses", "assignments",
                 "centroids"):
        assert _plain(getattr(got, name)) == _plain(getattr(want, name))
        assert getattr(got, name).dtypes == getattr(want, name).dtypes
    near = KM.doc_centroid_distances(packed, got.centroids, 3)
    assert _plain(near) == _plain(KM.doc_centroid_distances(_table(spark, rows), want.centroids, 3))
    assert {r["distance"] for r in near.where("doc_id = 90").collect()} == {math.inf}


def test_packed_rounds_go_on_from_given_centroids(spark, monkeypatch):
    """Given centroids that miss terms, hold unknown ones, or are none for a cluster."""
    rows = _rows(8)
    init = spark.createDataFrame([(1, 0, 1.0), (1, 7, 2.0), (2, 12, 1.5), (2, 5000, 4.0)],
                                 "cluster int, term int, value double")
    for k in (2, 3):
        got = KM.kmeans_cosine(_packed(spark, rows, monkeypatch, 40), k=k, max_iter=3, tol=-1.0, init=init)
        want = KM.kmeans_cosine(_table(spark, rows), k=k, max_iter=3, tol=-1.0, init=init)
        for name in ("round_assignments", "round_centroids", "history", "losses"):
            assert _plain(getattr(got, name)) == _plain(getattr(want, name))
        assert got.iterations == want.iterations == (3 if k == 2 else 1)


def test_a_packed_round_joins_no_entries(spark, monkeypatch):
    """A round joins and aggregates no rows, and the vectors lie where they are: the tiles'
    arrays go into the round without an exchange, whatever the number of shuffle partitions."""
    packed = _packed(spark, _rows(), monkeypatch, 25)
    plans = []

    def hook(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    with session.planned_with(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                                      "spark.sql.shuffle.partitions": "67"}):
        monkeypatch.setattr(session, "PLAN_HOOKS", [hook])
        KM.kmeans_cosine(packed, k=3, max_iter=2, tol=-1.0, seed=4)
    rounds = [p for p in plans if "FlatMapCoGroupsInArrow" in p]
    assert len(rounds) == 3  # the first centroids and two rounds
    for plan in rounds:
        assert "HashAggregate" not in plan and "Join" not in plan
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "sparkiln_vectors" in line)
        group = max(i for i, line in enumerate(lines[:scan]) if "FlatMapCoGroupsInArrow" in line)
        assert not any("Exchange" in line for line in lines[group:scan])


def test_packed_seeding_equals_that_by_rows(spark, monkeypatch):
    rows = _rows(11)
    packed, table = _packed(spark, rows, monkeypatch, 25), _table(spark, rows)
    vectors = table.toDF("doc", "term", "value")
    norms = KM.doc_norms(vectors)
    assert _plain(packed.norms()) == _plain(norms)
    length = {r["doc"]: r["norm"] for r in norms.collect()}
    for cands in ([5, 60, 90, 17, 91], [90], [92]):  # 90 is a zero vector
        got = KM._nearest_candidate(packed, packed.norms(), cands, length, 7)
        assert _plain(got) == _plain(KM._nearest_candidate(vectors, norms, cands, length, 7))
    seeds = KM.seed_parallel(packed, 4, seed=9)
    assert _plain(seeds) == _plain(KM.seed_parallel(table, 4, seed=9))
    assert _plain(KM.seeds_to_centroids(packed, seeds)) == _plain(KM.seeds_to_centroids(table, seeds))


def test_no_vectors(spark, monkeypatch):
    packed = _packed(spark, [], monkeypatch, 25)
    got = KM.kmeans_cosine(packed, k=2, max_iter=3, seed=1)
    assert got.iterations == 1 and got.round_assignments.count() == got.round_centroids.count() == 0
    assert KM.doc_centroid_distances(packed, got.centroids, 2).count() == 0


def test_report_of_packed_vectors(spark, monkeypatch, tmp_path):
    rows, settings = _rows(), dict(k=3, tol=-1.0, seed=4)
    packed = _packed(spark, rows, monkeypatch, 25)
    KM.report_clusters(packed, f"{tmp_path}/a", max_iter=2, **settings)
    KM.report_clusters(packed, f"{tmp_path}/a", max_iter=4, **settings)
    KM.report_clusters(_table(spark, rows), f"{tmp_path}/b", max_iter=4, **settings)
    a, b = (KM.RoundReport(spark, f"{tmp_path}/{x}") for x in "ab")
    assert _plain(a.losses()) == _plain(b.losses()) and a.losses().count() == 4
    assert _plain(a.top_terms()) == _plain(b.top_terms())
