import numpy as np

from sparkiln.operators import kmeans as KM


def lloyd(points, cents, max_iter=20, tol=1e-3):
    """Plain numpy Lloyd with the reference's rules (test reference)."""
    cents = np.array(cents, dtype=float)
    for it in range(1, max_iter + 1):
        d = np.sqrt(((points[:, None, :] - cents[None, :, :]) ** 2).sum(-1))
        lab = d.argmin(1)
        new = np.array([points[lab == j].mean(0) for j in range(len(cents))])
        shift = np.sqrt(((new - cents) ** 2).sum(1)).max()
        cents = new
        if shift < tol:
            break
    return cents, lab, it


def test_kmeans_2d_matches_numpy(spark):
    rng = np.random.default_rng(5)
    pts = np.concatenate([rng.normal(c, 0.08, (150, 2)) for c in [(0, 0), (1, 0.2), (0.4, 1)]])
    init = [tuple(pts[0]), tuple(pts[200]), tuple(pts[400])]
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)],
                               "id long, x double, y double")
    res = KM.kmeans_2d(df, k=3, init=init)
    want_c, want_lab, want_it = lloyd(pts, init)
    got_c = np.array([(r["x"], r["y"]) for r in res.centroids.orderBy("cluster").collect()])
    assert np.allclose(got_c, want_c, atol=1e-12)
    assert res.iterations == want_it


def test_cosine_rules(spark):
    # doc 3 is a zero vector: infinite distance everywhere -> cluster 1
    rows = [(1, 1, 1.0), (1, 2, 1.0), (2, 3, 2.0), (2, 4, 1.0), (3, 1, 0.0), (4, 3, 1.0)]
    tri = spark.createDataFrame(rows, "doc_id long, term_id int, tfidf double")
    init = spark.createDataFrame([(1, 1, 1.0), (2, 3, 1.0)], "cluster int, term int, value double")
    res = KM.kmeans_cosine(tri, k=2, max_iter=5, init=init)
    got = {r["doc_id"]: r["cluster"] for r in res.assignments.collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 2}
    # centroid term mean is over holders only
    c = {(r["cluster"], r["term_id"]): r["value"] for r in res.centroids.collect()}
    assert c[(2, 3)] == 1.5 and c[(2, 4)] == 1.0 and c[(1, 1)] == 0.5


def test_rounds_do_not_shuffle_the_vectors(spark):
    """With broadcasts off, a round exchanges centroids, assignments and partial sums,
    but the kept vectors go into its joins as they lie; results equal the plain joins."""
    import random

    from sparkiln.session import planned_with
    rnd = random.Random(1)
    rows = [(d, t, float(rnd.randrange(1, 9))) for d in range(120)
            for t in {0, *rnd.sample(range(90), 8)}]  # term 0 in every document
    tri = spark.createDataFrame(rows, "doc_id long, term_id int, tfidf double")
    plain = tri.toDF("doc", "term", "value")
    cents = spark.createDataFrame([(j, t, float(rnd.randrange(5))) for j in (1, 2)
                                   for t in rnd.sample(range(90), 50)],
                                  "cluster int, term int, value double")
    assigned = spark.createDataFrame([(d, 1 + d % 2) for d in range(120)], "doc long, cluster int")
    norms = KM.doc_norms(plain)
    want = (sorted(map(tuple, KM.doc_dots(plain, norms, cents, 2).collect())),
            sorted(map(tuple, KM.sparse_centroids(plain, assigned).collect())))
    for block_terms in (1_000_000, 20):
        old, KM.BLOCK_TERMS = KM.BLOCK_TERMS, block_terms
        try:
            with planned_with(spark, {**KM._BY_TILE, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
                tiles = KM.Tiles(tri, "doc_id", "term_id", "tfidf")
                assert (tiles.term_blocks > 1) == (block_terms == 20)
                tiles.vectors.count()
                rounds = [KM.doc_dots(tiles, norms, cents, 2), KM.sparse_centroids(tiles, assigned)]
                for df in rounds:
                    plan = df._jdf.queryExecution().executedPlan().toString()
                    above = plan[:plan.index("InMemoryTableScan")].splitlines()
                    join = next(i for i, line in enumerate(above) if "ShuffledHashJoin" in line)
                    assert not any("Exchange" in line for line in above[join:])
                assert tuple(sorted(map(tuple, df.collect())) for df in rounds) == want
                tiles.vectors.unpersist()
        finally:
            KM.BLOCK_TERMS = old


def test_seeding_exchanges_candidates_only(spark):
    """The nearest candidate comes from the vectors as they lie by document; results equal
    those computed in one place, with candidates that share no term and zero vectors."""
    import math
    import random

    from sparkiln.session import planned_with
    rnd = random.Random(6)
    docs = {d: {t: float(rnd.randrange(1, 9)) for t in rnd.sample(range(40), 5)} for d in range(60)}
    docs[60], docs[61] = {3: 0.0}, {99: 2.0}
    tri = spark.createDataFrame([(d, t, v) for d, ts in docs.items() for t, v in ts.items()],
                                "doc_id long, term_id int, tfidf double")
    vectors = KM._doc_partitioned(tri, "doc_id", "term_id", "tfidf")
    norms = KM.doc_norms(vectors).persist()
    norms.count()
    cands = [5, 60, 17, 61]
    length = {d: math.sqrt(sum(v * v for v in ts.values())) for d, ts in docs.items()}
    with planned_with(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        near = KM._nearest_candidate(vectors, norms, cands, length, 7)
        plan = near._jdf.queryExecution().executedPlan().toString().splitlines()
        join = next(i for i, line in enumerate(plan) if "BroadcastHashJoin" in line)
        assert not any("Exchange" in line for line in plan[join - 4:join])  # the sums per document
        assert not any("SortMergeJoin" in line for line in plan)
        got = {r["doc"]: (r["dist"], r["ci"]) for r in near.collect()}
    assert set(got) == set(docs)
    for d, ts in docs.items():
        want = min((1 - sum(v * docs[c].get(t, 0.0) for t, v in ts.items()) / length[d] / length[c],
                    7 + i) for i, c in enumerate(cands) if length[c]) if length[d] else (math.inf, 7)
        assert math.isclose(got[d][0], want[0], abs_tol=1e-12) and got[d][1] == want[1]
    norms.unpersist()
    vectors.unpersist()


def test_rounds_leave_the_tiles_with_more_shuffle_partitions(spark):
    """More shuffle partitions than tiles: a whole run's joins still take the vectors as
    they lie, and bring a centroid's row only to tiles that hold its term."""
    from sparkiln import session

    rows = [(d, t, 1.0 + (d * t) % 7) for d in range(60) for t in range(d % 5, 40, 3 + d % 4)]
    tri = spark.createDataFrame(rows, "doc_id long, term_id int, tfidf double")
    plans = []

    def hook(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    with session.planned_with(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                                      "spark.sql.shuffle.partitions": "67"}):
        session.PLAN_HOOKS.append(hook)
        try:
            KM.kmeans_cosine(tri, k=3, max_iter=2, tol=-1.0, seed=4)
        finally:
            session.PLAN_HOOKS.remove(hook)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "67"
    assert len(plans) == 5
    for plan in plans:
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "InMemoryTableScan [tile" in line and "value" in line)
        join = max(i for i, line in enumerate(lines[:scan]) if "ShuffledHashJoin" in line)
        assert not any("Exchange" in line for line in lines[join:scan])
    tiles = KM.Tiles(tri, "doc_id", "term_id", "tfidf")
    held = {(r["tile"], r["term"]) for r in tiles.vectors.select("tile", "term").distinct().collect()}
    assert sorted(map(tuple, tiles.places.select("tile", "term").collect())) == sorted(held)
    tiles.unpersist()


def test_tiles_written_by_block_are_taken_as_they_lie(spark):
    """Vectors written by tile are not exchanged at all, centroids lie by term, so that a
    round packs and compares them without an exchange; results equal those of plain rows."""
    from sparkiln import session

    rows = [(d, t, 1.0 + (d * t) % 7) for d in range(60) for t in range(d % 5, 40, 3 + d % 4)]
    tri = spark.createDataFrame(rows, "doc_id long, term_id int, tfidf double")
    blocks, tiles = 7, session.tiles_of_blocks(7, 4)
    assert tiles == 4 and session.tiles_of_blocks(13, 12) == 7
    assert session.tiles_of_blocks(3, 8) == 3
    tile = session.tile_of(spark, "doc_id", blocks, tiles)
    laid = session.materialize_blocks(
        tri.repartition(blocks, "doc_id").withColumn("tile", tile), tiles, "tile", "tfidf")
    got = KM.kmeans_cosine(laid, k=3, max_iter=3, tol=-1.0, seed=4, laid=(blocks, tiles))
    near = KM.doc_centroid_distances(laid, got.centroids, 3, laid=(blocks, tiles))
    packed = got.centroids.groupBy("term_id").count()
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()
    want = KM.kmeans_cosine(tri, k=3, max_iter=3, tol=-1.0, seed=4)

    def rounded(df):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())

    for name in ("round_assignments", "round_centroids", "history", "losses"):
        assert rounded(getattr(got, name)) == rounded(getattr(want, name))
    assert rounded(near) == rounded(KM.doc_centroid_distances(tri, want.centroids, 3))
    assert near.count() == 60 * 3
    taken = KM.Tiles(laid, "doc_id", "term_id", "tfidf", (blocks, tiles))
    assert "Exchange" not in taken.vectors._jdf.queryExecution().executedPlan().toString()
    taken.unpersist()
