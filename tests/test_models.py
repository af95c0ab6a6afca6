import numpy as np
from pyspark.sql import functions as F

from sparkiln.operators import models as ML


def test_grids_match_numpy(spark):
    rng = np.random.default_rng(2)
    xs, ys = rng.normal(size=300), rng.normal(size=300)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(xs, ys)], "x double, y double")
    lin = [r["x"] for r in ML.linspace_grid(df, "x", 100).orderBy("i").collect()]
    assert np.allclose(lin, np.linspace(xs.min(), xs.max(), 100), rtol=0, atol=1e-12)
    mesh = ML.mesh_grid(df, ["x", "y"], 0.1, 0.5)
    a0 = np.arange(xs.min() - 0.5, xs.max() + 0.5, 0.1)
    a1 = np.arange(ys.min() - 0.5, ys.max() + 0.5, 0.1)
    assert mesh.count() == len(a0) * len(a1)
    got = sorted({round(r["g0"], 9) for r in mesh.select("g0").distinct().collect()})
    assert np.allclose(got, a0, atol=1e-9)


def test_hash_split_and_linear_fit(spark):
    df = spark.range(20000).select(F.col("id"), (F.col("id") * 2.0 + 1.0).alias("y"))
    s1 = ML.hash_split(df, "id", 0.75, seed=3)
    frac = s1.where("split = 'train'").count() / 20000
    assert 0.73 < frac < 0.77
    s2 = ML.hash_split(df, "id", 0.75, seed=3)
    assert s1.exceptAll(s2).count() == 0  # same split on every evaluation
    slope, intercept = ML.linear_fit(s1.where("split = 'train'"), "id", "y")
    assert abs(slope - 2.0) < 1e-9 and abs(intercept - 1.0) < 1e-6


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    train = rng.normal(size=(400, 2))
    query = rng.uniform(-3, 3, size=(60, 2))
    tdf = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(train)],
                                "id long, x double, y double")
    qdf = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(query)],
                                "qid long, x double, y double")
    got = {}
    for r in ML.knn(tdf, qdf, ["x", "y"], k=7, cell=0.2).collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["id"]))
    for q, (a, b) in enumerate(query):
        d = np.sqrt((train[:, 0] - a) ** 2 + (train[:, 1] - b) ** 2)
        want = [int(i) for i in np.lexsort((np.arange(len(d)), d))[:7]]
        assert [i for _, i in sorted(got[q])] == want


def _brute_knn(train, query, k):
    out = {}
    for q, point in query:
        near = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(x, point)))), i)
                      for i, x in train)
        out[q] = near[:k]
    return out


def _knn(spark, train, query, k, d, **more):
    cols = [f"x{i}" for i in range(d)]
    fields = ", ".join(f"{c} double" for c in cols)
    tdf = spark.createDataFrame([(i, *map(float, x)) for i, x in train], f"id long, {fields}")
    qdf = spark.createDataFrame([(i, *map(float, x)) for i, x in query], f"qid long, {fields}")
    got = {}
    for r in ML.knn(tdf, qdf, cols, k=k, **more).collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["dist"], r["id"]))
    for q, rows in got.items():
        assert [r[0] for r in sorted(rows)] == list(range(1, len(rows) + 1))
    return {q: [(dist, i) for _, dist, i in sorted(rows)] for q, rows in got.items()}


def test_knn_with_far_and_coinciding_points(spark):
    rng = np.random.default_rng(6)
    for d in (1, 3):
        train = [(i, rng.normal(size=d)) for i in range(250)]
        train += [(1000 + i, np.full(d, 0.25)) for i in range(120)]  # a third at one place
        train += [(5000, np.full(d, 1e9))]
        query = [(0, np.full(d, 0.25)), (1, np.full(d, -1e6)), (2, np.full(d, 1e9)),
                 *[(10 + i, rng.normal(size=d)) for i in range(20)]]
        assert _knn(spark, train, query, 4, d, leaf_rows=8) == _brute_knn(train, query, 4)
    few = [(7, [1.0]), (3, [1.0])]
    assert _knn(spark, few, [(0, [0.0])], 5, 1) == {0: [(1.0, 3), (1.0, 7)]}


def test_knn_missing_values_and_empty_tables(spark):
    tdf = spark.createDataFrame([(1, 0.0), (2, None), (3, float("nan"))], "id long, x double")
    qdf = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "qid long, x double")
    assert [tuple(r) for r in ML.knn(tdf, qdf, ["x"], 2).collect()] == [(1, 1, 1.0, 1)]
    empty = ML.knn(tdf.where("id < 0").withColumn("label", F.lit("a")), qdf, ["x"], 2, keep=["label"])
    assert empty.count() == 0 and empty.columns == ["qid", "id", "dist", "rank", "label"]
    assert ML.knn(tdf, qdf.where("qid < 0"), ["x"], 2).count() == 0


def test_a_far_point_makes_no_crowded_cell_and_no_more_work(spark):
    """Cells never hold more than the stated number of rows, and the cells within
    reach of a query are as many with a far point as without it."""
    rng = np.random.default_rng(8)
    points = rng.uniform(size=(2000, 2))
    rows, k = 16, 4

    def work(pts):
        df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)],
                                   "_id long, _f0 double, _f1 double")
        leaf, levels = ML.box_tree(df, 2, len(pts), rows)
        cells = leaf.selectExpr("size(points) AS n", "lo0", "hi0", "lo1", "hi1").collect()
        assert max(r["n"] for r in cells) <= rows and sum(r["n"] for r in cells) == len(pts)
        assert levels[-1].count() == 1
        assert all(r["n"] <= ML.FAN for t in levels
                   for r in t.selectExpr("size(children) AS n").collect())
        reached = 0
        for a, b in rng.uniform(size=(50, 2)):
            bound = np.sort(np.hypot(pts[:, 0] - a, pts[:, 1] - b))[k - 1]
            reached += sum(np.hypot(max(r["lo0"] - a, 0, a - r["hi0"]),
                                    max(r["lo1"] - b, 0, b - r["hi1"])) <= bound for r in cells)
        return reached

    plain = work(points)
    assert work(np.vstack([points, [[1e9, -1e9]]])) <= 1.5 * plain
