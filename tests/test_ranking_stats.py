import numpy as np
import pandas as pd

from sparkiln.operators.ranking import dense_index, group_rank
from sparkiln.operators import stats as ST


def _skewed(spark, n=4000, seed=3):
    rng = np.random.default_rng(seed)
    # one key holds a third of all rows
    keys = np.where(rng.random(n) < 1 / 3, "hot", rng.choice(["a", "b", "c", "d"], n))
    vals = rng.normal(100, 30, n).round(2)
    pdf = pd.DataFrame({"k": keys, "v": vals, "id": np.arange(n)})
    return pdf, spark.createDataFrame(pdf)


def test_group_rank_exact(spark):
    pdf, df = _skewed(spark)
    got = group_rank(df, ["k"], ["v", "id"], out="r", partitions=16).toPandas()
    want = pdf.sort_values(["k", "v", "id"]).groupby("k").cumcount()
    got = got.set_index("id").sort_index()
    assert (got["r"].values == want.sort_index().values).all()
    assert (got["group_n"].values == pdf.groupby("k")["k"].transform("size").values).all()


def test_dense_index(spark):
    df = spark.createDataFrame([(w,) for w in ["pear", "apple", "fig", "kiwi", "date"]], "t string")
    got = {r["t"]: r["id"] for r in dense_index(df, ["t"], partitions=3).collect()}
    assert got == {"apple": 1, "date": 2, "fig": 3, "kiwi": 4, "pear": 5}


def test_quantiles_and_box(spark):
    pdf, df = _skewed(spark)
    q = {r["k"]: r for r in ST.group_quantiles(df, "k", "v", [0.25, 0.5, 0.75]).collect()}
    for k, g in pdf.groupby("k"):
        want = np.percentile(g["v"], [25, 50, 75])
        assert np.allclose([q[k]["q25"], q[k]["q50"], q[k]["q75"]], want)
    box = {r["k"]: r for r in ST.box_stats(df, "k", "v").collect()}
    for k, g in pdf.groupby("k"):
        q1, q3 = np.percentile(g["v"], [25, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = g["v"][(g["v"] >= lo) & (g["v"] <= hi)]
        assert box[k]["whisker_lo"] == inside.min() and box[k]["whisker_hi"] == inside.max()
        assert box[k]["n_outliers"] == len(g) - len(inside)


def test_histogram_matches_numpy(spark):
    pdf, df = _skewed(spark)
    h = ST.histogram(df, ["v"], bins=20).orderBy("bin").collect()
    counts, edges = np.histogram(pdf["v"], bins=20)
    assert [r["count"] for r in h] == counts.tolist()
    assert np.allclose([r["lo"] for r in h], edges[:-1])


def test_correlation_matches_pandas(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=500)
    pdf = pd.DataFrame({"a": a, "b": a * 2 + rng.normal(size=500), "c": 1.0})
    pdf.loc[::7, "b"] = np.nan
    r = {(x["a"], x["b"]): x["r"] for x in
         ST.correlation_matrix(spark.createDataFrame(pdf), ["a", "b", "c"]).collect()}
    want = pdf.corr()
    assert abs(r[("a", "b")] - want.loc["a", "b"]) < 1e-9
    assert abs(r[("a", "a")] - 1.0) < 1e-12
    assert r[("a", "c")] is None  # constant column: NULL, not an ANSI error
