"""Operator 13 against a dense numpy whitening, and its defined cases."""

import math

import numpy as np
import pytest

from sparkiln.llm import whitening as W
from llm_fixtures import sf_small  # noqa: F401


def brute(rows, components=4):
    """{position in rows: (deviation, whitened)} and the shares of the variance."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, total = len(fit), fit.sum(axis=0)
    away = fit - total / n
    v = away.T @ away / n
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:components]
    whitened = {i: (np.array(x) - total / n) @ vectors[:, order] / np.sqrt(values[order])
                for i, x in kept}
    deviation = {i: sum((n * int(c) - int(s)) ** 2 for c, s in zip(x, total)) for i, x in kept}
    return n, deviation, whitened, values[order] / np.trace(v)


def made(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(W, "ROWS", 7)
    monkeypatch.setattr(W, "COLUMNS", 4)


@pytest.mark.parametrize("d", [3, 8])
def test_equals_dense_whitening(spark, small_blocks, d):
    rng = np.random.default_rng(d)
    base = rng.normal(size=(90, d)) * np.arange(1, d + 1)
    rows = [(i, list(map(float, v))) for i, v in enumerate(base)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # copies of one vector
    rows += [(300, None), (301, [None] + [1.0] * (d - 1)), (302, [float("nan")] * d),
             (303, [float("inf")] * d)]
    n, deviation, whitened, shares = brute(rows)
    out = W.whiten(made(spark, rows).repartition(5)).collect()
    k = min(4, d)
    assert len(out) == k * 130
    assert {r["n"] for r in out} == {n} == {90}
    assert max(r["identity_error"] for r in out) < 1e-9
    assert len({r["identity_error"] for r in out}) == 1
    for c in range(1, k + 1):
        part = [r for r in out if r["component"] == c]
        assert {r["vec_id"]: r["deviation"] for r in part} == deviation
        assert all(math.isclose(r["explained"], shares[c - 1], rel_tol=1e-9) for r in part)
        ours = np.array([r["whitened"] for r in part])
        theirs = np.array([whitened[r["vec_id"]][c - 1] for r in part])
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-8


def test_defined_cases(spark, small_blocks):
    assert W.whiten(made(spark, [])).count() == 0
    assert W.whiten(made(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one vector
    # one direction only; a shorter vector is 0 where it ends; ids repeat or are missing
    rows = [(None, [1.0, 0.0]), (5, [2.0]), (5, [3.0, 0.0]), (6, [])]
    out = W.whiten(made(spark, rows)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in out) == [
        (0, 1), (5, 1), (5, 1), (6, 1)]
    assert {r["n"] for r in out} == {4}
    assert all(abs(r["explained"] - 1) < 1e-12 for r in out)
    extra = made(spark, rows).selectExpr("*", "1 AS n", "2 AS at", "3 AS x", "4 AS k")
    assert W.whiten(extra).count() == 4


def test_deviation_is_exact_beyond_doubles_and_null_beyond_longs():
    x = np.array([[10 ** 9, -3], [7, 10 ** 9 + 1]], np.int64)
    sums, n = [12345678901, -7], 3
    want = [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in x]
    assert W.deviations(x, sums, n) == [v if v < 1 << 63 else None for v in want]
    assert W.deviations(x * 10 ** 3, sums, n) == [None, None]


def test_given_table_has_unit_covariance(spark, sf_small):
    out = W.op13_block_whitening(spark, sf_small).toPandas()
    wide = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.cov(wide.T, bias=True) - np.eye(4)).max() < 1e-6
    assert out["identity_error"].max() < 1e-6
