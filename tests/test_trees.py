"""The distributed regression tree against one grown node by node in plain Python."""

import math
import random

import pytest

from sparkiln.operators import models as ML
from sparkiln.operators import trees as T


def grow(rows):
    """rows: (features, label); nested (feature, threshold, left, right) or a mean."""
    labels = [y for _, y in rows]
    best = None
    if min(labels) < max(labels):
        for j in range(len(rows[0][0])):
            values = sorted({x[j] for x, _ in rows})
            for a, b in zip(values, values[1:]):
                left = [y for x, y in rows if x[j] <= a]
                right = [y for x, y in rows if x[j] > a]
                gain = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right)
                if best is None or gain > best[0] + 1e-9:
                    best = gain, j, (a + b) / 2
    if best is None:
        return sum(labels) / len(labels)
    _, j, t = best
    return (j, t, grow([r for r in rows if r[0][j] <= t]), grow([r for r in rows if r[0][j] > t]))


def value(tree, x):
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("local_cells", [4, 1000])
def test_equals_a_tree_grown_in_one_place(spark, local_cells):
    rnd = random.Random(4)
    rows = [((rnd.randrange(12) / 2, rnd.randrange(9) * 1.5), rnd.randrange(1000) * 1.0)
            for _ in range(70)]
    rows += [((3.0, 3.0), y) for y in (1.0, 5.0, 5.0)] * 5  # one crowded cell
    tree = grow(rows)
    train = spark.createDataFrame([(*x, y) for x, y in rows], "a double, b double, y double")
    points = [(rnd.uniform(-1, 8), rnd.uniform(-1, 14)) for _ in range(150)] + [x for x, _ in rows]
    grid = spark.createDataFrame([(i, *p) for i, p in enumerate(points)],
                                 "i long, node double, value double")
    got = {r["i"]: r["y_pred"] for r in ML.tree_fit_predict(
        train, grid, ["a", "b"], "y", ["node", "value"], local_cells=local_cells).collect()}
    assert len(got) == len(points)
    assert all(math.isclose(got[i], value(tree, p)) for i, p in enumerate(points))


def test_defined_cases(spark):
    nan = float("nan")
    train = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0), (None, 9.0), (nan, 9.0), (5.0, None)],
                                  "x double, y double")
    grid = spark.createDataFrame([(1, 2.0), (2, 2.1), (3, None), (4, nan)], "i long, x double")
    tree = T.fit_tree(train, ["x"], "y")
    got = {r["i"]: r["y_pred"] for r in T.predict_tree(tree, grid).collect()}
    assert got == {1: 2.0, 2: 4.0, 3: None, 4: None}  # on the threshold goes left
    none = T.predict_tree(T.fit_tree(train.where("x > 9 AND NOT isnan(x)"), ["x"], "y"), grid)
    assert [r["y_pred"] for r in none.collect()] == [None] * 4
    # many different rows with one label end as one leaf, without a task for them all
    even = spark.range(500).selectExpr("id + 0.5 AS x", "7.0 AS y")
    tree = T.fit_tree(even, ["x"], "y", local_cells=10)
    assert tree.splits == [] and tree.leaves.count() == 1


def test_depth_is_not_limited(spark):
    """Powers of two: every cut takes one value off, 60 levels deep."""
    rows = [(float(i), float(2 ** i)) for i in range(60)]
    train = spark.createDataFrame(rows, "x double, y double")
    got = T.predict_tree(T.fit_tree(train, ["x"], "y"), train).collect()
    assert all(r["y_pred"] == r["y"] for r in got) and len(got) == 60


@pytest.mark.parametrize("line_cells", [7, 1000])
def test_one_feature_needs_no_pass_per_node(spark, monkeypatch, line_cells):
    """The cuts of large nodes come from sums added up once: equal to the tree grown in one
    place, without a range shuffle per level and with few tables to descend through."""
    monkeypatch.setattr(T, "LINE_CELLS", line_cells)
    rnd = random.Random(8)
    rows = [((rnd.randrange(90) / 4,), rnd.randrange(50) * 1.0) for _ in range(300)]
    tree = grow(rows)
    train = spark.createDataFrame([(*x, y) for x, y in rows], "x double, y double")
    shuffles = []
    monkeypatch.setattr(T, "_along", lambda *a: shuffles.append(a))
    fitted = T.fit_tree(train, ["x"], "y", local_cells=5)
    assert not shuffles and 1 < len(fitted.splits) <= 7
    points = [(i, rnd.uniform(-1, 24)) for i in range(200)] + [
        (200 + i, x[0]) for i, (x, _) in enumerate(rows)]
    got = {r["i"]: r["y_pred"] for r in T.predict_tree(
        fitted, spark.createDataFrame(points, "i long, x double")).collect()}
    assert len(got) == len(points)
    assert all(math.isclose(got[i], value(tree, (x,))) for i, x in points)
