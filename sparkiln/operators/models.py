"""Simple models behind the reference's prediction charts (ML1-ML7).

k-NN is exact without a cross product: points lie in cells of a bounded number of
rows below a tree of boxes, and each query descends (equi-joins on the node
number) only into boxes that its k-th distance so far reaches, so the answer
equals brute force while work stays near the queries.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkiln.functions.hashing import unit_draw
from sparkiln.functions.literals import literal_rows, plain_value
from sparkiln.operators import trees
from sparkiln.operators.ranking import group_rank
from sparkiln.session import materialize

LEAF_ROWS = 64  # rows of a k-NN cell at most (more where k asks for it)
FAN = 16  # children of a node above the cells


def hash_split(df: DataFrame, id_col, train_fraction: float = 0.75, seed: int = 42,
               out: str = "split") -> DataFrame:
    """ML1: deterministic train/test split from a hash of (seed, id)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return df.withColumn(out, F.when(unit_draw(c, seed) < F.lit(train_fraction), F.lit("train"))
                         .otherwise(F.lit("test")))


def linspace_grid(df: DataFrame, col: str, num: int = 100, out: str = "x") -> DataFrame:
    """ML7 (1-D): ``numpy.linspace(min, max, num)`` over a column, built from
    the one-row min/max aggregate (its size is ``num``, not the data)."""
    b = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    step = (F.col("hi") - F.col("lo")) / F.lit(num - 1)
    g = b.select("lo", "hi", step.alias("step"), F.explode(F.sequence(F.lit(0), F.lit(num - 1))).alias("i"))
    return g.select(F.col("i").cast("int").alias("i"),
                    F.when(F.col("i") == num - 1, F.col("hi"))
                    .otherwise(F.col("i") * F.col("step") + F.col("lo")).alias(out))


def mesh_grid(df: DataFrame, cols: Sequence[str], step: float, margin: float) -> DataFrame:
    """ML7 (2-D): ``numpy.arange(min - margin, max + margin, step)`` per column
    of two crossed into a mesh (qid, g0, g1); empty for an empty table.  The
    bounds are scalars; the mesh is a range of ids, made by all tasks."""
    if len(cols) != 2:
        raise ValueError("a mesh has two columns")
    spark, aggs = df.sparkSession, []
    for i, c in enumerate(cols):
        aggs += [F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}")]
    b = df.agg(*aggs).first()
    if any(b[c] is None for c in b.asDict()):
        return literal_rows(spark, [], "qid long, g0 double, g1 double")
    axes = []
    for i in range(len(cols)):
        lo, hi = b[f"lo{i}"] - margin, b[f"hi{i}"] + margin
        axes.append((lo, math.ceil((hi - lo) / step)))
    (lo0, n0), (lo1, n1) = axes
    at = F.col("id")
    return spark.range(n0 * n1).select(
        at.alias("qid"), (at % n0 * F.lit(step) + F.lit(lo0)).alias("g0"),
        (F.floor(at / n0) * F.lit(step) + F.lit(lo1)).alias("g1"))


def linear_fit(train: DataFrame, x: str, y: str) -> tuple[float, float]:
    """ML2: least-squares slope and intercept of one feature (two scalars)."""
    r = train.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                  F.regr_intercept(F.col(y), F.col(x)).alias("intercept")).first()
    return r["slope"], r["intercept"]


def linear_predict(grid: DataFrame, x: str, slope: float, intercept: float,
                   out: str = "y_pred") -> DataFrame:
    return grid.withColumn(out, F.lit(intercept) + F.lit(slope) * F.col(x))


def tree_fit_predict(train: DataFrame, grid: DataFrame, features: Sequence[str], label: str,
                     grid_features: Sequence[str] | None = None, out: str = "y_pred",
                     local_cells: int = trees.LOCAL_CELLS) -> DataFrame:
    """ML3: an exact regression tree without depth limit or bins, applied to a grid."""
    model = trees.fit_tree(train, features, label, local_cells)
    return trees.predict_tree(model, grid, grid_features or features, out)


def _leaf_splits(n: int, d: int, rows: int) -> list[int]:
    """Into how many parts of equal row counts each dimension in turn is cut, so that
    no cell of ``n`` rows in all has more than ``rows``."""
    cells, splits, held = -(-n // rows), [], n
    for i in range(d):
        cut = (-(-held // rows) if i == d - 1
               else max(1, math.ceil(cells ** (1.0 / (d - i)) - 1e-9)))
        splits.append(cut)
        held, cells = -(-held // cut), -(-cells // cut)
    return splits


def _box_distance(c: Column, d: int) -> Column:
    """Distance of the query (columns _g0, ...) from the box of node ``c``, 0 inside.
    The same operations in the same order as for a point, so that rounding never
    puts the box farther off than a point in it."""
    parts = [F.greatest(c[f"lo{i}"] - F.col(f"_g{i}"), F.lit(0.0), F.col(f"_g{i}") - c[f"hi{i}"])
             for i in range(d)]
    return F.sqrt(sum((p * p for p in parts), F.lit(0.0)))


def _point_distance(p: Column, d: int) -> Column:
    parts = [p[f"_f{i}"] - F.col(f"_g{i}") for i in range(d)]
    return F.sqrt(sum((x * x for x in parts), F.lit(0.0)))


def box_tree(train: DataFrame, d: int, n: int, rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """An index of ``n`` points (_id, _f0, ..., further columns): cells of at most
    ``rows`` points, equally deep in every dimension, and above them levels of
    nodes with the boxes of their ``FAN`` children.

    Rows are ranked by the first coordinate and cut into slabs of equal counts,
    ranked in each slab by the next coordinate, and so on; the ranks are exact and
    a hot value is spread over tasks (``group_rank``).  Far points, dense spots and
    points that coincide make small or overlapping boxes but no crowded cell.
    Returns (leaf, points, box) as a written table and, from the level above the leaves to the
    root, written tables (node, children).
    """
    extra = [c for c in train.columns]
    placed = train.withColumn("_leaf", F.lit(0).cast("long"))
    leaves = 1
    for i, cut in enumerate(_leaf_splits(n, d, rows)):
        ranked = group_rank(placed, ["_leaf"], [f"_f{i}", "_id"], out="_rank")
        # sizes of the parts differ by one at most
        part = F.floor(F.col("_rank") * cut / F.col("group_n"))
        placed = ranked.select(*extra, (F.col("_leaf") * cut + part).alias("_leaf"))
        leaves *= cut
    boxes = [agg for i in range(d) for agg in (F.min(f"_f{i}").alias(f"lo{i}"),
                                               F.max(f"_f{i}").alias(f"hi{i}"))]
    leaf = materialize(placed.groupBy("_leaf").agg(
        F.collect_list(F.struct(*extra)).alias("points"), *boxes, F.min("_id").alias("low")
    ).withColumnRenamed("_leaf", "node"), "knn-leaves")
    box = [f"{side}{i}" for i in range(d) for side in ("lo", "hi")]
    levels, below, count = [], leaf.select("node", *box, "low"), leaves
    while count > 1:
        count = -(-count // FAN)
        boxes = [agg for i in range(d) for agg in (F.min(f"lo{i}").alias(f"lo{i}"),
                                                   F.max(f"hi{i}").alias(f"hi{i}"))]
        level = materialize(below.groupBy(F.floor(F.col("node") / FAN).alias("up")).agg(
            F.collect_list(F.struct("node", *box, "low")).alias("children"), *boxes,
            F.min("low").alias("low")).withColumnRenamed("up", "node"), "knn-level")
        levels.append(level.select("node", "children"))
        below = level.select("node", *box, "low")
    return leaf, levels


def knn(train: DataFrame, query: DataFrame, features: Sequence[str], k: int,
        id: str = "id", qid: str = "qid", query_features: Sequence[str] | None = None,
        keep: Sequence[str] = (), cell: float | None = None, leaf_rows: int | None = None
        ) -> DataFrame:
    """Exact k nearest training rows for every query row (ML4, ML5).

    Output: qid, id, dist, rank (1..k, ties broken by id), keep columns.
    Training and query rows with a NULL or NaN feature are ignored.

    The points are indexed in cells of at most ``leaf_rows`` rows (``box_tree``).
    Every query first walks down to one near cell, whose k-th nearest point bounds
    its answer; then it descends again into every node whose box is within that
    bound (a node at the bound only if it holds a smaller id), and keeps the k
    nearest of the few cells reached.  Both walks are equi-joins on the node number,
    without an aggregate per level.  ``cell``, the width of former equal-width
    cells, is not used any more.
    """
    feats, qfeats = list(features), list(query_features or features)
    d, spark = len(feats), query.sparkSession
    rows = leaf_rows or max(LEAF_ROWS, 4 * k)

    def present(df: DataFrame, prefix: str) -> DataFrame:
        for i in range(d):
            c = F.col(f"{prefix}{i}")
            df = df.where(c.isNotNull() & ~F.isnan(c))
        return df

    tr = materialize(present(train.select(F.col(id).alias("_id"), *[
        F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(feats)], *keep), "_f"),
        "knn-points")
    n = tr.count()
    if n == 0:
        kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in train.select(*keep).schema)
        return literal_rows(spark, [], f"`{qid}` long, `{id}` long, dist double, rank int{kept}")
    leaf, levels = box_tree(tr, d, n, rows)
    place = [f"_g{i}" for i in range(d)]
    q = present(query.select(F.col(qid).alias("_q"), *[
        F.col(f).cast("double").alias(f"_g{i}") for i, f in enumerate(qfeats)]), "_g")
    root = plain_value(0).cast("long").alias("node")

    # one near cell for each query, and the k-th point in it
    walk = q.select("_q", *place, root)
    for level in reversed(levels):
        # of boxes equally near, the one whose middle is nearest
        middle = F.transform("children", lambda c: F.struct(
            _box_distance(c, d).alias("near"),
            sum(((c[f"lo{i}"] + c[f"hi{i}"]) / 2 - F.col(f"_g{i}")) ** 2 for i in range(d)),
            c["node"].alias("node")))
        walk = walk.join(level, "node").select("_q", *place, F.array_min(middle)["node"].alias("node"))
    found = F.array_sort(F.transform("points", lambda p: F.struct(
        _point_distance(p, d).alias("dist"), p["_id"].alias("id"))))
    bounded = materialize(walk.join(leaf.select("node", "points"), "node").select(
        "_q", *place, F.get(found, F.lit(k - 1)).alias("_bound")), "knn-bounds")

    reach = bounded.select("*", root)
    for level in reversed(levels):
        near = F.filter("children", lambda c: F.col("_bound").isNull() | (F.struct(
            _box_distance(c, d).alias("dist"), c["low"].alias("id")) <= F.col("_bound")))
        reach = reach.join(level, "node").select(
            "_q", *place, "_bound", F.explode(F.transform(near, lambda c: c["node"])).alias("node"))
    dist = F.sqrt(sum(((F.col(f"p._f{i}") - F.col(f"_g{i}")) * (F.col(f"p._f{i}") - F.col(f"_g{i}"))
                       for i in range(d)), F.lit(0.0)))
    points = (reach.join(leaf.select("node", "points"), "node")
              .select("_q", *place, "_bound", F.explode("points").alias("p"))
              .select("_q", "_bound", "p._id", dist.alias("dist"), *[f"p.{c}" for c in keep]))
    within = points.where(F.col("_bound").isNull() | (
        F.struct("dist", F.col("_id").alias("id")) <= F.col("_bound")))
    nearest = Window.partitionBy("_q").orderBy("dist", "_id")
    return within.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select(
        F.col("_q").alias(qid), F.col("_id").alias(id), "dist", "rank", *keep)


def knn_regress(train: DataFrame, query: DataFrame, features: Sequence[str], label: str,
                k: int = 5, id: str = "id", qid: str = "qid",
                query_features: Sequence[str] | None = None, out: str = "y_pred") -> DataFrame:
    """ML4: mean label of the k nearest training rows (uniform weights)."""
    nb = knn(train, query, features, k, id, qid, query_features, keep=[label])
    return nb.groupBy(qid).agg(F.avg(label).alias(out))


def knn_classify(train: DataFrame, query: DataFrame, features: Sequence[str], label: str,
                 k: int = 15, id: str = "id", qid: str = "qid",
                 query_features: Sequence[str] | None = None) -> DataFrame:
    """ML5 + ML6: distance-weighted k-NN class probabilities.

    Weights are 1/d; when some neighbours sit at distance 0 they alone count
    (weight 1 each).  Output: qid, pred (highest probability, lowest class on
    ties), p_max, confidence = max p - (sum p - max p).
    """
    nb = knn(train, query, features, k, id, qid, query_features, keep=[label])
    has_zero = F.max(F.when(F.col("dist") == 0, 1).otherwise(0)).over(Window.partitionBy(qid))
    wt = F.when(has_zero == 1, F.when(F.col("dist") == 0, 1.0).otherwise(0.0)) \
        .otherwise(F.lit(1.0) / F.col("dist"))
    per_class = (nb.withColumn("w", wt).groupBy(qid, label).agg(F.sum("w").alias("w")))
    tot = F.sum("w").over(Window.partitionBy(qid))
    probs = per_class.withColumn("p", F.col("w") / tot)
    best = Window.partitionBy(qid).orderBy(F.desc("p"), F.asc(label))
    ranked = probs.withColumn("_r", F.row_number().over(best))
    return ranked.groupBy(qid).agg(
        F.max(F.when(F.col("_r") == 1, F.col(label))).alias("pred"),
        F.max("p").alias("p_max"),
        (2 * F.max("p") - F.sum("p")).alias("confidence"))
