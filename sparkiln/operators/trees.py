"""Regression trees without depth limit or bins (ML3).

The tree is grown level by level from sufficient statistics.  Rows with equal
features are one cell (count and sum of the label, combined before the shuffle).  In
every open node and for every feature, the cells' counts and sums are added up along
the feature's values (range-partitioned, so that the root's values are spread over
many tasks), which gives the squared error of every possible cut, and the best cut
of each node splits its cells.  A node of few cells is finished by one task, with the
same rule, so deep branches cost no further passes.

With one feature the order of the cells never changes and a node is an interval: the
sums are added up once, and a level is one pass over them (``_line_cuts``).

Rules: a cut lies half-way between two neighbouring values, ``x <= threshold`` goes
left; the cut with the smallest squared error wins, on ties the first
feature, then the smallest value; a node ends when its labels are equal or
its features are.  Rows with a missing (NULL, NaN) feature or label teach nothing;
a row with a missing feature has no prediction.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkiln.functions.literals import literal_rows, plain_value
from sparkiln.session import materialize

LOCAL_CELLS = 65_536  # distinct feature rows of a node that one task may finish
LINE_CELLS = 100_000  # cells of a range of values where there is one feature
GROUP = 64  # leaves of a node that a row is compared with in one go
INF = float("inf")


@dataclass
class RegressionTree:
    """``splits``: a table (node, feature, threshold) for every level that needed the
    cluster; ``leaves``: (node, group, lo0, hi0, ..., value), the boxes lo < x <= hi
    into which such a node falls, up to ``GROUP`` neighbours in a group.  A node is named by the
    turns (L, R) that lead to it."""
    features: list[str]
    splits: list[DataFrame]
    leaves: DataFrame
    empty: bool


def _half_way(below: Column, above: Column) -> Column:
    middle = below / 2 + above / 2
    return F.when(middle < above, middle).otherwise(below)


def _along(cells: DataFrame, feature: int) -> DataFrame:
    """node, value, n and s of the rows up to the value, and all and total of the node."""
    counted = cells.groupBy("node", F.col(f"f{feature}").alias("value")).agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"))
    # written: the bounds of a range shuffle come from a sample
    staged = materialize(counted.repartitionByRange("node", "value")
                         .withColumn("part", F.spark_partition_id()), "tree-values")
    whole = Window.partitionBy("node")
    ahead = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = staged.groupBy("part", "node").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    parts = parts.select(
        F.col("part").alias("_part"), F.col("node").alias("_node"),
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("s").over(ahead), F.lit(0.0)).alias("s0"),
        F.sum("n").over(whole).alias("all"), F.sum("s").over(whole).alias("total"))
    inside = Window.partitionBy("part", "node").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = staged.select("part", "node", "value", F.sum("n").over(inside).alias("n"),
                          F.sum("s").over(inside).alias("s"))
    return local.join(parts, (F.col("part") == F.col("_part")) & (F.col("node") == F.col("_node"))
                      ).select("node", "value", (F.col("n") + F.col("n0")).alias("n"),
                               (F.col("s") + F.col("s0")).alias("s"), "all", "total")


def best_cuts(cells: DataFrame, d: int) -> DataFrame:
    """node, feature, threshold: the cut of each node with the smallest squared error,
    that is the largest s^2/n of both sides.  Written."""
    cuts = None
    for j in range(d):
        rest_n, rest_s = F.col("all") - F.col("n"), F.col("total") - F.col("s")
        gain = F.col("s") * F.col("s") / F.col("n") + rest_s * rest_s / rest_n
        part = _along(cells, j).where(F.col("n") < F.col("all")).select(
            "node", F.struct(gain.alias("gain"), F.lit(-j).alias("minus"),
                             (-F.col("value")).alias("below")).alias("cut"))
        cuts = part if cuts is None else cuts.unionByName(part)
    best = cuts.groupBy("node").agg(F.max("cut").alias("cut")).select(
        "node", (-F.col("cut.minus")).alias("feature"), (-F.col("cut.below")).alias("below"))
    value = F.get(F.array(*[F.col(f"f{j}") for j in range(d)]), F.col("feature"))
    ends = cells.join(best, "node").groupBy("node", "feature", "below").agg(
        F.min(F.when(value > F.col("below"), value)).alias("above"))
    return materialize(ends.select("node", "feature",
                                   _half_way(F.col("below"), F.col("above")).alias("threshold")),
                       "tree-splits")


def local_boxes(x: np.ndarray, n: np.ndarray, s: np.ndarray, low: np.ndarray, high: np.ndarray
                ) -> list[tuple]:
    """Leaves (lo0, hi0, ..., value) of the tree of some cells, neighbours together."""
    d = x.shape[1]
    out, open_ = [], [(np.arange(len(x)), [-INF] * d, [INF] * d)]
    while open_:
        rows, lo, hi = open_.pop()
        best = None
        if low[rows].min() < high[rows].max():
            for j in range(d):
                order = rows[np.argsort(x[rows, j], kind="stable")]
                at = np.flatnonzero(np.diff(x[order, j]) > 0)
                if len(at):
                    left_n, left_s = np.cumsum(n[order]), np.cumsum(s[order])
                    rest_n, rest_s = left_n[-1] - left_n[at], left_s[-1] - left_s[at]
                    gain = left_s[at] ** 2 / left_n[at] + rest_s ** 2 / rest_n
                    top = int(np.argmax(gain))
                    if best is None or gain[top] > best[0]:
                        a, b = x[order[at[top]], j], x[order[at[top] + 1], j]
                        middle = a / 2 + b / 2
                        best = gain[top], j, middle if middle < b else a
        if best is None:
            out.append((*[v for pair in zip(lo, hi) for v in pair], s[rows].sum() / n[rows].sum()))
            continue
        _, j, threshold = best
        left = x[rows, j] <= threshold
        open_.append((rows[left], lo, [*hi[:j], threshold, *hi[j + 1:]]))
        open_.append((rows[~left], [*lo[:j], threshold, *lo[j + 1:]], hi))
    return out


def fit_tree(train: DataFrame, features: Sequence[str], label: str,
             local_cells: int = LOCAL_CELLS) -> RegressionTree:
    d = len(features)
    names = [f"f{j}" for j in range(d)]
    rows = train.select(*[F.col(f).cast("double").alias(c) for f, c in zip(features, names)],
                        F.col(label).cast("double").alias("y"))
    for c in (*names, "y"):
        rows = rows.where(F.col(c).isNotNull() & ~F.isnan(c))
    cells = materialize(rows.groupBy(*names).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.min("y").alias("low"),
        F.max("y").alias("high")).withColumn("node", F.lit("")), "tree-cells")
    box = [f"{side}{j}" for j in range(d) for side in ("lo", "hi")]
    schema = "node string, " + ", ".join(f"{b} double" for b in box) + ", value double"
    splits, leaves, small = [], [], []
    if d == 1:
        splits, cells = _line_cuts(cells, local_cells)

    def finish(part: pd.DataFrame) -> pd.DataFrame:
        boxes = local_boxes(part[names].to_numpy(), *[part[c].to_numpy()
                                                      for c in ("n", "s", "low", "high")])
        out = pd.DataFrame(boxes, columns=[*box, "value"])
        out.insert(0, "node", part["node"].iloc[0])
        out.insert(1, "group", np.arange(len(out)) // GROUP)
        return out

    while True:
        nodes = cells.groupBy("node").agg(
            F.count(F.lit(1)).alias("cells"), F.min("low").alias("least"),
            F.max("high").alias("most"), (F.sum("s") / F.sum("n")).alias("value"))
        state = materialize(nodes.select(
            "node", "value", F.when(F.col("least") == F.col("most"), "even").when(
                F.col("cells") <= local_cells, "small").otherwise("open").alias("kind")),
            "tree-nodes")
        kinds = {r["kind"] for r in state.select("kind").distinct().collect()}
        if "even" in kinds:
            ends = [F.lit(v).alias(b) for b, v in zip(box, [-INF, INF] * d)]
            leaves.append(state.where("kind = 'even'").select(
                "node", F.lit(0).cast("long").alias("group"), *ends, "value"))
        if "small" in kinds:
            small.append(cells.join(state.where("kind = 'small'").select("node"), "node")
                         .select("node", *names, "n", "s", "low", "high"))
        if "open" not in kinds:
            break
        cells = cells.join(state.where("kind = 'open'").select("node"), "node")
        cuts = best_cuts(cells, d)
        splits.append(cuts)
        cells = materialize(cells.join(cuts, "node").withColumn(
            "node", _turn([F.col(c) for c in names])).select(*names, "n", "s", "low", "high", "node"),
            "tree-cells")
    schema = ("node string, group long, " + ", ".join(f"{b} double" for b in box)
              + ", value double")
    if small:
        # a group is one node, of at most ``local_cells`` cells
        leaves.append(materialize(reduce(DataFrame.unionByName, small).groupBy("node")
                                  .applyInPandas(finish, schema), "tree-leaves"))
    made = reduce(DataFrame.unionByName, leaves or [literal_rows(train.sparkSession, [], schema)])
    return RegressionTree(list(features), splits, made, not leaves)


def _line_cuts(cells: DataFrame, local_cells: int) -> tuple[list[DataFrame], DataFrame]:
    """The cuts of the nodes that are too large for one task, where there is one feature:
    as tables (node, feature, threshold) of a balanced search tree over all of them, and the
    cells with the leaf of that search tree as their node.

    ``staged`` has the cells in ranges of the value, with sums along the range.  What the
    driver holds is a row per range and per open node: a node's sums at a cell are those of
    the cell's range and those of the ranges before it that lie in the node."""
    spark = cells.sparkSession
    n = cells.count()
    if n <= local_cells:
        return [], cells
    ranged = cells.repartitionByRange(max(2, -(-n // LINE_CELLS)), "f0").withColumn(
        "part", F.spark_partition_id())
    order = Window.partitionBy("part").orderBy("f0")
    along = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # written: the bounds of a range shuffle come from a sample
    staged = materialize(materialize(ranged, "tree-values").select(
        "part", "f0", "n", "s", "low", "high", F.row_number().over(order).alias("at"),
        F.sum("n").over(along).alias("n_to"), F.sum("s").over(along).alias("s_to"),
        F.lead("f0").over(order).alias("above")), "tree-line")
    parts = [r.asDict() for r in staged.groupBy("part").agg(
        F.min("f0").alias("least"), F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n"),
        F.sum("s").alias("s")).orderBy("part").collect()]
    numbers = [p["part"] for p in parts]
    table = "part int, node int, at0 int, at1 int, n0 long, s0 double, whole long, total double"

    def start(p: int) -> tuple:
        return p, 0, 0, 0.0  # a place: range, cells, n and s of the range up to it

    def end(p: int) -> tuple:
        return p, parts[p]["cells"], parts[p]["n"], parts[p]["s"]

    def pieces(lo: tuple, hi: tuple) -> list[tuple]:
        """What lies between two places, by range."""
        both = [(lo if p == lo[0] else start(p), hi if p == hi[0] else end(p))
                for p in range(lo[0], hi[0] + 1)]
        return [(a, b) for a, b in both if b[1] > a[1]]

    open_ = [(start(0), end(len(parts) - 1))]
    cuts: list[float] = []
    while open_:
        rows = []
        for i, node in enumerate(open_):
            held = pieces(*node)
            whole, total = sum(b[2] - a[2] for a, b in held), math.fsum(b[3] - a[3] for a, b in held)
            n0, s0 = 0, 0.0
            for a, b in held:
                rows.append((numbers[a[0]], i, a[1], b[1], n0 - a[2], s0 - a[3], whole, total))
                n0, s0 = n0 + b[2] - a[2], s0 + b[3] - a[3]
        met = staged.join(F.broadcast(literal_rows(spark, rows, table)), "part").where(
            "at > at0 AND at <= at1")
        left_n, left_s = F.col("n_to") + F.col("n0"), F.col("s_to") + F.col("s0")
        rest_n, rest_s = F.col("whole") - left_n, F.col("total") - left_s
        gain = left_s * left_s / left_n + rest_s * rest_s / rest_n
        cut = F.when(rest_n > 0, F.struct(gain.alias("gain"), (-F.col("f0")).alias("below"), "part",
                                          "at", "n_to", "s_to", "above"))
        found = met.groupBy("node").agg(F.max(cut).alias("cut"), F.min("low").alias("least"),
                                        F.max("high").alias("most")).collect()
        deeper = []
        for r in found:
            if r["least"] == r["most"]:
                continue  # equal labels: one leaf
            c, p, (lo, hi) = r["cut"], numbers.index(r["cut"]["part"]), open_[r["node"]]
            below = -c["below"]
            above = c["above"] if c["above"] is not None else parts[p + 1]["least"]
            middle = below / 2 + above / 2
            cuts.append(middle if middle < above else below)
            place = (p, c["at"], c["n_to"], c["s_to"])
            deeper += [child for child in ((lo, place), (place, hi))
                       if sum(b[1] - a[1] for a, b in pieces(*child)) > local_cells]
        open_ = deeper
    return _search_tree(spark, sorted(cuts), cells)


def _search_tree(spark: SparkSession, cuts: list[float], cells: DataFrame
                 ) -> tuple[list[DataFrame], DataFrame]:
    """Tables of a balanced search tree over the sorted ``cuts``, a level each, and the
    cells with the interval that they fall into as their node."""
    splits, level = [], [("", 0, len(cuts))]
    while level:
        rows, below = [], []
        for node, a, b in level:
            if a < b:
                mid = (a + b) // 2
                rows.append((node, 0, cuts[mid]))
                below += [(node + "L", a, mid), (node + "R", mid + 1, b)]
        if rows:
            splits.append(literal_rows(spark, rows, "node string, feature int, threshold double"))
        level = below
    for table in splits:
        cells = _descend(cells, table, ["f0"], ["n", "s", "low", "high"])
    return splits, materialize(cells, "tree-cells") if splits else cells


def _descend(rows: DataFrame, cuts: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """Rows one level further down: those of a node without a cut stay."""
    return rows.join(cuts, "node", "left").select(
        *keep, *names, F.when(F.col("feature").isNull(), F.col("node"))
        .otherwise(_turn([F.col(c) for c in names])).alias("node"))


def _turn(values: Sequence[Column]) -> Column:
    value = F.get(F.array(*values), F.col("feature"))
    return F.concat("node", F.when(value <= F.col("threshold"), "L").otherwise("R"))


def predict_tree(tree: RegressionTree, df: DataFrame, features: Sequence[str] | None = None,
                 out: str = "y_pred") -> DataFrame:
    """``df`` with the value of the leaf that each row falls into."""
    features = list(features or tree.features)
    d = len(features)
    whole = F.struct(*[F.col(c) for c in df.columns]).alias("row")
    rows = df.select(whole, *[F.col(f).cast("double").alias(f"f{j}")
                              for j, f in enumerate(features)],
                     plain_value("").alias("node"))
    names = [f"f{j}" for j in range(d)]
    for cuts in tree.splits:
        rows = _descend(rows, cuts, names, ["row"])
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(c) for c in names])
    # which groups of leaves, then which leaf: one for each row without missing features
    edges = [agg for c in names for agg in (F.min(f"lo{c[1:]}").alias(f"lo{c[1:]}"),
                                            F.max(f"hi{c[1:]}").alias(f"hi{c[1:]}"))]
    groups = tree.leaves.groupBy("node", "group").agg(*edges)
    found = (_inside(rows.where(~missing), groups, d, ["node"]).select("row", *names, "node", "group"))
    found = _inside(found, tree.leaves, d, ["node", "group"]).select("row", "value")
    none = rows if tree.empty else rows.where(missing)
    return found.unionByName(none.select("row", F.lit(None).cast("double").alias("value"))).select(
        *[F.col(f"row.`{c}`").alias(c) for c in df.columns], F.col("value").alias(out))


def _inside(rows: DataFrame, boxes: DataFrame, d: int, keys: list[str]) -> DataFrame:
    """Rows with the boxes of their ``keys`` that they lie in."""
    met = rows.join(boxes, keys)
    for j in range(d):
        x, lo = F.col(f"f{j}"), F.col(f"lo{j}")
        met = met.where(((x > lo) | (lo == -INF)) & (x <= F.col(f"hi{j}")))
    return met
