"""Connected components of a link table, for the near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkiln.llm.tables import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One half round of the alternating-star method: every node's neighbours
    (the larger ones, or the smaller ones and itself) are linked to the
    smallest node around it.  Only minima are aggregated, so a node with very
    many links is a partial minimum per task and never a list."""
    if large:
        arcs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        arcs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = arcs.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("_a"), F.least("a", "m").alias("m"))
    met = arcs.join(low, F.col("a") == F.col("_a"))
    if large:
        linked = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"),
                                                           F.col("m").alias("b"))
        return linked.where(F.col("a") != F.col("b"))
    linked = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        low.select(F.col("_a").alias("a"), F.col("m").alias("b")))
    return linked.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (long columns a, b that
    are not NULL); the component is its smallest node.  Rounds are written
    tables; the number of rounds grows with the logarithm of the longest
    chain.  They end when every node is a root or hangs on one root."""
    now = edges.where(F.col("a") != F.col("b")).select("a", "b")
    while True:
        now = materialize(_stars(_stars(now, True), False), "links")
        parents = now.select(F.col("a").alias("node"), F.col("b").alias("p")).unionByName(
            now.select(F.col("b").alias("node"), F.col("b").alias("p")))
        found = materialize(parents.groupBy("node").agg(
            F.min("p").alias("component"), F.max("p").alias("top")), "components")
        if found.where("component != top").isEmpty():
            return found.select("node", "component")
