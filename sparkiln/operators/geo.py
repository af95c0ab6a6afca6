"""Point tables: map projection and ordered tracks (FN20, AGG25)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkiln.functions.geo import web_mercator_x, web_mercator_y
from sparkiln.operators.ranking import group_rank


def project_points(df: DataFrame, lat: str, lon: str, x: str = "x", y: str = "y") -> DataFrame:
    """FN20: add Web Mercator (EPSG:3857) coordinates to a lat/lon table."""
    return df.withColumn(x, web_mercator_x(F.col(lon))).withColumn(y, web_mercator_y(F.col(lat)))


def tracks(df: DataFrame, key: str, ts: str, cols: Sequence[str], tie: str | None = None,
           out: str = "seq") -> DataFrame:
    """AGG25: each object's positions in time order, as long rows
    (key, seq, ts, cols...) with seq = 0, 1, ... per object.

    The reference accumulates a list per object; here the order is an exact
    rank from ``group_rank`` (range-partitioned), so an object with a third
    of all rows is still spread over many tasks and never collected into one
    array.
    """
    order = [ts] + ([tie] if tie else [])
    base = df.select(key, ts, *([tie] if tie and tie not in cols else []), *cols)
    ranked = group_rank(base, [key], order, out=out)
    return ranked.select(key, out, ts, *cols)


def region_table(spark, regions) -> DataFrame:
    """A (name, priority, polygon) table from (name, vertices) pairs in
    priority order (priority 1 first)."""
    from sparkiln.functions.literals import literal_rows
    rows = [(name, i + 1, [[float(a), float(b)] for a, b in poly])
            for i, (name, poly) in enumerate(regions)]
    return literal_rows(spark, rows, "name string, priority int, polygon array<array<double>>")


def label_region_table(points: DataFrame, x: str, y: str, regions: DataFrame, cell: float,
                       out: str = "region") -> DataFrame:
    """PRJ5 for many regions held in a table (name, priority, polygon).

    Each region is exploded to the grid cells its bounding box covers, and the
    cells are grouped to one row per cell with its regions as an array (bounded
    by the regions that overlap there).  A point meets its own cell's row only, so
    it is tested against the regions near it, and the matching region of the
    lowest priority number wins: one output row per point inside a region,
    duplicates and rows without an id included.  Points in no region are dropped.
    Spark broadcasts the cells if their size allows.
    """
    from sparkiln.functions.geo import in_polygon
    xs = F.transform("polygon", lambda p: F.element_at(p, 1))
    ys = F.transform("polygon", lambda p: F.element_at(p, 2))

    def side(values, pick):
        return F.floor(pick(values) / cell).cast("long")

    cells = (regions.select("name", "priority", "polygon",
                            F.explode(F.sequence(side(xs, F.array_min), side(xs, F.array_max)))
                            .alias("_cx"),
                            side(ys, F.array_min).alias("_y0"), side(ys, F.array_max).alias("_y1"))
             .select("name", "priority", "polygon", "_cx",
                     F.explode(F.sequence("_y0", "_y1")).alias("_cy"))
             .groupBy("_cx", "_cy")
             .agg(F.collect_list(F.struct("priority", "name", "polygon")).alias("_near")))
    placed = points.select("*", F.floor(F.col(x) / cell).cast("long").alias("_cx"),
                           F.floor(F.col(y) / cell).cast("long").alias("_cy"))
    inside = F.filter("_near", lambda r: in_polygon(F.col(x), F.col(y), r["polygon"]))
    first = F.array_min(F.transform(inside, lambda r: F.struct(r["priority"], r["name"])))
    return (placed.join(cells, ["_cx", "_cy"])
            .select(*[F.col(c) for c in points.columns], first["name"].alias(out))
            .where(F.col(out).isNotNull()))
