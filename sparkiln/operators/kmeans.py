"""K-Means clustering as Spark jobs driven by a small driver loop (CL1-CL8,
AGG9-AGG12, JN6, JN8).

Only k centroids (2-D) or k scalars per round (sparse) reach the driver.

* 2-D: the k centroids are literals in the assignment expression, so a round
  is one scan of the persisted points plus a k-row partial aggregate: no
  join, no cross product, no shuffle of points.
* Sparse cosine: documents are long (doc, term, value) rows, laid out once in
  (document block, term block) tiles (``Tiles``).  A round brings the sparse centroid
  rows to the tiles, sums the products per document in each tile and then over
  them, brings the assignments to the tiles and averages (cluster, term) values for
  the new centroids.  The vectors are not shuffled again.  Centroid tables are
  checkpointed each round to cut lineage, in buckets by term, so that they are packed
  and compared where they lie.  Vectors that lie by tile already are packed into
  arrays, and the same steps are done in numpy, a tile or a bucket of terms a
  group (``packed.Packed``): the rounds are the same, an entry's visit takes less.

Rules kept from the reference: ties go to the lowest cluster index; a zero
vector is at "infinite" distance, so a document with no usable distance
lands in cluster 1; a centroid averages a term over the vectors that hold
it (absent terms are not zeros); the loop stops when a cluster empties, when
the largest centroid shift is below (2-D, strict) or at most (cosine) the
tolerance, or after ``max_iter`` rounds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StructField, StructType)

from sparkiln.functions.hashing import unit_draw
from sparkiln.functions.literals import literal_rows
from sparkiln.operators.packed import Packed, read_sums
from sparkiln.sinks.files import RoundReport
from sparkiln.session import (materialize, materialize_blocks, partition_keys, planned_with,
                              sized_partitions)

INF = float("inf")


def first_min_index(dists: Sequence[Column]) -> Column:
    """1-based index of the first smallest distance (lowest index on ties)."""
    m = F.least(*dists)
    expr = None
    for j, d in enumerate(dists, start=1):
        expr = F.when(d == m, F.lit(j)) if expr is None else expr.when(d == m, F.lit(j))
    return expr.otherwise(F.lit(1))


def random_partition_groups(df: DataFrame, id: str, k: int, seed: int) -> Column:
    """CL1 seeding groups: the first k rows by id seed clusters k, k-1, ..., 1;
    every other row draws a cluster from a hash of (seed, id).

    The first-k ids come from a top-k (``orderBy(id).limit(k)``: a per-task
    limit, then k rows to the driver)."""
    first = [r[0] for r in df.select(id).where(F.col(id).isNotNull())
             .orderBy(id).limit(k).collect()]
    drawn = (F.floor(unit_draw(F.col(id), seed) * F.lit(k)) + 1).cast("int")
    expr = None
    for r, fid in enumerate(first):
        cond = F.col(id) == F.lit(fid)
        expr = F.when(cond, F.lit(k - r)) if expr is None else expr.when(cond, F.lit(k - r))
    return expr.otherwise(drawn) if expr is not None else drawn


# ---------------------------------------------------------------------- 2-D

@dataclass
class KMeans2DResult:
    assignments: DataFrame
    centroids: DataFrame
    history: DataFrame
    iterations: int
    converged: bool
    centroid_list: list = field(default_factory=list)


def _euclid(x: Column, y: Column, cx: float, cy: float) -> Column:
    dx, dy = x - F.lit(cx), y - F.lit(cy)
    return F.sqrt(dx * dx + dy * dy)


def assign_2d(points: DataFrame, centroids: Sequence[tuple[float, float]],
              x: str = "x", y: str = "y", out: str = "cluster") -> DataFrame:
    """JN6 in 2-D: nearest centroid by Euclidean distance, centroids inlined
    as literals (no join)."""
    dists = [_euclid(F.col(x), F.col(y), cx, cy) for cx, cy in centroids]
    return points.withColumn(out, first_min_index(dists))


def _centroid_rows(df: DataFrame, group: Column, x: str, y: str):
    rows = df.groupBy(group.alias("cluster")).agg(
        F.avg(x).alias("x"), F.avg(y).alias("y"), F.count(F.lit(1)).alias("size")).collect()
    return {r["cluster"]: (r["x"], r["y"], r["size"]) for r in rows}


def seed_random_partition_2d(points: DataFrame, k: int, seed: int = 0, id: str = "id",
                             x: str = "x", y: str = "y") -> list[tuple[float, float]]:
    """CL1: initial centroids = means of a random partition of the points."""
    cents = _centroid_rows(points, random_partition_groups(points, id, k, seed), x, y)
    return [(cents[c][0], cents[c][1]) if c in cents else (math.nan, math.nan)
            for c in range(1, k + 1)]


def kmeans_2d(points: DataFrame, k: int = 3, max_iter: int = 20, tol: float = 1e-3,
              init: Sequence[tuple[float, float]] | None = None, seed: int = 0,
              id: str = "id", x: str = "x", y: str = "y") -> KMeans2DResult:
    """CL2 (+CL6-CL8, AGG12): Lloyd's algorithm on (id, x, y) points.

    Rows with a NULL or NaN coordinate are skipped (the reference skips unparsable
    lines).  Returns the last round's assignments (made with the centroids
    entering that round) and centroids, plus every round's centroids.
    """
    spark = points.sparkSession
    pts = (points.select(F.col(id).alias("id"), F.col(x).cast("double").alias("x"),
                         F.col(y).cast("double").alias("y"))
           .where(F.col("x").isNotNull() & F.col("y").isNotNull()
                  & ~F.isnan("x") & ~F.isnan("y"))
           .persist(StorageLevel.MEMORY_AND_DISK))
    cents = list(init) if init is not None else seed_random_partition_2d(pts, k, seed)
    history = []
    used = cents
    iterations, converged = 0, False
    new_map = {}
    for it in range(1, max_iter + 1):
        used = cents
        assigned = assign_2d(pts, cents)
        new_map = _centroid_rows(assigned, F.col("cluster"), "x", "y")
        iterations = it
        if len(new_map) != k:  # CL7: a cluster emptied
            shift = None
        else:
            shift = max([math.sqrt((cents[j - 1][0] - new_map[j][0]) ** 2
                                   + (cents[j - 1][1] - new_map[j][1]) ** 2)
                         for j in range(1, k + 1)] + [5e-324])
        for c in sorted(new_map):
            cx, cy, n = new_map[c]
            history.append((it, c, cx, cy, n, shift))
        if shift is None:
            break
        cents = [(new_map[j][0], new_map[j][1]) for j in range(1, k + 1)]
        if shift < tol:  # CL6, strict in 2-D
            converged = True
            break
    assignments = assign_2d(pts, used).select("id", "x", "y", "cluster")
    schema = StructType([StructField("cluster", IntegerType()), StructField("x", DoubleType()),
                         StructField("y", DoubleType()), StructField("size", LongType())])
    final = literal_rows(spark, [(c, *new_map[c]) for c in sorted(new_map)], schema)
    hist_schema = StructType([StructField("iteration", IntegerType()), *schema.fields,
                              StructField("shift", DoubleType())])
    hist = literal_rows(spark, history, hist_schema)
    return KMeans2DResult(assignments, final, hist, iterations, converged,
                          [(c, *new_map[c]) for c in sorted(new_map)])


# ------------------------------------------------------------------- sparse

@dataclass
class KMeansCosineResult:
    assignments: DataFrame      # (doc, cluster)
    centroids: DataFrame        # (cluster, term, value)
    history: DataFrame          # (iteration, cluster, size, shift)
    losses: DataFrame           # (iteration, loss)
    iterations: int
    converged: bool
    round_assignments: DataFrame  # (iteration, doc, cluster)
    round_centroids: DataFrame    # (iteration, cluster, term, value)


def _checkpoint(df: DataFrame, name: str = "kmeans") -> DataFrame:
    """Per-round tables are written to the shared checkpoint folder."""
    return materialize(df, name)


def centroid_norms(centroids: DataFrame) -> dict[int, float]:
    """Per-cluster norms (k scalars)."""
    rows = centroids.groupBy("cluster").agg(
        F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm")).collect()
    return {r["cluster"]: r["norm"] for r in rows}


def doc_norms(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("doc").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))


def _doc_partitioned(triples: DataFrame, entity: str, feature: str, value: str) -> DataFrame:
    """(doc, term, value) rows hash-partitioned by document into a number of
    partitions sized from the row count, then cached for the rounds."""
    rows = (triples.select(F.col(entity).alias("doc"), F.col(feature).alias("term"),
                           F.col(value).cast("double").alias("value"))
            .where(F.col("value").isNotNull()))
    n = sized_partitions(triples.sparkSession, rows.count())
    laid = rows.repartition(n, "doc").persist(StorageLevel.MEMORY_AND_DISK)
    laid.count()  # plans know the partitions of a cached table once it is there
    return laid


#: Terms of a term block at most, by estimate: more than a tile's entries have, unless
#: documents are longer than that.
BLOCK_TERMS = 50_000_000
#: Entries of a tile, about: the fewer tiles, the fewer terms lie in several of them.
TILE_ROWS = 16_000_000
#: Entries of a packed tile, about, which a Python worker holds at once.
PACKED_ROWS = 8_000_000
#: A join on (tile, term) may use rows that are partitioned by tile alone.
_BY_TILE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


class Tiles:
    """Sparse vectors laid out once in (document block, term block) tiles, one partition
    each, and kept.  A round brings the small side to the tiles: a centroid row
    to the tiles that hold its term (``places``, kept by term), so that no more rows move
    than the tiles have terms, and (document, cluster) rows to all
    term blocks; and takes from them sums per document or per (cluster, term), combined
    in the tile.  The vectors themselves never move again.  A hot term is spread over
    the document blocks, a long document over the term blocks."""

    def __init__(self, triples: DataFrame, entity: str, feature: str, value: str,
                 laid: tuple[int, int] | None = None) -> None:
        """``laid``: the triples lie by tile, a column ``tile``, which is
        ``session.tile_of(entity, *laid)``; they are taken as they lie, to be packed, and
        not kept."""
        spark = triples.sparkSession
        rows = triples.select(F.col(entity).alias("doc"), F.col(feature).alias("term"),
                              F.col(value).cast("double").alias("value"),
                              *(["tile"] if laid else [])).where("value IS NOT NULL")
        if laid is not None:
            self.count, self.places = laid[1], None
            self.vectors = rows.select("tile", "doc", "term", "value")
            return
        size = rows.agg(F.count(F.lit(1)).alias("n"),
                        F.approx_count_distinct("term").alias("terms")).first()
        self.term_blocks = max(1, -(-size["terms"] // BLOCK_TERMS))
        self.doc_blocks = -(-sized_partitions(spark, size["n"], TILE_ROWS) // self.term_blocks)
        self.count = n = self.doc_blocks * self.term_blocks
        self._keys = F.array(*[F.lit(k).cast("long") for k in partition_keys(spark, n)])
        self.vectors = rows.select(
            self._tile(self._doc_block(), self._term_block()).alias("tile"), "doc", "term", "value"
        ).repartition(n, "tile").persist(StorageLevel.MEMORY_AND_DISK)
        self.vectors.count()  # plans know the partitions of a cached table once it is there
        self.places = self.vectors.select("tile", "term").distinct().repartition(
            self.count, "term").persist(StorageLevel.MEMORY_AND_DISK)

    def unpersist(self) -> None:
        if self.places is not None:
            self.places.unpersist()
            self.vectors.unpersist()

    def _doc_block(self) -> Column:
        return F.pmod(F.xxhash64("doc"), F.lit(self.doc_blocks)).cast("int")

    def _term_block(self) -> Column:
        return F.pmod(F.xxhash64("term"), F.lit(self.term_blocks)).cast("int")

    def _tile(self, doc_block: Column, term_block: Column) -> Column:
        return F.get(self._keys, doc_block * F.lit(self.term_blocks) + term_block)

    def with_terms(self, table: DataFrame) -> DataFrame:
        """The vectors joined with a table that has one row a term."""
        side = self.places.join(table.hint("shuffle_hash"), "term")
        return self.vectors.join(side.hint("shuffle_hash"), ["tile", "term"])

    def with_docs(self, table: DataFrame) -> DataFrame:
        """The vectors joined with a table that has one row a document."""
        each = table.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(self.term_blocks - 1))))
        side = each.withColumn("tile", self._tile(self._doc_block(), F.col("_block"))).drop("_block")
        return self.vectors.join(side.hint("shuffle_hash"), ["tile", "doc"])


    def by_term(self, centroids: DataFrame) -> DataFrame:
        """Centroid rows written in buckets by term, as ``places`` lie."""
        return materialize_blocks(centroids, self.count, "term", "kmeans")


def doc_dots(vectors: DataFrame | Tiles, norms: DataFrame, centroids: DataFrame, k: int
             ) -> DataFrame:
    """(doc, norm, dot1..dotk): every document's dot product with every
    centroid, from the term equi-join only (a centroid sharing no term gives
    0).  Of tiled vectors only k partial sums per document and tile are exchanged."""
    # one row per term with its value in each centroid, so the join gives one row per entry
    packed = centroids.groupBy("term").agg(*[
        F.coalesce(F.sum(F.when(F.col("cluster") == j, F.col("value"))), F.lit(0.0)).alias(f"c{j}")
        for j in range(1, k + 1)])
    met = (vectors.with_terms(packed) if isinstance(vectors, Tiles)
           else vectors.join(packed, "term"))
    dots = met.groupBy("doc").agg(*[
        F.sum(F.col("value") * F.col(f"c{j}")).alias(f"dot{j}") for j in range(1, k + 1)])
    return norms.join(dots, "doc", "left").select(
        "doc", "norm", *[F.coalesce(F.col(f"dot{j}"), F.lit(0.0)).alias(f"dot{j}")
                         for j in range(1, k + 1)])


def _distance_cols(cnorms: dict[int, float], k: int) -> list[Column]:
    cols = []
    for j in range(1, k + 1):
        cn = cnorms.get(j, 0.0) or 0.0
        d = F.when((F.col("norm") == 0) | F.lit(cn == 0.0), F.lit(INF)).otherwise(
            F.lit(1.0) - F.col(f"dot{j}") / (F.col("norm") * F.lit(cn if cn else 1.0)))
        cols.append(d.alias(f"d{j}"))
    return cols


def cosine_distances(vectors: DataFrame | Tiles, norms: DataFrame, centroids: DataFrame,
                     cnorms: dict[int, float], k: int) -> DataFrame:
    """JN8 + FN21: (doc, d_1..d_k) cosine distances of every document to
    every centroid.  A zero document or centroid gives +inf (the reference's
    Double.MAX_VALUE); a centroid sharing no term with a document gives 1."""
    dots = doc_dots(vectors, norms, centroids, k)
    return dots.select("doc", *_distance_cols(cnorms, k))


def _own_loss(cnorms: dict[int, float], k: int, own: str = "prev") -> Column:
    """Euclidean distance to the own centroid from the per-document dot
    products: ||c - v||^2 = ||c||^2 + ||v||^2 - 2 c.v (clamped at 0)."""
    own_dot, own_cn2 = None, None
    for j in range(1, k + 1):
        cn = float(cnorms.get(j, 0.0) or 0.0)
        own_dot = (F.when(F.col(own) == j, F.col(f"dot{j}")) if own_dot is None
                   else own_dot.when(F.col(own) == j, F.col(f"dot{j}")))
        own_cn2 = (F.when(F.col(own) == j, F.lit(cn * cn)) if own_cn2 is None
                   else own_cn2.when(F.col(own) == j, F.lit(cn * cn)))
    sq = own_cn2 + F.col("norm") * F.col("norm") - 2 * own_dot
    return F.sqrt(F.greatest(F.lit(0.0), sq))


def sparse_centroids(vectors: DataFrame | Tiles, assignments: DataFrame) -> DataFrame:
    """AGG9: per (cluster, term) mean over the member vectors holding the term.  Those of
    tiled vectors lie by term: sums and counts of each tile are what moves."""
    if not isinstance(vectors, Tiles):
        return vectors.join(assignments, "doc").groupBy("cluster", "term").agg(
            F.avg("value").alias("value"))
    parts = vectors.with_docs(assignments).groupBy("tile", "cluster", "term").agg(
        F.sum("value").alias("sum"), F.count(F.lit(1)).alias("n")).drop("tile")
    return parts.repartition(vectors.count, "term").groupBy("cluster", "term").agg(
        (F.sum("sum") / F.sum("n")).alias("value"))


def kmeans_cosine(triples: DataFrame | Packed, k: int = 5, max_iter: int = 10, tol: float = 1e-5,
                  seed: int = 0, entity: str = "doc_id", feature: str = "term_id",
                  value: str = "tfidf", init: DataFrame | None = None,
                  with_loss: bool = True,
                  on_round: Callable[[int, DataFrame], None] | None = None,
                  on_loss: Callable[[int, float], None] | None = None,
                  on_end: Callable[[int], None] | None = None,
                  laid: tuple[int, int] | None = None) -> KMeansCosineResult:
    """CL3 (+CL1, CL5-CL8, AGG9, AGG11): Lloyd's algorithm with cosine
    distance on sparse vectors given as (entity, feature, value) rows, or packed.

    ``entity``/``feature`` choose what is clustered (documents over terms by
    default; swap them to cluster terms over documents).  ``init`` may give
    starting centroids as (cluster, term, value) rows; otherwise CL1 random
    partition seeding with ``seed``.  ``on_round`` gets each round's number and its
    centroids (cluster, term, value) as soon as they are there, ``on_loss`` its loss
    when the next round has measured it, ``on_end`` the number of the round at which the
    rules (not ``max_iter``) stop the loop, before that round's loss.  ``laid``: see
    ``Tiles``; such vectors are packed.
    """
    vectors = _packed(triples, entity, feature, value, laid)
    end = (on_round or (lambda it, table: None), on_loss or (lambda it, loss: None),
           on_end or (lambda it: None))
    if vectors is not None:
        with vectors.planned():
            return _lloyd_cosine(_PackedRounds(vectors, k, seed, init), k, max_iter, tol, entity,
                                 feature, with_loss, *end)
    spark = triples.sparkSession
    with planned_with(spark, _BY_TILE):
        vectors = Tiles(triples, entity, feature, value)
        # with more partitions than tiles asked for, a join would shuffle the tiles too
        with planned_with(spark, {"spark.sql.shuffle.partitions": str(vectors.count)}):
            return _lloyd_cosine(_RowRounds(vectors, k, seed, init), k, max_iter, tol, entity,
                                 feature, with_loss, *end)


def _packed(triples: DataFrame | Packed, entity: str, feature: str, value: str,
            laid: tuple[int, int] | None) -> Packed | None:
    """The vectors packed, if they are or lie by tile and have integer ids."""
    if isinstance(triples, Packed):
        return triples
    if laid is None or not {dict(triples.dtypes)[c] for c in (entity, feature)} <= {"int", "bigint"}:
        return None
    return Packed(Tiles(triples, entity, feature, value, laid).vectors, laid)


class _RowRounds:
    """Lloyd's rounds by joins of tiled rows: the last round's assignments, and the
    centroids and their norms that enter the next one."""

    def __init__(self, vectors: Tiles, k: int, seed: int, init: DataFrame | None) -> None:
        self.spark, self.vectors, self.k = vectors.vectors.sparkSession, vectors, k
        self.norms = doc_norms(vectors.vectors).persist(StorageLevel.MEMORY_AND_DISK)
        if init is None:
            docs = self.norms.select("doc")
            groups = docs.select("doc", random_partition_groups(docs, "doc", k, seed).alias("cluster"))
            self.centroids = vectors.by_term(sparse_centroids(vectors, groups))
        else:
            self.centroids = vectors.by_term(init.select("cluster", "term", "value").repartition(
                vectors.count, "term"))
        self.cnorms = centroid_norms(self.centroids)
        self.assignments = None

    def step(self, with_loss: bool) -> tuple[dict, float, dict, dict]:
        """One round: cluster sizes, the loss of the round before, norms of the new
        centroids and their products with the old ones."""
        k, cents = self.k, self.centroids
        per_doc = doc_dots(self.vectors, self.norms, cents, k)
        with_loss = with_loss and self.assignments is not None
        if with_loss:
            # the previous round's loss comes from this round's dot products
            # with the previous round's centroids: no extra pass over vectors
            per_doc = per_doc.join(self.assignments.select("doc", F.col("cluster").alias("prev")),
                                   "doc", "left")
        loss_col = _own_loss(self.cnorms, k) if with_loss else F.lit(None).cast("double")
        # only what later steps read is written: cluster, and the loss of the last round
        scored = _checkpoint(per_doc.select("*", *_distance_cols(self.cnorms, k)).select(
            "doc", first_min_index([F.col(f"d{j}") for j in range(1, k + 1)]).alias("cluster"),
            loss_col.alias("loss")))
        self.assignments = scored.select("doc", "cluster")
        new = self.vectors.by_term(sparse_centroids(self.vectors, self.assignments))
        # norms, dots with the old centroids, sizes and losses in one job
        stats = (new.join(cents.select("cluster", "term", F.col("value").alias("old")),
                          ["cluster", "term"], "left")
                 .groupBy("cluster").agg(
                     F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"),
                     F.sum(F.col("value") * F.coalesce(F.col("old"), F.lit(0.0))).alias("dot")))
        members = scored.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"),
                                                F.sum("loss").alias("l"))
        both = stats.unionByName(members, allowMissingColumns=True).collect()
        self.centroids = new
        self.cnorms = {r["cluster"]: r["norm"] for r in both if r["n"] is None}
        return ({r["cluster"]: r["n"] for r in both if r["n"] is not None},
                sum(r["l"] or 0.0 for r in both), self.cnorms,
                {r["cluster"]: r["dot"] for r in both if r["n"] is None})

    def last_loss(self) -> float:
        """Loss of the last round: one more dot-product pass."""
        last = doc_dots(self.vectors, self.norms, self.centroids, self.k).join(
            self.assignments.select("doc", F.col("cluster").alias("prev")), "doc", "left")
        return last.agg(F.sum(_own_loss(self.cnorms, self.k)).alias("l")).first()["l"] or 0.0

    def final(self) -> DataFrame:
        return self.centroids

    def close(self) -> None:
        self.norms.unpersist()
        self.vectors.unpersist()


class _PackedRounds:
    """The same rounds over packed vectors."""

    def __init__(self, vectors: Packed, k: int, seed: int, init: DataFrame | None) -> None:
        self.spark, self.vectors, self.k = vectors.spark, vectors, k
        if init is None:
            docs = vectors.docs()
            groups = docs.select("tile", "doc", random_partition_groups(docs, "doc", k, seed)
                                 .alias("cluster"))
            means = vectors.means_of(groups, k)
        else:
            means = vectors.means(init, k)
        # the clusters of the rows begun with are no round's
        self.rows = vectors.written(means).where("kind = 1")
        self.cnorms = read_sums(self.rows, k)[2]
        self.assignments = None

    def step(self, with_loss: bool) -> tuple[dict, float, dict, dict]:
        self.rows = self.vectors.round(self.rows, self.cnorms, self.k, with_loss)
        self.assignments = self.vectors.clusters(self.rows)
        sizes, loss, self.cnorms, products = read_sums(self.rows, self.k)
        return sizes, loss, self.cnorms, products

    @property
    def centroids(self) -> DataFrame:
        return self.vectors.centroids(self.rows, self.k)

    def last_loss(self) -> float:
        return self.vectors.loss(self.rows, self.cnorms, self.k)

    def final(self) -> DataFrame:
        """Written in buckets by term, as those of ``_RowRounds``."""
        return self.vectors.by_term(self.rows, self.k)

    def close(self) -> None:
        """Nothing is kept in memory."""


def _lloyd_cosine(rounds_: _RowRounds | _PackedRounds, k: int, max_iter: int, tol: float, entity: str,
                  feature: str, with_loss: bool, on_round: Callable[[int, DataFrame], None],
                  on_loss: Callable[[int, float], None],
                  on_end: Callable[[int], None]) -> KMeansCosineResult:
    spark = rounds_.spark
    history, losses, rounds = [], [], []
    iterations, converged = 0, False
    for it in range(1, max_iter + 1):
        cnorms = rounds_.cnorms
        sizes, loss, new_norms, shift_dots = rounds_.step(with_loss)
        new = rounds_.centroids
        rounds.append((it, rounds_.assignments, new))
        if with_loss and it > 1:
            losses.append((it - 1, loss))
            on_loss(*losses[-1])
        on_round(it, new)
        iterations = it
        if len(sizes) != k:  # CL7
            for c in sorted(sizes):
                history.append((it, c, sizes[c], None))
            on_end(it)
            break
        shifts = {}
        for c, n_new in new_norms.items():
            n_old = cnorms.get(c, 0.0)
            shifts[c] = INF if (not n_old or not n_new) else \
                1.0 - (shift_dots.get(c) or 0.0) / (n_old * n_new)
        for c in sorted(sizes):
            history.append((it, c, sizes[c], shifts.get(c)))
        max_shift = max(list(shifts.values()) + [5e-324])
        if max_shift <= tol:  # CL6, inclusive for cosine
            converged = True
            on_end(it)
            break
    if with_loss and rounds:
        losses.append((iterations, rounds_.last_loss()))
        on_loss(*losses[-1])
    final = rounds_.final()
    rounds_.close()

    def of_rounds(tables) -> DataFrame:
        out = None
        for it, table in tables:
            table = table.select(F.lit(it).alias("iteration"), "*")
            out = table if out is None else out.unionByName(table)
        return out

    hist_schema = StructType([StructField("iteration", IntegerType()),
                              StructField("cluster", IntegerType()),
                              StructField("size", LongType()), StructField("shift", DoubleType())])
    loss_schema = StructType([StructField("iteration", IntegerType()),
                              StructField("loss", DoubleType())])
    return KMeansCosineResult(
        assignments=rounds_.assignments.select(F.col("doc").alias(entity), "cluster"),
        centroids=final.select("cluster", F.col("term").alias(feature), "value"),
        history=literal_rows(spark, history, hist_schema),
        losses=literal_rows(spark, losses, loss_schema),
        iterations=iterations, converged=converged,
        round_assignments=of_rounds(
            (i, a.select(F.col("doc").alias(entity), "cluster")) for i, a, _ in rounds),
        round_centroids=of_rounds(
            (i, c.select("cluster", F.col("term").alias(feature), "value"))
            for i, _, c in rounds))


def top_terms(centroids: DataFrame, n: int = 10, feature: str = "term_id",
              by: Sequence[str] = ("cluster",)) -> DataFrame:
    """AGG10/WIN4: the ``n`` largest entries of each centroid (``by``: iteration
    and cluster for the report of every round), value descending, ties in term order.  ``row_number() <= n`` lets Spark apply a
    per-task group limit before the shuffle."""
    from pyspark.sql import Window
    w = Window.partitionBy(*by).orderBy(F.desc("value"), F.asc(feature))
    return (centroids.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n).select(*by, "rank", feature, "value"))


def report_clusters(triples: DataFrame | Packed, path: str, k: int, max_iter: int, tol: float, seed: int = 0,
                    n: int = 10) -> None:
    """SNK8: cluster and report every round's top terms and loss under ``path`` as the
    rounds end.  A run on the same path goes on after the last reported round, from
    its centroids; a finished one is left alone."""
    report = RoundReport(triples.spark if isinstance(triples, Packed) else triples.sparkSession, path)
    done = report.last_round()
    if done >= max_iter or report.ended(done):
        return

    def on_round(it: int, centroids: DataFrame) -> None:
        report.write_round(done + it, centroids,
                           top_terms(centroids.withColumnRenamed("term", "term_id"), n))

    kmeans_cosine(triples, k=k, max_iter=max_iter - done, tol=tol, seed=seed,
                  init=report.centroids(done) if done else None, on_round=on_round,
                  on_loss=lambda it, loss: report.write_loss(done + it, loss),
                  on_end=lambda it: report.write_end(done + it))


def doc_centroid_distances(triples: DataFrame | Packed, centroids: DataFrame, k: int,
                           entity: str = "doc_id", feature: str = "term_id",
                           value: str = "tfidf", laid: tuple[int, int] | None = None) -> DataFrame:
    """JN8/FN21 as a table: (entity, cluster, distance) for every document and
    centroid (k rows per document).  The centroids are brought to the tiles of the
    vectors, as in a round; ``laid``: see ``Tiles``."""
    cents = centroids.select("cluster", F.col(feature).alias("term"), "value")
    vectors = _packed(triples, entity, feature, value, laid)
    if vectors is not None:
        with vectors.planned():
            dist = vectors.distances(cents, k)
    else:
        spark = triples.sparkSession
        with planned_with(spark, _BY_TILE):
            vectors = Tiles(triples, entity, feature, value)
            with planned_with(spark, {"spark.sql.shuffle.partitions": str(vectors.count)}):
                cnorms = centroid_norms(cents)
                dist = _checkpoint(cosine_distances(vectors, doc_norms(vectors.vectors), cents,
                                                    cnorms, k), "distances")
            vectors.unpersist()
    stack = ", ".join(f"{j}, d{j}" for j in range(1, k + 1))
    return dist.selectExpr(f"doc AS {entity}", f"stack({k}, {stack}) AS (cluster, distance)")


# ------------------------------------------------------------ k-means|| seeding

AT_ONCE = 32  # candidates that a pass over the vectors compares with


def _nearest_candidate(vectors: DataFrame | Packed, norms: DataFrame, cand_ids: list,
                       cand_norms: dict, first: int = 0) -> DataFrame:
    """(doc, dist, ci): cosine distance from every document to its nearest
    candidate and that candidate's index, counted from ``first`` (lowest index on
    ties).

    The candidates' vectors, a row per term with its value in each, are brought to
    the vectors, which lie by document: nothing but candidates is exchanged.  A
    candidate sharing no term with a document is at distance 1 (both non-zero); zero
    vectors are at +inf, so such a document falls to candidate 0.
    """
    found = {first + i: c for i, c in enumerate(cand_ids)}
    nz = {i: float(cand_norms[c]) for i, c in found.items() if cand_norms.get(c)}
    if not nz:
        return norms.select("doc", F.lit(INF).alias("dist"), F.lit(first).alias("ci"))
    if isinstance(vectors, Packed):
        return vectors.nearest({i: found[i] for i in nz}, nz, first)
    chosen = vectors.where(F.col("doc").isin(list(cand_ids)))
    packed = chosen.groupBy("term").agg(*[
        F.sum(F.when(F.col("doc") == found[i], F.col("value"))).alias(f"c{i}") for i in nz])
    # a few documents' terms, as the seeds' vectors are
    dots = vectors.join(F.broadcast(packed), "term").groupBy("doc").agg(*[
        F.sum(F.col("value") * F.col(f"c{i}")).alias(f"dot{i}") for i in nz])
    each = [F.struct((F.lit(1.0) - F.coalesce(F.col(f"dot{i}"), F.lit(0.0))
                      / (F.col("norm") * F.lit(n))).alias("dist"), F.lit(i).alias("ci"))
            for i, n in nz.items()]
    best = F.when(F.col("norm") == 0, F.struct(F.lit(INF).alias("dist"), F.lit(first).alias("ci"))) \
        .otherwise(F.array_min(F.array(*each)))
    return norms.join(dots.hint("shuffle_hash"), "doc", "left").select("doc", best.alias("b")).select(
        "doc", "b.dist", "b.ci")


def seed_parallel(triples: DataFrame | Packed, k: int, oversample: int | None = None, seed: int = 0,
                  entity: str = "doc_id", feature: str = "term_id",
                  value: str = "tfidf") -> DataFrame:
    """CL4: k-means|| seeding with cosine distance.

    A first candidate is drawn, ``psi`` is every document's distance to its
    nearest candidate, and for ceil(ln(potential)) rounds each document joins
    the candidates with probability ``l * psi / potential`` (a hash draw per
    (seed, round, doc), so recomputed tasks, and SQL, draw the same).  The nearest
    candidate is a running minimum: a round joins the vectors with its new
    candidates only, about ``l`` of them, and keeps the nearer of the old and the
    new one.  Candidates, numbered by round and document, are weighted by how many
    documents they are nearest to, and k distinct ones
    are picked by weighted sampling without replacement (keys u^(1/w)).

    Differences from the reference, which is random anyway: the potential is
    refreshed per round and psi updated per round (batch form); when fewer
    than k candidates exist, the remaining seeds are the next documents in
    draw order.  Returns (cluster, entity) seed documents.
    """
    l = oversample or 4 * k
    if isinstance(triples, Packed):
        spark, vectors, norms = triples.spark, triples, triples.norms()
    else:
        spark = triples.sparkSession
        vectors = _doc_partitioned(triples, entity, feature, value)
        norms = doc_norms(vectors)
    norms = norms.persist(StorageLevel.MEMORY_AND_DISK)
    draw0 = unit_draw(F.col("doc"), seed)
    first = norms.select("doc", "norm", draw0.alias("u")).orderBy("u", "doc").limit(1).collect()
    if not first:
        return literal_rows(spark, [], f"cluster int, {entity} long")
    cands = [first[0]["doc"]]
    finite = F.when(F.col("dist") == INF, F.lit(None)).otherwise(F.col("dist"))
    psi = _checkpoint(_nearest_candidate(vectors, norms, cands, {cands[0]: first[0]["norm"]}))
    potential = psi.agg(F.sum(finite).alias("p")).first()["p"] or 0.0
    rounds = max(0, math.ceil(math.log(potential))) if potential > 1 else 0
    for rnd in range(1, rounds + 1):
        if potential <= 0:
            break
        prob = F.lit(float(l)) * finite / F.lit(potential)
        picked = psi.where(unit_draw(F.col("doc"), seed * 1000 + rnd) <= prob) \
            .where(~F.col("doc").isin(cands)).join(norms, "doc").select("doc", "norm").collect()
        if not picked:
            continue
        new = {r["doc"]: r["norm"] for r in sorted(picked, key=lambda r: r["doc"])}
        for part in (list(new)[i:i + AT_ONCE] for i in range(0, len(new), AT_ONCE)):
            fresh = _nearest_candidate(vectors, norms, part, new, len(cands)).select(
                "doc", F.struct("dist", "ci").alias("fresh"))
            nearer = F.least(F.struct("dist", "ci"), F.col("fresh"))  # the old one on ties
            psi = _checkpoint(psi.join(fresh, "doc").select("doc", nearer.alias("b")).select(
                "doc", "b.dist", "b.ci"))
            cands += part
        potential = psi.agg(F.sum(finite).alias("p")).first()["p"] or 0.0
    weights = psi.groupBy("ci").agg(F.count(F.lit(1)).alias("w"))
    cmap = F.create_map(*[x for i, c in enumerate(cands) for x in (F.lit(i), F.lit(c))])
    key = F.pow(unit_draw(F.col("cand"), seed + 7), F.lit(1.0) / F.col("w"))
    chosen = [r["cand"] for r in weights.where(F.col("w") > 0)
              .select(F.element_at(cmap, F.col("ci")).alias("cand"), "w")
              .select("cand", key.alias("key")).orderBy(F.desc("key"), "cand").limit(k).collect()]
    if len(chosen) < k:
        extra = [r["doc"] for r in norms.select("doc", draw0.alias("u"))
                 .where(~F.col("doc").isin(chosen)).orderBy("u", "doc")
                 .limit(k - len(chosen)).collect()]
        chosen += extra
    vectors.unpersist()
    norms.unpersist()
    return literal_rows(spark, [(i + 1, int(c)) for i, c in enumerate(chosen)],
                        f"cluster int, {entity} long")


def seeds_to_centroids(triples: DataFrame | Packed, seeds: DataFrame, entity: str = "doc_id",
                       feature: str = "term_id", value: str = "tfidf") -> DataFrame:
    """Initial centroids (cluster, term, value) = the seed documents' vectors
    (k documents, broadcast into the join)."""
    if isinstance(triples, Packed):
        ids = [r[0] for r in seeds.select(entity).collect()]
        return triples.entries_of(ids).join(F.broadcast(seeds.withColumnRenamed(entity, "doc")),
                                            "doc").select("cluster", "term", "value")
    return (triples.join(F.broadcast(seeds), entity, "inner")
            .select("cluster", F.col(feature).alias("term"),
                    F.col(value).cast("double").alias("value")))
