"""Sparse vectors packed for numpy: the cosine rounds where vectors lie by tile (CL3-CL5,
AGG9, AGG11, JN8, FN21).

A round visits every entry of every vector twice (products with the centroids, means of the
members).  As rows, each visit is a hash join and an aggregate; here a tile's entries are a
few arrays, so a visit is an array lookup, and a round is three stages:

* a bucket of terms sends each tile the centroids' values for the terms that the tile holds;
* a tile takes the products, gives its documents their clusters, and sends each bucket
  the sums and counts of its terms;
* a bucket adds them up to the new centroids and compares these with the old ones.

What moves is a row of arrays for each tile and bucket.  A Python worker holds one tile
(about ``kmeans.PACKED_ROWS`` entries, 12 bytes each) or one bucket at a time; the vectors
are written once by tile and never move.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkiln.session import block_of, materialize, materialize_blocks, planned_with

# workers need not be able to import this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries of a chunk, a row of arrays.
CHUNK = 1_000_000
#: Kinds of rows of a round.
DOCS, MEANS, PART = 0, 1, 2

_CHUNKS = ("tile long, docs binary, starts binary, terms binary, buckets binary, at binary, "
           "values binary")
#: ids: documents or terms; values: clusters, means or sums; counts: of the terms by cluster;
#: sums: sizes and loss of documents, or squares, products with the old means and terms
_ROUND = "key long, kind int, ids binary, values binary, counts binary, sums array<double>"
_SIDE = ("tile", "key", "kind", "ids", "values")


# ------------------------------------------------------------------ in the workers

def _array(column, i: int, dtype) -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), dtype)


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(),
             "array<double>": pa.list_(pa.float64())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], types[t])
                     for i, (name, t) in enumerate(fields)})


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tile, doc, term, bucket, value) rows as chunks, a tile's entries by document."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= CHUNK:
            yield from _chunks(held)
            held, n = [], 0
    if n:
        yield from _chunks(held)


def _chunks(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    table, rows = pa.Table.from_batches(batches), []
    tile, doc, term, bucket, value = (table[c].to_numpy() for c in (
        "tile", "doc", "term", "bucket", "value"))
    for t in np.unique(tile):
        here = np.flatnonzero(tile == t)
        here = here[np.argsort(doc[here], kind="stable")]
        docs, starts = np.unique(doc[here], return_index=True)
        terms, first, at = np.unique(term[here], return_index=True, return_inverse=True)
        rows.append((int(t), docs.tobytes(), starts.astype(np.int64).tobytes(), terms.tobytes(),
                     bucket[here][first].tobytes(), at.astype(np.int32).tobytes(),
                     value[here].tobytes()))
    return _table(_CHUNKS, rows).to_batches()


def _read(chunks: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
    """docs, starts, terms, at, values of each chunk."""
    for i in range(chunks.num_rows):
        yield tuple(_array(chunks[c], i, dtype) for c, dtype in (
            ("docs", np.int64), ("starts", np.int64), ("terms", np.int64), ("at", np.int32),
            ("values", np.float64)))


def _documents(chunks: pa.Table) -> np.ndarray:
    return np.unique(np.concatenate([_array(chunks["docs"], i, np.int64)
                                     for i in range(chunks.num_rows)]))


def _norms(chunks: pa.Table, docs: np.ndarray) -> np.ndarray:
    squares = np.zeros(len(docs))
    for own, starts, _, _, values in _read(chunks):
        squares[np.searchsorted(docs, own)] += np.add.reduceat(values * values, starts)
    return np.sqrt(squares)


def _tile_docs(chunks: pa.Table) -> pa.Table:
    docs = _documents(chunks.select(["docs"]))
    return pa.table({"tile": np.full(len(docs), chunks["tile"][0].as_py()), "doc": docs})


def _tile_norms(chunks: pa.Table) -> pa.Table:
    docs = _documents(chunks)
    return pa.table({"doc": docs, "norm": _norms(chunks, docs)})


def _places(chunks: pa.Table) -> pa.Table:
    """A tile's terms, a row for each bucket."""
    n = range(chunks.num_rows)
    terms, first = np.unique(np.concatenate([_array(chunks["terms"], i, np.int64) for i in n]),
                             return_index=True)
    bucket = np.concatenate([_array(chunks["buckets"], i, np.int64) for i in n])[first]
    order = np.argsort(bucket, kind="stable")
    keys, starts = np.unique(bucket[order], return_index=True)
    tile = chunks["tile"][0].as_py()
    return _table("key long, tile long, ids binary", [
        (int(key), tile, terms[at].tobytes())
        for key, at in zip(keys, np.split(order, starts[1:]))])


def _packed_rows(k: int):
    """(key, cluster, term, value) rows of a bucket as means."""
    def run(rows: pa.Table) -> pa.Table:
        cluster, term, value = (rows[c].to_numpy() for c in ("cluster", "term", "value"))
        terms, at = np.unique(term, return_inverse=True)
        means, counts = np.zeros((k, len(terms))), np.zeros((k, len(terms)), np.int64)
        np.add.at(means, (cluster - 1, at), value)
        np.add.at(counts, (cluster - 1, at), 1)
        return _table(_ROUND, [_means_row(rows["key"][0].as_py(), terms, means, counts,
                                          np.zeros(k))])
    return run


def _means_row(key: int, terms: np.ndarray, means: np.ndarray, counts: np.ndarray,
               products: np.ndarray) -> tuple:
    return (key, MEANS, terms.tobytes(), means.tobytes(), counts.astype(np.int64).tobytes(),
            [*(means * means).sum(1), *products, *(counts > 0).sum(1)])


def _packed_docs(rows: pa.Table) -> pa.Table:
    """(tile, doc, cluster) rows of a tile as arrays."""
    doc, cluster = rows["doc"].to_numpy(), rows["cluster"].to_numpy()
    order = np.argsort(doc, kind="stable")
    return _table(_ROUND, [(rows["tile"][0].as_py(), DOCS, doc[order].tobytes(),
                            cluster[order].astype(np.int32).tobytes(), None, None)])


def _messages(k: int):
    """What a bucket sends to the tiles: its means for the terms of each."""
    def run(key, places: pa.Table, means: pa.Table) -> pa.Table:
        known, values = np.empty(0, np.int64), np.empty((k, 0))
        if means.num_rows:
            known = _array(means["ids"], 0, np.int64)
            values = _array(means["values"], 0, np.float64).reshape(k, -1)
        rows = []
        for i in range(places.num_rows):
            terms = _array(places["ids"], i, np.int64)
            at = np.searchsorted(known, terms)
            hit = np.flatnonzero(at < len(known))
            hit = hit[known[at[hit]] == terms[hit]]
            sent = np.zeros((k, len(terms)))
            sent[:, hit] = values[:, at[hit]]
            rows.append((places["tile"][i].as_py(), key[0].as_py(), MEANS, terms.tobytes(),
                         sent.tobytes()))
        return _table("tile long, key long, kind int, ids binary, values binary", rows)
    return run


class _Side:
    """What a tile was sent: the terms by bucket with the means, and its documents' clusters."""

    def __init__(self, side: pa.Table, k: int) -> None:
        kinds, ids = side["kind"].to_numpy(), side["ids"]
        sent = [int(i) for i in np.flatnonzero(kinds == MEANS)]
        parts = [_array(ids, i, np.int64) for i in sent]
        self.keys = [side["key"][i].as_py() for i in sent]
        self.ends = np.cumsum([0, *map(len, parts)])
        self.terms = np.concatenate(parts)
        self.order = np.argsort(self.terms, kind="stable")
        self.sorted = self.terms[self.order]
        self.means = None
        if side["values"][sent[0]].is_valid:
            self.means = np.concatenate([_array(side["values"], i, np.float64).reshape(k, -1)
                                         for i in sent], axis=1)
        self.docs, self.clusters = np.empty(0, np.int64), np.empty(0, np.int32)
        for i in map(int, np.flatnonzero(kinds == DOCS)):
            self.docs = _array(ids, i, np.int64)
            self.clusters = _array(side["values"], i, np.int32)

    def at(self, terms: np.ndarray) -> np.ndarray:
        return self.order[np.searchsorted(self.sorted, terms)]

    def cluster_of(self, docs: np.ndarray) -> np.ndarray:
        """0 where it has none."""
        out = np.zeros(len(docs), np.int64)
        at = np.searchsorted(self.docs, docs)
        hit = np.flatnonzero(at < len(self.docs))
        hit = hit[self.docs[at[hit]] == docs[hit]]
        out[hit] = self.clusters[at[hit]]
        return out


def _dots(chunks: pa.Table, docs: np.ndarray, side: _Side, k: int) -> np.ndarray:
    dots = np.zeros((k, len(docs)))
    for own, starts, terms, at, values in _read(chunks):
        here, means = np.searchsorted(docs, own), side.means[:, side.at(terms)]
        for j in range(k):
            dots[j, here] += np.add.reduceat(values * means[j][at], starts)
    return dots


def _cosine(dots: np.ndarray, norms: np.ndarray, cnorms: np.ndarray) -> np.ndarray:
    """Distances; those of a zero document or centroid are infinite."""
    with np.errstate(divide="ignore", invalid="ignore"):
        dists = 1.0 - dots / (norms * cnorms[:, None])
    dists[:, norms == 0] = np.inf
    dists[cnorms == 0] = np.inf
    return dists


def _loss(side: _Side, docs: np.ndarray, norms: np.ndarray, dots: np.ndarray, cnorms: np.ndarray
          ) -> float:
    """Sum of Euclidean distances to the own centroid, ||c||^2 + ||v||^2 - 2 c.v."""
    own = side.cluster_of(docs)
    at = np.flatnonzero(own)
    own = own[at] - 1
    squares = cnorms[own] * cnorms[own] + norms[at] * norms[at] - 2 * dots[own, at]
    return float(np.sqrt(np.maximum(0.0, squares)).sum())


def _step(k: int, cnorms: list[float] | None, with_loss: bool, only_loss: bool = False):
    """A tile's part of a round.  Without ``cnorms`` the documents keep the clusters sent."""
    def run(key, chunks: pa.Table, sent: pa.Table) -> pa.Table:
        side, docs, loss = _Side(sent, k), _documents(chunks), None
        if cnorms is None:
            cluster = side.cluster_of(docs)
        else:
            lengths = np.array(cnorms)
            norms, dots = _norms(chunks, docs), _dots(chunks, docs, side, k)
            if with_loss and len(side.docs):
                loss = _loss(side, docs, norms, dots, lengths)
            dists = _cosine(dots, norms, lengths)
            # the lowest index on ties; a NaN is larger than all
            cluster = np.where(np.isnan(dists), np.inf, dists).argmin(0) + 1
        sizes = np.bincount(cluster, minlength=k + 1)[1:]
        rows = [(key[0].as_py(), DOCS, docs.tobytes(), cluster.astype(np.int32).tobytes(), None,
                 [*map(float, sizes), loss])]
        if not only_loss:
            rows += _parts(chunks, docs, cluster, side, k)
        return _table(_ROUND, rows)
    return run


def _parts(chunks: pa.Table, docs: np.ndarray, cluster: np.ndarray, side: _Side, k: int
           ) -> list[tuple]:
    """Sums and counts of a tile's terms by cluster, a row for each bucket."""
    sums, counts = np.zeros((k, len(side.terms))), np.zeros((k, len(side.terms)), np.int64)
    for own, starts, terms, at, values in _read(chunks):
        mine = np.repeat(cluster[np.searchsorted(docs, own)], np.diff(starts, append=len(values)))
        to, m = side.at(terms), len(terms)
        flat = mine * m + at  # the first m are of documents without a cluster
        sums[:, to] += np.bincount(flat, values, (k + 1) * m).reshape(k + 1, m)[1:]
        counts[:, to] += np.bincount(flat, minlength=(k + 1) * m).reshape(k + 1, m)[1:]
    rows = []
    for key, lo, hi in zip(side.keys, side.ends, side.ends[1:]):
        held = lo + np.flatnonzero(counts[:, lo:hi].any(0))
        if len(held):
            rows.append((key, PART, side.terms[held].tobytes(), sums[:, held].tobytes(),
                         counts[:, held].tobytes(), None))
    return rows


def _reduce(k: int):
    """A bucket's new means from the tiles' sums, compared with the old ones; the rows of
    documents go on as they are."""
    def run(rows: pa.Table) -> pa.Table:
        kinds = rows["kind"].to_numpy()
        kept = rows.filter(pa.array(kinds == DOCS))
        parts = [int(i) for i in np.flatnonzero(kinds == PART)]
        if not parts:
            return kept
        ids = [_array(rows["ids"], i, np.int64) for i in parts]
        terms = np.unique(np.concatenate(ids))
        sums, counts = np.zeros((k, len(terms))), np.zeros((k, len(terms)), np.int64)
        for i, own in zip(parts, ids):
            at = np.searchsorted(terms, own)
            sums[:, at] += _array(rows["values"], i, np.float64).reshape(k, -1)
            counts[:, at] += _array(rows["counts"], i, np.int64).reshape(k, -1)
        means = np.where(counts > 0, sums / np.maximum(counts, 1), 0.0)
        products = np.zeros(k)
        for i in map(int, np.flatnonzero(kinds == MEANS)):
            both, new, old = np.intersect1d(terms, _array(rows["ids"], i, np.int64),
                                            assume_unique=True, return_indices=True)
            before = _array(rows["values"], i, np.float64).reshape(k, -1)
            products += (means[:, new] * before[:, old]).sum(1)
        new = _table(_ROUND, [_means_row(rows["key"][0].as_py(), terms, means, counts, products)])
        return pa.concat_tables([kept.cast(new.schema), new])
    return run


def _distances(k: int, cnorms: list[float]):
    def run(key, chunks: pa.Table, sent: pa.Table) -> pa.Table:
        docs = _documents(chunks)
        dots = _dots(chunks, docs, _Side(sent, k), k)
        dists = _cosine(dots, _norms(chunks, docs), np.array(cnorms))
        return pa.table({"doc": docs, **{f"d{j + 1}": dists[j] for j in range(k)}})
    return run


def _doc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield pa.record_batch({"doc": _array(batch["ids"], i, np.int64),
                                   "cluster": _array(batch["values"], i, np.int32)})


def _term_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                terms = _array(batch["ids"], i, np.int64)
                cluster, at = np.nonzero(_array(batch["counts"], i, np.int64).reshape(k, -1))
                means = _array(batch["values"], i, np.float64).reshape(k, -1)
                yield pa.record_batch({"cluster": (cluster + 1).astype(np.int32),
                                       "term": terms[at], "value": means[cluster, at]})
    return run


def _entries_of(ids: list[int]):
    """The entries of some documents as rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, starts, terms, at, values in _read(pa.Table.from_batches([batch])):
                ends = np.append(starts[1:], len(values))
                for i in np.flatnonzero(np.isin(own, ids)):
                    part = slice(starts[i], ends[i])
                    yield pa.record_batch({"doc": np.full(ends[i] - starts[i], own[i]),
                                           "term": terms[at[part]], "value": values[part]})
    return run


def _nearest(terms: np.ndarray, vectors: np.ndarray, lengths: np.ndarray, numbers: np.ndarray,
             first: int):
    """Distance and number of a tile's documents' nearest candidate; ``vectors`` has a row
    for each candidate over the sorted ``terms``."""
    def run(chunks: pa.Table) -> pa.Table:
        docs = _documents(chunks)
        norms, dots = _norms(chunks, docs), np.zeros((len(numbers), len(docs)))
        for own, starts, held, at, values in _read(chunks):
            to = np.searchsorted(terms, held)
            hit = to < len(terms)
            hit[hit] = terms[to[hit]] == held[hit]
            entries = np.flatnonzero(hit[at])
            doc = np.repeat(np.searchsorted(docs, own), np.diff(starts, append=len(values)))[entries]
            to, met = to[at[entries]], values[entries]
            for j in range(len(numbers)):
                dots[j] += np.bincount(doc, met * vectors[j][to], len(docs))
        dists = _cosine(dots, norms, lengths)
        best = np.where(np.isnan(dists), np.inf, dists).argmin(0)
        return pa.table({"doc": docs, "dist": dists[best, np.arange(len(docs))],
                         "ci": np.where(norms == 0, first, numbers[best]).astype(np.int32)})
    return run


# ------------------------------------------------------------------ on the driver

class Packed:
    """Sparse vectors written as arrays by tile, from (tile, doc, term, value) rows of
    integer ids without nulls that lie by block of documents; ``laid`` is the number of
    blocks and tiles, and ``tile`` is ``session.tile_of(doc, *laid)``."""

    def __init__(self, rows: DataFrame, laid: tuple[int, int]) -> None:
        self.spark, self.laid, self.count = rows.sparkSession, laid, laid[1]
        self.types = dict(rows.dtypes)
        rows = rows.where("doc IS NOT NULL AND term IS NOT NULL AND value IS NOT NULL").select(
            "tile", F.col("doc").cast("long").alias("doc"), F.col("term").cast("long").alias("term"),
            block_of(self.spark, "term", self.count).alias("bucket"), "value")
        self.chunks = materialize_blocks(rows.mapInArrow(_pack, _CHUNKS), self.count, "tile",
                                         "vectors")
        places = self.chunks.select("tile", "terms", "buckets").groupBy("tile").applyInArrow(
            _places, "key long, tile long, ids binary")
        self.places = materialize_blocks(places.repartition(self.count, "key"), self.count, "key",
                                         "places")

    def planned(self):
        """Settings under which the tiles stay where they are."""
        return planned_with(self.spark, {
            "spark.sql.requireAllClusterKeysForCoPartition": "false",
            "spark.sql.shuffle.partitions": str(self.count)})

    def unpersist(self) -> None:
        """Nothing is kept in memory."""

    def _typed(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).cast(self.types[c]).alias(c) if c in ("doc", "term")
                           else F.col(c) for c in df.columns])

    def docs(self) -> DataFrame:
        """(tile, doc), a row for each document."""
        return self._typed(self.chunks.select("tile", "docs").groupBy("tile").applyInArrow(
            _tile_docs, "tile long, doc long"))

    def norms(self) -> DataFrame:
        return self._typed(self.chunks.groupBy("tile").applyInArrow(
            _tile_norms, "doc long, norm double"))

    def entries_of(self, ids: list[int]) -> DataFrame:
        """(doc, term, value) rows of some documents."""
        return self._typed(self.chunks.mapInArrow(_entries_of([int(i) for i in ids]),
                                                  "doc long, term long, value double"))

    def means(self, centroids: DataFrame, k: int) -> DataFrame:
        """(cluster, term, value) rows by bucket of terms."""
        term = F.col("term").cast(self.types["term"])
        rows = centroids.select("cluster", term.alias("term"),
                                F.col("value").cast("double").alias("value"))
        rows = rows.where(F.col("cluster").between(1, k) & F.col("term").isNotNull()).select(
            block_of(self.spark, "term", self.count).alias("key"), "cluster",
            F.col("term").cast("long").alias("term"), "value")
        return rows.groupBy("key").applyInArrow(_packed_rows(k), _ROUND)

    def means_of(self, groups: DataFrame, k: int) -> DataFrame:
        """The means of (tile, doc, cluster) rows."""
        docs = groups.select("tile", F.col("doc").cast("long").alias("doc"), "cluster").groupBy(
            "tile").applyInArrow(_packed_docs, _ROUND)
        side = self.places.select("tile", "key", F.lit(MEANS).alias("kind"), "ids",
                                  F.lit(None).cast("binary").alias("values"))
        return self._reduced(self._at_tiles(side, docs, _step(k, None, False)), k)

    def _messages(self, means: DataFrame, k: int) -> DataFrame:
        return self.places.groupBy("key").cogroup(means.where(F.col("kind") == MEANS).groupBy(
            "key")).applyInArrow(
            _messages(k), "tile long, key long, kind int, ids binary, values binary")

    def _at_tiles(self, messages: DataFrame, docs: DataFrame | None, run, schema: str = _ROUND
                  ) -> DataFrame:
        side = messages.select(*_SIDE)
        if docs is not None:
            side = side.unionByName(docs.where(F.col("kind") == DOCS).select(
                F.col("key").alias("tile"), *_SIDE[1:]))
        return self.chunks.groupBy("tile").cogroup(side.groupBy("tile")).applyInArrow(run, schema)

    def _reduced(self, parts: DataFrame, k: int) -> DataFrame:
        return parts.groupBy("key").applyInArrow(_reduce(k), _ROUND)

    def written(self, rows: DataFrame) -> DataFrame:
        return materialize_blocks(rows, self.count, "key", "kmeans")

    def round(self, before: DataFrame, cnorms: dict[int, float], k: int, with_loss: bool) -> DataFrame:
        """The next round's rows from those of the round before."""
        step = _step(k, _lengths(cnorms, k), with_loss)
        parts = self._at_tiles(self._messages(before, k), before, step)
        return self.written(self._reduced(parts.unionByName(before.where(F.col("kind") == MEANS)), k))

    def loss(self, last: DataFrame, cnorms: dict[int, float], k: int) -> float:
        """The loss of the round whose rows these are."""
        rows = self._at_tiles(self._messages(last, k), last,
                              _step(k, _lengths(cnorms, k), True, True)).select("sums").collect()
        return sum(r["sums"][k] or 0.0 for r in rows)

    def distances(self, centroids: DataFrame, k: int) -> DataFrame:
        """(doc, d1..dk), written."""
        means = self.written(self.means(centroids, k))
        cnorms = _lengths(read_sums(means, k)[2], k)
        schema = "doc long, " + ", ".join(f"d{j} double" for j in range(1, k + 1))
        return materialize(self._typed(self._at_tiles(
            self._messages(means, k), None, _distances(k, cnorms), schema)), "distances")

    def clusters(self, rows: DataFrame) -> DataFrame:
        """(doc, cluster) of a round's rows."""
        return self._typed(rows.where(F.col("kind") == DOCS).select("ids", "values").mapInArrow(
            _doc_rows, "doc long, cluster int"))

    def centroids(self, rows: DataFrame, k: int) -> DataFrame:
        """(cluster, term, value) of a round's rows."""
        return self._typed(rows.where(F.col("kind") == MEANS).select(
            "ids", "values", "counts").mapInArrow(
            _term_rows(k), "cluster int, term long, value double"))

    def by_term(self, rows: DataFrame, k: int) -> DataFrame:
        """``centroids`` written in buckets by term, as the rows lie."""
        return materialize_blocks(self.centroids(rows, k), self.count, "term", "kmeans")

    def nearest(self, candidates: dict[int, int], lengths: dict[int, float], first: int) -> DataFrame:
        """(doc, dist, ci): the nearest of some candidates (number: document), which are
        brought to the tiles; a zero document has the first."""
        entries = self.entries_of(list(candidates.values())).toArrow()
        terms, at = np.unique(entries["term"].to_numpy().astype(np.int64), return_inverse=True)
        doc, value = entries["doc"].to_numpy(), entries["value"].to_numpy()
        vectors = np.zeros((len(candidates), len(terms)))
        for row, c in zip(vectors, candidates.values()):
            np.add.at(row, at[doc == c], value[doc == c])
        run = _nearest(terms, vectors, np.array([lengths[i] for i in candidates]),
                       np.array(list(candidates)), first)
        return self._typed(self.chunks.groupBy("tile").applyInArrow(
            run, "doc long, dist double, ci int"))


def _lengths(cnorms: dict[int, float], k: int) -> list[float]:
    return [float(cnorms.get(j) or 0.0) for j in range(1, k + 1)]


def read_sums(rows: DataFrame, k: int) -> tuple[dict, float, dict, dict]:
    """Of a round's rows: the sizes of the clusters that have documents, the loss of the
    round before, and norms and products with the old centroid of those that have terms."""
    sizes, loss = [0] * k, 0.0
    squares, products, terms = [0.0] * k, [0.0] * k, [0] * k
    for kind, sums in rows.select("kind", "sums").collect():
        for j in range(k):
            if kind == DOCS:
                sizes[j] += int(sums[j])
            else:
                squares[j] += sums[j]
                products[j] += sums[k + j]
                terms[j] += int(sums[2 * k + j])
        loss += (sums[k] or 0.0) if kind == DOCS else 0.0
    return ({j + 1: n for j, n in enumerate(sizes) if n}, loss,
            {j + 1: squares[j] ** 0.5 for j in range(k) if terms[j]},
            {j + 1: products[j] for j in range(k) if terms[j]})
