"""Operator 8: quality by nearest-neighbour voting in a latent-semantic space.

*Features* of a whole text: words hashed to ``LEXICAL`` buckets, and word
shapes (letter case, digits, punctuation, runs collapsed; also "same word as
before" and "same line as before") hashed to ``SHAPES`` buckets.  Each of the
two blocks has square-root counts times inverse document frequency, the latter
counted over all documents, and unit length times its weight.

*Latent space* (driver, bounded): the ``RANK`` leading right singular vectors
of the labelled sample, at most ``LABELLED`` rows of each label, chosen by the
smallest hash of their doc_id, so that both labels are well represented.

*Score*: the labelled vectors go to every task (their size is bounded by the
parameters); each batch of documents is projected and multiplied with all of
them, exactly, in blocks; the ``NEIGHBOURS`` most similar vote with their label,
weighted by a power of the cosine similarity.  The score is label 1's share of the
votes, with each label's votes scaled to its share of all labelled rows.

Defined cases: NULL and empty texts have a zero vector and get the share of
label 1 among the labelled rows; so does every text when there is no label;
NULL labels teach nothing, and of several labels of a document the smallest
counts; a NULL doc_id is held out; repeated rows score alike; empty tables give
empty results; columns other than doc_id, text and the label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkiln.llm import kernels as K
from sparkiln.llm.tables import load_table

LEXICAL = 4096
SHAPES = 1024
FEATURES = LEXICAL + SHAPES
SHAPE_WEIGHT = 1.0
LEXICAL_WEIGHT = 0.5
LABELLED = 1500  # rows of each label at most
RANK = 64
NEIGHBOURS = 25
POWER = 4
THRESHOLD = 0.3
SCORES = "doc_id long, score double"

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[48:58] = ord("0")
_CLASS[65:91] = ord("A")
_CLASS[97:123] = ord("a")
_CLASS[128:] = ord("a")
_SAME_WORD, _SAME_LINE = FEATURES - 2, FEATURES - 1
NEWLINE = K.separators(b"\n")


def _buckets(h: np.ndarray, n: int) -> np.ndarray:
    return (h % np.uint64(n)).astype(np.int64)


def feature_counts(data: np.ndarray, offsets: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) triples in order of text and feature."""
    start, end, first = K.words(data, offsets)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    h = K.span_hash(K.prefix_hash(K.LOWER[data]), start, end)
    # shapes: the class of each byte, runs collapsed, hashed between word bounds
    kind = _CLASS[data]
    fresh = np.ones(len(kind), bool)
    fresh[1:] = kind[1:] != kind[:-1]
    fresh[start] = True
    place = np.concatenate([[0], np.cumsum(fresh)])
    shape = K.span_hash(K.prefix_hash(kind[fresh]), place[start], place[end])
    again = np.flatnonzero((h[1:] == h[:-1]) & (doc[1:] == doc[:-1])) + 1
    line_start, line_end, line_first = K.words(data, offsets, NEWLINE)
    line = K.span_hash(K.prefix_hash(data), line_start, line_end)
    line_doc = np.repeat(np.arange(len(line_first) - 1), np.diff(line_first))
    _, unique = np.unique(np.stack([line_doc.astype(np.uint64), line], axis=1), axis=0,
                          return_index=True)
    same = np.ones(len(line), bool)
    same[unique] = False
    repeated = line_doc[same]
    features = np.concatenate([
        doc * FEATURES + _buckets(h, LEXICAL),
        doc * FEATURES + LEXICAL + _buckets(shape, SHAPES - 2),
        doc[again] * FEATURES + _SAME_WORD, repeated * FEATURES + _SAME_LINE])
    key, count = np.unique(features, return_counts=True)
    return key // FEATURES, key % FEATURES, count


def weighted(doc: np.ndarray, feature: np.ndarray, count: np.ndarray, n: int, idf: np.ndarray
             ) -> np.ndarray:
    """Entry weights: square-root counts x idf, each block of unit length."""
    value = np.sqrt(count) * idf[feature]
    block = (feature >= LEXICAL).astype(np.int64)
    norm = np.sqrt(np.bincount(doc * 2 + block, value * value, 2 * n))
    size = np.where(block == 1, SHAPE_WEIGHT, LEXICAL_WEIGHT)
    return value * size / np.maximum(norm[doc * 2 + block], 1e-12)


def project(doc: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int, basis: np.ndarray
            ) -> np.ndarray:
    """Unit rows of (texts x features) times (features x rank); zero rows stay."""
    out = np.zeros((n, basis.shape[1]), np.float32)
    bounds = np.searchsorted(doc, np.arange(n + 1))
    has = np.flatnonzero(np.diff(bounds))
    if len(has):
        out[has] = np.add.reduceat(basis[feature] * value[:, None].astype(np.float32),
                                   bounds[:-1][has], axis=0)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many of all documents have each feature, and the number of
    documents.  Tasks send one row per feature, ``FEATURES`` at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(FEATURES + 1, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, data, offsets in K.text_chunks(batch.column("text")):
                _, feature, _ = feature_counts(data, offsets)
                total += np.bincount(feature, minlength=FEATURES + 1)
        total[FEATURES] = rows
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(total[has])],
                                         names=["feature", "n"])

    counts = docs.select("text").mapInArrow(run, "feature long, n long")
    out = np.zeros(FEATURES + 1, np.int64)
    for r in counts.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        out[r["feature"]] = r["n"]
    return out[:FEATURES], int(out[FEATURES])


class VotingModel:
    def __init__(self, idf: np.ndarray, basis: np.ndarray, vectors: np.ndarray,
                 labels: np.ndarray, base_rate: float) -> None:
        self.idf, self.basis, self.vectors, self.labels = idf, basis, vectors, labels
        self.base_rate = base_rate
        # a vote of a label that was sampled more thinly counts for more
        share = labels.mean() if len(labels) else 0.5
        self.scale = np.where(labels == 1, base_rate / max(share, 1e-9),
                              (1 - base_rate) / max(1 - share, 1e-9)).astype(np.float32)

    def embed(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, feature, count = feature_counts(data, offsets)
        n = len(offsets) - 1
        value = weighted(doc, feature, count, n, self.idf)
        return project(doc, feature, value, n, self.basis)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if not len(self.labels):
            return np.full(n, self.base_rate)
        vectors = self.embed(data, offsets)
        k = min(NEIGHBOURS, len(self.labels))
        out = np.empty(n)
        for lo in range(0, n, 256):
            cosine = vectors[lo:lo + 256] @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            cosine = np.take_along_axis(cosine, near, 1).astype(np.float64)
            vote = np.maximum(cosine, 0) ** POWER * self.scale[near]
            total = vote.sum(axis=1)
            ones = (vote * self.labels[near]).sum(axis=1)
            out[lo:lo + 256] = np.where(total > 0, ones / np.maximum(total, 1e-12),
                                        self.base_rate)
        return np.clip(out, 0, 1)


def latent_basis(doc: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int, rank: int
                 ) -> np.ndarray:
    """Leading right singular vectors of the sample, by the eigenvectors of its
    Gram matrix (rows x rows)."""
    x = np.zeros((n, FEATURES), np.float32)
    x[doc, feature] = value
    values, vectors = np.linalg.eigh((x @ x.T).astype(np.float64))
    top = [i for i in np.argsort(values)[::-1][:rank] if values[i] > 1e-6]
    return (x.T @ vectors[:, top]).astype(np.float32) / np.sqrt(values[top]).astype(np.float32)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(label, h, feature counts) of at most ``limit`` rows per label."""
    known = (labels.where(F.col(label).isin(0, 1)).groupBy("doc_id")
             .agg(F.min(label).cast("int").alias("label")))
    hashed = known.select("doc_id", "label", F.xxhash64("doc_id").alias("h"))
    # rows are chosen from the labels alone, so that the texts stay where they are
    zero, one = (hashed.where(F.col("label") == v).orderBy("h", "doc_id").limit(limit)
                 for v in (0, 1))
    picked = (docs.where("text IS NOT NULL").join(F.broadcast(zero.unionByName(one)), "doc_id")
              .dropDuplicates(["doc_id"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in K.text_chunks(batch.column("text")):
                doc, feature, count = feature_counts(data, offsets)
                first = np.searchsorted(doc, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(lo, hi - lo), batch.column("h").slice(lo, hi - lo),
                     K.long_lists(feature, first), K.long_lists(count, first)],
                    names=["label", "h", "features", "counts"])

    return picked.select("label", "h", "text").mapInArrow(
        run, "label int, h long, features array<long>, counts array<long>")


def train(docs: DataFrame, labels: DataFrame, label: str, stats: tuple[np.ndarray, int],
          limit: int = LABELLED) -> VotingModel:
    frequency, n_docs = stats
    idf = np.log((n_docs + 1) / (frequency + 1)) + 1
    known = labels.where(F.col(label).isin(0, 1)).agg(F.avg(F.col(label))).first()[0]
    rows = sorted(labelled_sample(docs, labels, label, limit).collect(),
                  key=lambda r: (r["label"], r["h"]))
    rows = [r for r in rows if r["features"]]
    base = 0.5 if known is None else float(known)
    if not rows:
        empty = np.empty(0, np.float32)
        return VotingModel(idf, np.empty((FEATURES, 0), np.float32), empty, empty, base)
    sizes = [len(r["features"]) for r in rows]
    doc = np.repeat(np.arange(len(rows)), sizes)
    feature = np.concatenate([r["features"] for r in rows]).astype(np.int64)
    count = np.concatenate([r["counts"] for r in rows]).astype(np.int64)
    value = weighted(doc, feature, count, len(rows), idf)
    basis = latent_basis(doc, feature, value, len(rows), RANK)
    vectors = project(doc, feature, value, len(rows), basis)
    return VotingModel(idf, basis, vectors,
                       np.array([r["label"] for r in rows], np.float32), base)


def score_documents(docs: DataFrame, model: VotingModel) -> DataFrame:
    """doc_id and score of every row; whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in K.text_chunks(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo),
                     pa.array(shared.value.score(data, offsets))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCORES)


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training: CRC-32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality",
             threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the rows not held out."""
    docs = docs.select("doc_id", "text")
    teach = ~held_out(F.col("doc_id"))
    model = train(docs.where(teach), labels.where(teach), label, document_frequencies(docs))
    return score_documents(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def op8_neighbour_quality(spark, sf_dir) -> DataFrame:
    return classify(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "labels"))


QUERIES = {"op8_neighbour_quality": op8_neighbour_quality}
ORACLE: dict[str, str] = {}
