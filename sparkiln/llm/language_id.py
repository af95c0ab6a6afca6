"""Operator 7: language identification with string kernels.

The kernel of two texts is the normalised blended-spectrum presence kernel:
the number of distinct character n-grams (n = 1, 2, 3) that both have, over
the geometric mean of their own numbers.  Characters are lower-cased letters,
with each run of anything else as one blank.

*Fit* (driver, bounded): at most ``TRAINING`` labelled rows per language, and about
``TRAINING_TOTAL`` in all, are chosen by the smallest hash of their text; the first
``LANDMARKS`` of a language are landmarks.  Landmarks give the
Nystroem map K(x, L) K(L, L)^(-1/2); one-versus-rest kernel ridge regression is
solved on the mapped training rows.

*Score*: presence rows of a batch of texts times the landmarks' presence matrix,
times the regression weights.  The product is associative and the weights have a
column per language only, so (presence of landmarks x weights) is multiplied
first, once, and each batch is one sparse-dense matrix product with that matrix.
The scores pass a softmax; ``score`` is the share of the winning language.

*Known or not* (``keep_known``): softmax shares compare the learned languages with
each other only and are never under one over their number, so they cannot tell
that a text is in none of them.  That is decided by the share of the text's n-grams
that the landmarks of the winning language have, measured against the same share
of that language's own landmarks (each against the others; the median, which is
low for large alphabets and short texts, and counts as ``LEAST_TYPICAL`` at least).
It does not depend on the number of languages.

Defined cases: a NULL text or one without a letter is ``und`` with score 0;
with no labelled row at all every text is ``und``; ties go to the first
language in alphabetical order; repeated rows are scored alike; other columns
than doc_id, text and (for training rows) lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkiln.llm.tables import load_table

LANDMARKS = 60  # per language
TRAINING = 300  # per language, landmarks among them
TRAINING_TOTAL = 6000  # over all languages
LANGUAGES = 500  # labels learned at most, the most frequent first
RIDGE = 1e-2
SHARPNESS = 4.0
MAX_N = 3
LEAST_TYPICAL = 0.2  # share of n-grams; holds too for a language with one landmark
UNKNOWN = "und"
PREDICTIONS = "doc_id long, lang_pred string, score double"
_CODE_BITS = np.int64(21)  # a code point fits


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str | None) -> np.ndarray:
    """Sorted distinct n-gram codes of a whole text; empty without a letter."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[raw]
    if not letter.any():
        return np.empty(0, np.int64)
    blank = np.uint32(0x20)
    chars = np.where(letter, raw, blank)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of other characters
    chars = np.concatenate([[blank], chars[keep], [blank]]).astype(np.int64)
    if chars[1] == blank:
        chars = chars[1:]
    if chars[-2] == blank:
        chars = chars[:-1]
    grams, out = chars, [np.unique(chars)]
    for n in range(1, MAX_N):
        grams = (grams[:-1] << _CODE_BITS) | chars[n:]
        out.append(np.unique(grams))  # codes of different n do not meet: no character is 0
    return np.concatenate(out)


def presence(grams: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Places in the sorted vocabulary of the n-grams that it has."""
    at = np.searchsorted(vocabulary, grams)
    at[at == len(vocabulary)] = 0
    return at[vocabulary[at] == grams]


class KernelModel:
    """Nystroem kernel ridge classifier, folded to one weight per n-gram and
    language; ``has`` tells which n-grams a language's landmarks have, and
    ``typical`` what share of its n-grams one of them finds in the others."""

    def __init__(self, languages: list[str], vocabulary: np.ndarray, weights: np.ndarray,
                 bias: np.ndarray, has: np.ndarray, typical: np.ndarray) -> None:
        self.languages, self.vocabulary = languages, vocabulary
        self.weights, self.bias = weights, bias
        self.has, self.typical = has, typical

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        """Softmax of the regression scores for a batch of n-gram sets."""
        own = [presence(s, self.vocabulary) for s in sets]
        sizes = np.array([len(x) for x in own])
        total = np.zeros((len(sets), len(self.languages)))
        has = np.flatnonzero(sizes)
        if len(has):
            first = np.concatenate([[0], np.cumsum(sizes[has])[:-1]])
            flat = np.concatenate([own[i] for i in has])
            total[has] = np.add.reduceat(self.weights[flat], first, axis=0)
        norm = np.sqrt(np.maximum([len(s) for s in sets], 1))
        raw = SHARPNESS * (total / norm[:, None] + self.bias)
        raw -= raw.max(axis=1, keepdims=True)
        share = np.exp(raw)
        return share / share.sum(axis=1, keepdims=True)

    def known(self, sets: list[np.ndarray]) -> np.ndarray:
        """How well the landmarks of each set's winning language cover it, as
        a part of what is typical of that language; 0 without an n-gram."""
        best = self.scores(sets).argmax(axis=1)
        out = np.zeros(len(sets))
        for row, (s, lang) in enumerate(zip(sets, best)):
            if len(s):
                found = self.has[presence(s, self.vocabulary), lang].sum()
                out[row] = found / len(s) / self.typical[lang]
        return out


def fit(sets: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS,
        ridge: float = RIDGE) -> KernelModel:
    """Fit on n-gram sets; the first ``landmarks`` of each label are the
    landmarks."""
    languages = sorted(set(labels))
    chosen = [i for lang in languages
              for i in [j for j, x in enumerate(labels) if x == lang][:landmarks]]
    vocabulary = np.unique(np.concatenate([sets[i] for i in chosen]))
    marks = np.zeros((len(vocabulary), len(chosen)), np.float32)
    for col, i in enumerate(chosen):
        marks[presence(sets[i], vocabulary), col] = 1 / np.sqrt(len(sets[i]))
    kernel = np.empty((len(sets), len(chosen)))
    for row, s in enumerate(sets):  # K(training, landmarks)
        kernel[row] = marks[presence(s, vocabulary)].sum(axis=0) / np.sqrt(max(len(s), 1))
    values, vectors = np.linalg.eigh(kernel[chosen])
    root = np.where(values > 1e-8, 1 / np.sqrt(np.maximum(values, 1e-8)), 0)
    mapping = (vectors * root) @ vectors.T  # K(L, L) to the power -1/2
    z = kernel @ mapping
    targets = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # rows of a label weigh alike in sum, however many there are
    share = np.array([1 / labels.count(x) for x in labels])
    share *= len(labels) / share.sum()
    mean, bias = np.average(z, axis=0, weights=share), np.average(targets, axis=0, weights=share)
    zc, tc = z - mean, targets - bias
    gram = (zc * share[:, None]).T @ zc + ridge * len(labels) * np.eye(len(chosen))
    beta = np.linalg.solve(gram, (zc * share[:, None]).T @ tc)
    has = np.zeros((len(vocabulary), len(languages)), bool)
    typical = np.full(len(languages), LEAST_TYPICAL)
    for col, lang in enumerate(languages):
        own = [presence(sets[i], vocabulary) for i in chosen if labels[i] == lang]
        holders = np.bincount(np.concatenate(own), minlength=len(vocabulary))
        has[:, col] = holders > 0
        typical[col] = max(LEAST_TYPICAL, np.median([(holders[x] > 1).mean() for x in own]))
    return KernelModel(languages, vocabulary, marks @ (mapping @ beta), bias - mean @ beta,
                       has, typical)


def training_rows(labelled: DataFrame, training: int = TRAINING) -> DataFrame:
    """At most ``training`` distinct texts per language, and ``LANGUAGES``
    languages, as (lang, h, grams); the texts with the smallest hashes h.  The
    n-gram sets are made in the tasks; only those reach the driver."""
    common = [r["lang"] for r in labelled.groupBy("lang").count().orderBy(
        F.desc("count"), "lang").limit(LANGUAGES).collect()]
    training = max(2, min(training, TRAINING_TOTAL // max(len(common), 1)))
    hashed = labelled.where(F.col("lang").isin(common)).withColumn("h", F.xxhash64("text"))
    low = (hashed.groupBy("lang", "h").agg(F.min("doc_id").alias("doc_id"))
           .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
           .where(F.col("n") <= training).select("lang", "h", "doc_id"))
    rows = hashed.join(F.broadcast(low), ["lang", "h", "doc_id"]).dropDuplicates(["lang", "h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [ngrams(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("h"), pa.array(sets, pa.list_(pa.int64()))],
                names=["lang", "h", "grams"])

    return rows.select("lang", "h", "text").mapInArrow(
        run, "lang string, h long, grams array<long>")


def train(labelled: DataFrame, training: int = TRAINING) -> KernelModel | None:
    """Model from (doc_id, text, lang) rows; None when no row can teach."""
    rows = training_rows(labelled.where("text IS NOT NULL AND lang IS NOT NULL"), training)
    got = sorted(((r["lang"], r["h"], r["grams"]) for r in rows.collect() if r["grams"]),
                 key=lambda r: r[:2])
    if not got:
        return None
    return fit([np.array(g, np.int64) for _, _, g in got], [x for x, _, _ in got])


def predict(docs: DataFrame, model: KernelModel | None) -> DataFrame:
    """doc_id, lang_pred, score for every row; texts are read whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for lo in range(0, batch.num_rows, 64):
                sets = [ngrams(t.as_py()) for t in batch.column("text").slice(lo, 64)]
                if model is None:
                    langs += [UNKNOWN] * len(sets)
                    scores += [0.0] * len(sets)
                    continue
                share = model.scores(sets)
                best = share.argmax(axis=1)
                for row, s in enumerate(sets):
                    langs.append(model.languages[best[row]] if len(s) else UNKNOWN)
                    scores.append(float(share[row, best[row]]) if len(s) else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, PREDICTIONS)


def keep_known(docs: DataFrame, model: KernelModel | None, min_known: float) -> DataFrame:
    """The rows of ``docs`` (all their columns) with a letter whose language is
    known: ``KernelModel.known`` is at least ``min_known``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for lo in range(0, batch.num_rows, 64):
                sets = [ngrams(t.as_py()) for t in batch.column("text").slice(lo, 64)]
                known = model.known(sets) if model else np.zeros(len(sets))
                keep += [len(s) > 0 and k >= min_known for s, k in zip(sets, known)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows not held out."""
    model = train(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_kernel_language_id(spark, sf_dir) -> DataFrame:
    return identify(load_table(spark, sf_dir, "documents"))


QUERIES = {"op7_kernel_language_id": op7_kernel_language_id}
ORACLE: dict[str, str] = {}
