"""Operator 11: Brown class-based n-gram scores.

P(word | previous word) = P(class | class of the previous word) P(word | class); a
text starts after an end and closes with one, which is a class of its own.

1. *Counts* of all words of all training texts, a written table that grows with the
   corpus.  Its most frequent part, at most ``HEAD`` words of ``LONGEST`` bytes or
   fewer, also goes to the tasks; the rest never does.
2. *Units*: the ``UNITS`` most frequent words are clustered one by one, all others
   in ``GROUPS`` groups by their ending, which a task can tell without a table.
   How often units follow each other is one aggregate over the texts.
3. *Exchange clustering*: in each round half of the units, dealt to ``DEALS`` tasks, are
   taken out of their class one after another and put where the likelihood of the
   class bigrams is largest, given the class counts that the round began with
   and the task's own moves; the pairs table is then counted by the new
   classes, and the round with the largest likelihood stands.  The driver holds
   the class of each unit and the counts of class pairs, whose sizes the
   parameters fix.
4. *Scores*: transitions and frequent words are summed text by text where the text
   is; its other words are joined with the table of counts, word by word, and added.

Smoothing: (n(c, d) + b q(d)) / (n(c) + b) for class d after class c, with q the
add-one share of class d and b the number of classes; (n(w) + 1) / (n(c) + v(c) + 1)
for word w of class c with v(c) different words, so that one share of each class is
left for all words that training does not have.  Both sum to one.

Defined cases: NULL and empty texts have the end as their only token; a NULL id is
held out; repeated rows count and are scored each time; words of any length are
words; without training texts all counts are 0; of equally frequent words the
smaller comes first, of equally good classes the present one, then the first; an empty
table gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkiln.llm import kernels as K
from sparkiln.llm.tables import load_table, materialize

CLASSES = 128
UNITS = 1 << 14
GROUPS = 1 << 10
HEAD = 1 << 18
LONGEST = 64
ROUNDS = 8
DEALS = 32
BYTES_AT_ONCE = 4 << 20
END = ""  # the end token's name in the table of counts; no word is empty

_NAMES = pa.large_string()


class Tokens:
    """Words of some texts: the code of each, the distinct words, and text bounds."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        data = K.LOWER[data]
        start, end, self.first = K.words(data, offsets)
        self.code, self.names = K.word_codes(data, start, end)
        self.texts = len(offsets) - 1

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), np.diff(self.first))

    def closed(self, value: np.ndarray, end: int) -> np.ndarray:
        """``value`` of every word, with ``end`` after each text."""
        out = np.full(len(value) + self.texts, end, np.int64)
        out[np.arange(len(value)) + self.text_of()] = value
        return out


def texts(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, Tokens]]:
    for lo, hi, data, offsets in K.text_chunks(batch.column("text"), size):
        yield lo, hi, Tokens(data, offsets)


def ending_group(names: pa.Array, groups: int) -> np.ndarray:
    """Group of every word by its last two bytes."""
    first = np.frombuffer(names.buffers()[1], np.int64, len(names) + 1, names.offset * 8)
    data = np.frombuffer(names.buffers()[2] or b"", np.uint8)
    last = data[first[1:] - 1].astype(np.uint64)
    other = np.where(np.diff(first) > 1, data[np.maximum(first[1:] - 2, 0)], 0).astype(np.uint64)
    return (K.splitmix(other * np.uint64(256) + last) % np.uint64(groups)).astype(np.int64)


class Vocabulary:
    """The frequent words with their counts, and the unit of every word."""

    def __init__(self, names: pa.Array, counts: np.ndarray, units: int, groups: int) -> None:
        self.names, self.counts = names, counts
        self.units, self.groups = min(units, len(names)), groups

    @property
    def size(self) -> int:
        """Number of units; the end is the last one."""
        return self.units + self.groups + 1

    def places(self, names: pa.Array) -> np.ndarray:
        """Rank among the frequent words, -1 for others."""
        found = pc.index_in(names, value_set=self.names)
        return pc.fill_null(found, -1).to_numpy().astype(np.int64)

    def unit_of(self, names: pa.Array, place: np.ndarray) -> np.ndarray:
        own = (place >= 0) & (place < self.units)
        return np.where(own, place, self.units + ending_group(names, self.groups))


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c over all texts; the end counts once a text.  Written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, part in texts(batch, BYTES_AT_ONCE):
                n = np.bincount(part.code, minlength=len(part.names))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([part.names.cast(pa.string()), pa.array([END])]),
                     pa.array(np.append(n, part.texts))], names=["word", "c"])

    counted = docs.select("text").mapInArrow(run, "word string, c long")
    return materialize(counted.groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


def _step(c: Column) -> Column:
    """Counts on a scale of at most 505 steps."""
    return F.floor(F.log2(c) * 8)


def vocabulary(counts: DataFrame, head: int, units: int, groups: int
               ) -> tuple[Vocabulary, DataFrame]:
    """The words of at least some count, ``head`` at most, and the table of the others."""
    short = (F.col("word") != END) & (F.octet_length("word") <= LONGEST)
    steps = counts.where(short).groupBy(_step(F.col("c")).alias("step")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    least, held = None, 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        held += r["n"]
        if held > head:
            break
        least = r["step"]
    often = short & (_step(F.col("c")) >= least) if least is not None else F.lit(False)
    top = counts.where(often).toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    names = pa.chunked_array(top.column("word").chunks, pa.string()).combine_chunks().cast(_NAMES)
    known = Vocabulary(names, top.column("c").to_numpy().astype(np.int64), units, groups)
    return known, counts.where(~often & (F.col("word") != END))


def unit_pairs(docs: DataFrame, known) -> DataFrame:
    """u, v, n: how often unit v follows unit u, ends included.  Written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known.value
        end = words.size - 1
        for batch in batches:
            for _, _, part in texts(batch, BYTES_AT_ONCE):
                unit = words.unit_of(part.names, words.places(part.names))
                after = part.closed(unit[part.code], end)
                before = np.concatenate([[end], after[:-1]])
                pair, n = np.unique(before * words.size + after, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)],
                                                 names=["pair", "n"])

    size = known.value.size
    counted = docs.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n"))
    return materialize(counted.select(F.floor(F.col("pair") / size).cast("int").alias("u"),
                                      (F.col("pair") % size).cast("int").alias("v"), "n"), "unit-pairs")


def summed(cells: np.ndarray, names: list[str], shape: tuple[int, ...]) -> pa.RecordBatch:
    """The cells that are not 0, with their places."""
    at = np.flatnonzero(cells)
    place = np.unravel_index(at, shape)
    return pa.RecordBatch.from_arrays(
        [*[pa.array(p.astype(np.int64)) for p in place], pa.array(cells[at])], names=names)


def class_matrix(pairs: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    """n(c, d) of all pairs of classes."""
    shared = pairs.sparkSession.sparkContext.broadcast(classes)  # one number a unit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, of = np.zeros(k * k, np.int64), shared.value
        for b in batches:
            u, v, n = (b.column(c).to_numpy().astype(np.int64) for c in ("u", "v", "n"))
            np.add.at(cells, of[u] * k + of[v], n)
        yield summed(cells, ["c", "d", "n"], (k, k))

    out = np.zeros((k, k), np.int64)
    for r in pairs.mapInArrow(run, "c long, d long, n long").groupBy("c", "d").agg(
            F.sum("n").alias("n")).collect():
        out[r["c"], r["d"]] = r["n"]
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(matrix: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, without the words' constant share."""
    m = matrix.astype(np.float64)
    return float(_xlogx(m).sum() - _xlogx(m.sum(axis=0)).sum() - _xlogx(m.sum(axis=1)).sum())


class Exchange:
    """Moves units between classes, keeping the counts of class pairs."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.m = matrix.astype(np.float64)
        self.rows, self.columns = self.m.sum(axis=1), self.m.sum(axis=0)

    def _shift(self, c: int, after: np.ndarray, before: np.ndarray, own: float, sign: int) -> None:
        self.m[c] += sign * after
        self.m[:, c] += sign * before
        self.m[c, c] += sign * own
        self.rows += sign * before
        self.columns += sign * after
        self.rows[c] += sign * (after.sum() + own)
        self.columns[c] += sign * (before.sum() + own)

    def gains(self, after: np.ndarray, before: np.ndarray, own: float) -> np.ndarray:
        """Likelihood gained by each class that a unit outside all classes may join:
        ``after``/``before`` count the classes next to it, ``own`` itself next to itself."""
        m = self.m
        a, b = np.flatnonzero(after), np.flatnonzero(before)
        gain = (_xlogx(m[:, a] + after[a]) - _xlogx(m[:, a])).sum(axis=1)
        gain += (_xlogx(m[b] + before[b, None]) - _xlogx(m[b])).sum(axis=0)
        self_pair = m.diagonal()
        gain += (_xlogx(self_pair + after + before + own) + _xlogx(self_pair)
                 - _xlogx(self_pair + after) - _xlogx(self_pair + before))
        # neighbours' totals grow alike in every class; its own class's with itself
        rows, columns = self.rows + before, self.columns + after
        gain -= _xlogx(rows + after.sum() + own) - _xlogx(rows)
        gain -= _xlogx(columns + before.sum() + own) - _xlogx(columns)
        return gain

    def move(self, c: int, after: np.ndarray, before: np.ndarray, own: float) -> int:
        """Take a unit out of class ``c`` and put it where the gain is largest.  Class 0,
        the end's, takes no words."""
        self._shift(c, after, before, own, -1)
        gain = self.gains(after, before, own)
        gain[0] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= gain[c] + 1e-9:
            best = c
        self._shift(best, after, before, own, 1)
        return best


def exchange_round(pairs: DataFrame, classes: np.ndarray, matrix: np.ndarray, turn: np.ndarray,
                   deals: int) -> np.ndarray:
    """New classes after the units of ``turn`` (booleans) had their move."""
    k, size = len(matrix), len(classes)
    keys = 2 * k + 1  # classes after, classes before, itself
    shared = pairs.sparkSession.sparkContext.broadcast((classes, matrix, turn))

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, _, moving = shared.value
        cells = np.zeros(size * keys, np.int64)
        for b in batches:
            u, v, n = (b.column(c).to_numpy().astype(np.int64) for c in ("u", "v", "n"))
            same = u == v
            for at, key, unit in ((moving[u] & ~same, of[v], u), (moving[v] & ~same, k + of[u], v),
                                  (moving[u] & same, np.full(len(u), 2 * k), u)):
                np.add.at(cells, unit[at] * keys + key[at], n[at])
        yield summed(cells, ["unit", "key", "n"], (size, keys))

    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, counts, _ = shared.value
        table = pa.Table.from_batches(batches, schema=pa.schema(
            [("unit", pa.int64()), ("key", pa.int64()), ("n", pa.int64())]))
        unit, key, n = (c.to_numpy() for c in table.columns)
        units, row = np.unique(unit, return_inverse=True)
        vectors = np.zeros((len(units), keys), np.int64)  # at most the units of a deal
        np.add.at(vectors, (row, key), n)
        state, out = Exchange(counts), []
        for u, vector in zip(units, vectors.astype(np.float64)):
            out.append(state.move(int(of[u]), vector[:k], vector[k:2 * k], vector[2 * k]))
        yield pa.RecordBatch.from_arrays([pa.array(units), pa.array(out, pa.int64())],
                                         names=["unit", "class"])

    dealt = pairs.mapInArrow(neighbours, "unit long, key long, n long").repartition(
        deals, F.pmod(F.xxhash64("unit"), F.lit(deals)))
    moved = dealt.mapInArrow(moves, "unit long, class long").toArrow()
    out = classes.copy()
    out[moved.column("unit").to_numpy()] = moved.column("class").to_numpy()
    return out


def cluster(pairs: DataFrame, words: int, size: int, classes: int, rounds: int
            ) -> tuple[np.ndarray, np.ndarray]:
    """Class of every unit, 0 the end's, and n(c, d).  The most frequent words begin in
    classes of their own, all others together."""
    k = classes + 1
    now = np.full(size, classes, np.int64)
    alone = min(classes - 1, words)
    now[:alone] = np.arange(1, alone + 1)
    now[-1] = 0
    matrix = class_matrix(pairs, now, k)
    best = now, matrix
    half = K.splitmix(np.arange(size, dtype=np.uint64)) % np.uint64(2)
    for i in range(rounds if matrix.any() else 0):
        turn = half == np.uint64(i % 2)
        turn[-1] = False
        now = exchange_round(pairs, now, matrix, turn, DEALS)
        matrix = class_matrix(pairs, now, k)
        if likelihood(matrix) > likelihood(best[1]):
            best = now, matrix
    return best


@dataclass
class ClassModel:
    words: Vocabulary
    classes: np.ndarray  # of each unit
    transition: np.ndarray  # log10 P(d | c)
    room: np.ndarray  # log10 of n(c) + v(c) + 1
    tokens: int  # N
    distinct: int  # V
    ends: int  # training texts

    @property
    def base_room(self) -> float:
        return float(np.log10(self.tokens + self.distinct + 1))


def transitions(matrix: np.ndarray) -> np.ndarray:
    k = len(matrix)
    share = (matrix.sum(axis=0) + 1) / (matrix.sum() + k)
    return np.log10((matrix + k * share) / (matrix.sum(axis=1, keepdims=True) + k))


def class_sizes(counts: DataFrame, shared, classes: np.ndarray, k: int) -> np.ndarray:
    """n(c) + v(c) of every class, over the whole table of counts."""
    of = counts.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, words = np.zeros(k, np.int64), shared.value
        for batch in batches:
            names = batch.column("word").cast(_NAMES)
            c = of.value[words.unit_of(names, words.places(names))]
            np.add.at(cells, c, batch.column("c").to_numpy() + 1)
        yield summed(cells, ["c", "n"], (k,))

    out = np.zeros(k, np.int64)
    rows = counts.where(F.col("word") != END).mapInArrow(run, "c long, n long")
    for r in rows.groupBy("c").agg(F.sum("n").alias("n")).collect():
        out[r["c"]] = r["n"]
    return out


def train(docs: DataFrame, classes: int = CLASSES, units: int = UNITS, groups: int = GROUPS,
          head: int = HEAD, rounds: int = ROUNDS) -> tuple[ClassModel, DataFrame]:
    """The model of all texts of ``docs``, and the counts of the words that it does not hold."""
    counts = word_counts(docs)
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"),
                       F.max(F.when(F.col("word") == END, F.col("c"))).alias("ends")).first()
    known, others = vocabulary(counts, head, units, groups)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    pairs = unit_pairs(docs, shared)
    of, matrix = cluster(pairs, known.units, known.size, classes, rounds)
    sizes = class_sizes(counts, shared, of, len(matrix))
    model = ClassModel(known, of, transitions(matrix), np.log10(sizes + 1), total["n"] or 0,
                       total["v"], total["ends"] or 0)
    return model, others


def local_scores(docs: DataFrame, model: ClassModel) -> DataFrame:
    """A row per text: what the model knows by itself, and the words and numbers of
    occurrences that are left to be looked up."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        log_count = np.append(np.log10(m.words.counts + 1), 0.0)  # the last for place -1
        for batch in batches:
            for lo, hi, part in texts(batch, BYTES_AT_ONCE):
                place = m.words.places(part.names)
                of = m.classes[m.words.unit_of(part.names, place)]
                text, n = part.text_of(), part.texts
                after = part.closed(of[part.code], 0)
                before = np.concatenate([[0], after[:-1]])
                step = m.transition[before, after]
                step[after > 0] -= m.room[after[after > 0]]
                closed_text = part.closed(text, -1)
                ends = closed_text < 0
                closed_text[ends] = np.arange(n)
                logs = np.bincount(text, log_count[place][part.code], n).astype(np.float64)
                rare = place[part.code] < 0
                known = np.bincount(text, ~rare, n).astype(np.int64)
                d = len(part.names) + 1
                key, times = np.unique(text[rare] * d + part.code[rare], return_counts=True)
                bounds = np.searchsorted(key // d, np.arange(n + 1)).astype(np.int32)
                names = part.names.take(pa.array(key % d)).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo),
                     pa.array(np.diff(part.first) + 1), pa.array(known), pa.array(logs),
                     pa.array(np.bincount(closed_text, step, n)),
                     pa.ListArray.from_arrays(bounds, names),
                     pa.ListArray.from_arrays(bounds, pa.array(times))],
                    names=["doc_id", "n_tokens", "known", "logs", "steps", "words", "times"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, known long, logs double, steps double, "
             "words array<string>, times array<long>")


def score(docs: DataFrame, model: ClassModel, others: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row."""
    # numbered as written, so the numbers are fixed
    local = materialize(local_scores(docs, model).withColumn(
        "row", F.monotonically_increasing_id()), "local-scores")
    rare = local.select("row", F.explode(F.arrays_zip("words", "times")).alias("e")).select(
        "row", F.col("e.words").alias("word"), F.col("e.times").alias("times"))
    found = rare.join(others, "word").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("rest"))
    logs = F.col("logs") + F.coalesce("rest", F.lit(0.0))
    end = F.lit(float(np.log10(model.ends + 1)))
    known = F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(int(model.ends > 0))
    return local.join(found, "row", "left").select(
        "doc_id", "n_tokens", known.cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (logs + end - F.col("n_tokens") * model.base_room).alias("base_score"),
        (logs + F.col("steps")).alias("score"))


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training: CRC-32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(True))


def score_documents(docs: DataFrame) -> DataFrame:
    """All rows scored by a model of those that are not held out."""
    docs = docs.select("doc_id", "text")
    model, others = train(docs.where(~held_out(F.col("doc_id"))))
    return score(docs, model, others).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        "train_tokens", "base_score", "score")


def op11_class_bigrams(spark, sf_dir) -> DataFrame:
    return score_documents(load_table(spark, sf_dir, "documents"))


QUERIES = {"op11_class_bigrams": op11_class_bigrams}
ORACLE: dict[str, str] = {}
