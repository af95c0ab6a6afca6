"""Operator 12: phrase collocations from sorted count streams.

*Counts.*  A phrase of two words or more can only be frequent where all its words
are, and one of three or more only where all its adjacent pairs are.  So three
passes over whole texts count words, then pairs of frequent words, then chains
of three to five words along frequent pairs; each pass counts in its task first,
exactly, and only ``least`` or more remain.  Which words and pairs are frequent goes
to the tasks as a sieve of ``SIEVE_BITS`` bits, whatever their number: a false hit
costs a row that the exact count removes, a miss cannot occur.

*External stream layout.*  The frequent phrases of all orders lie interleaved in
one sorted table per direction: range-partitioned by their words (prefix
order), and by their words backwards (suffix order).  There a phrase
follows its prefixes (suffixes) and is followed by its extensions, so one forward
scan with a stack is the lockstep merge-join of the orders: it reads off the counts
of all first parts and the best right extension, then, backwards, those of all
last parts and the best left extension.  Nothing is looked up by a hash, and a word that a
third of all phrases start with is spread over many tasks, since whole phrases
are the order.

*Borders.*  What a scan misses are the prefixes of its first phrase, which lie in
earlier tasks, at most ``most`` of them.  A scan asks for these by name and tells the
best extension that it saw of each; the answers (at most ``most`` rows a task) are
filled in by the next pass.

Scores are computed with integers of any size.  Defined cases: NULL texts are empty;
a NULL language is ``und``, apart from a language of that name only in that
both are the same; texts without words count nothing; repeated rows count
each time; whole texts are read whatever their length; ties in the score go by
count, then by phrase; languages without a candidate have no rows; an empty table
gives an empty result; columns other than text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkiln.llm import kernels as K
from sparkiln.llm.tables import load_table, materialize

LEAST = 100
MOST = 5
TOP = 2000
SIEVE_BITS = 1 << 26
BYTES_AT_ONCE = 4 << 20
BORDER = K.separators(b".,;:!?\n\x0b\f\r")
BREAKS = BORDER | K.separators(b" \t")
COUNTS = "lang string, phrase string, f long"
OUTPUT = "lang string, phrase string, a long, l long, r long, n long, score long"


class Words:
    """The words of some texts: a code for each, its distinct words, the language
    of each, a hash for the sieve, and whether the next one follows in its piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: pa.Array) -> None:
        data = K.LOWER[data]
        start, end, first = K.words(data, offsets, BREAKS)
        self.code, self.names = K.word_codes(data, start, end)
        langs = lang.cast(pa.large_string()).dictionary_encode()
        self.lang_names = langs.dictionary
        per_doc = langs.indices.to_numpy().astype(np.int64)
        self.lang = np.repeat(per_doc, np.diff(first))
        border = np.concatenate([[0], np.cumsum(BORDER[data])])
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.next = np.zeros(len(start), bool)
        self.next[:-1] = (border[start[1:]] == border[end[:-1]]) & (doc[1:] == doc[:-1])
        self._data, self._start, self._end = data, start, end

    def marks(self) -> np.ndarray:
        """Hash of every word in its language."""
        h = K.span_hash(K.prefix_hash(self._data), self._start, self._end)
        return K.splitmix(h ^ name_hash(self.lang_names)[self.lang])

    def counted(self, at: np.ndarray, length: int) -> pa.RecordBatch:
        """Phrases of ``length`` words from the places ``at``, with their counts."""
        d = len(self.names) + 1
        key = self.lang[at]
        for i in range(length):
            word = self.code[at + i]
            if i and int(key.max(initial=0) + 1) * d >= 1 << 62:  # number the keys anew
                key = np.unique(key, return_inverse=True)[1]
            key = key * d + word
        _, where, n = np.unique(key, return_index=True, return_counts=True)
        parts = [self.names.take(pa.array(self.code[at[where] + i])) for i in range(length)]
        phrase = parts[0] if length == 1 else pc.binary_join_element_wise(
            *parts, pa.scalar(" ", pa.large_string()))
        lang = self.lang_names.take(pa.array(self.lang[at[where]]))
        return pa.RecordBatch.from_arrays(
            [lang.cast(pa.string()), phrase.cast(pa.string()), pa.array(n)],
            names=["lang", "phrase", "f"])


def name_hash(names: pa.Array) -> np.ndarray:
    out = []
    for name in names.to_pylist():
        data = np.frombuffer(name.encode(), np.uint8)
        out.append(K.span_hash(K.prefix_hash(data), np.array([0]), np.array([len(data)]))[0])
    return np.array(out, np.uint64)


def pair_marks(marks: np.ndarray) -> np.ndarray:
    """Hash of every word with its next."""
    return K.splitmix(marks[:-1] * np.uint64(0xD6E8FEB86659FD93) + marks[1:])


def bits_of(marks: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a mark in a sieve of ``bits`` bits, a power of two."""
    mask = np.uint64(bits - 1)
    return marks & mask, (marks >> np.uint64(32)) & mask


class Sieve:
    """A fixed number of bits that tell which marks may be among the given ones."""

    def __init__(self, cells: np.ndarray) -> None:
        self.cells = cells

    def passes(self, marks: np.ndarray) -> np.ndarray:
        out = np.ones(len(marks), bool)
        for bit in bits_of(marks, 64 * len(self.cells)):
            cell = self.cells[(bit >> np.uint64(6)).astype(np.int64)]
            out &= (cell >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return out


def phrase_texts(batch: pa.RecordBatch, size: int) -> Iterator[Words]:
    """The words of a batch's texts, about ``size`` bytes at a time."""
    lang = pc.fill_null(batch.column("lang").cast(pa.large_string()), "und")
    for lo, hi, data, offsets in K.text_chunks(batch.column("text"), size):
        yield Words(data, offsets, lang.slice(lo, hi - lo))


def sieve(phrases: DataFrame, words: int) -> Broadcast:
    """The sieve of phrases of one word or two, made by the tasks cell by cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in phrase_texts(batch, BYTES_AT_ONCE):
                marks = part.marks()
                marks = marks if words == 1 else pair_marks(marks)[::2]
                bit = np.concatenate(bits_of(marks, SIEVE_BITS))
                cell, where = np.unique(bit >> np.uint64(6), return_inverse=True)
                held = np.zeros(len(cell), np.uint64)
                np.bitwise_or.at(held, where, np.uint64(1) << (bit & np.uint64(63)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.view(np.int64)), pa.array(held.view(np.int64))],
                    names=["cell", "held"])

    made = (phrases.select("lang", F.col("phrase").alias("text"))
            .mapInArrow(run, "cell long, held long")
            .groupBy("cell").agg(F.bit_or("held").alias("held")).toArrow())
    cells = np.zeros(SIEVE_BITS >> 6, np.uint64)
    cells[made.column("cell").to_numpy()] = made.column("held").to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(Sieve(cells))


def counts(docs: DataFrame, count: Callable[[Words], Iterator[pa.RecordBatch]], least: int
           ) -> DataFrame:
    """lang, phrase and f of the phrases that ``count`` finds ``least`` times or more;
    the empty phrase, all words of a language, always remains."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in phrase_texts(batch, BYTES_AT_ONCE):
                if len(part.code):
                    yield from count(part)

    return (docs.select("text", "lang").mapInArrow(run, COUNTS).groupBy("lang", "phrase")
            .agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("phrase") == "")))


def count_words(part: Words) -> Iterator[pa.RecordBatch]:
    yield part.counted(np.arange(len(part.code)), 1)
    total = np.bincount(part.lang, minlength=len(part.lang_names))
    yield pa.RecordBatch.from_arrays(
        [part.lang_names.cast(pa.string()), pa.array([""] * len(total)), pa.array(total)],
        names=["lang", "phrase", "f"])


def frequent_phrases(docs: DataFrame, least: int, most: int) -> DataFrame:
    """lang, phrase, f: all phrases of up to ``most`` words that occur ``least`` times
    or more, and the number of words as the empty phrase of each language."""
    singles = materialize(counts(docs, count_words, least), "words")
    shared_words = sieve(singles.where("phrase != ''"), 1)

    def pairs(part: Words) -> Iterator[pa.RecordBatch]:
        known = shared_words.value.passes(part.marks())
        yield part.counted(np.flatnonzero(part.next[:-1] & known[:-1] & known[1:]), 2)

    doubles = materialize(counts(docs, pairs, least), "pairs")
    out = singles.unionByName(doubles)
    if most > 2:
        shared_pairs = sieve(doubles, 2)

        def chains(part: Words) -> Iterator[pa.RecordBatch]:
            linked = np.zeros(len(part.code), bool)
            linked[:-1] = part.next[:-1]
            linked[:-1] &= shared_pairs.value.passes(pair_marks(part.marks()))
            run = linked
            for length in range(3, most + 1):
                # from the places whose last length - 1 links all hold
                run = run[:-1] & linked[length - 2:]
                yield part.counted(np.flatnonzero(run), length)

        out = out.unionByName(materialize(counts(docs, chains, least), "chains"))
    return out


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One forward scan over a sorted stream (lang, words, f, and what an earlier scan
    found).  For every phrase the counts of its proper prefixes, the empty one first
    (0 where it lies in an earlier task), and its best extension by one word; then a
    border row for each prefix that an earlier task holds, with its best extension here."""
    stack: list[list] = []  # the current phrase and its prefixes: words, count, row, best
    borders: dict[tuple, int] = {}
    held: list[list] = []
    lang = None

    def pop(to: int) -> None:
        while len(stack) > to:
            words, f, row, best = stack.pop()
            if row is None:
                borders[lang, words] = max(borders.get((lang, words), 0), best)
                continue
            row[-1] = best
            if stack:
                stack[-1][3] = max(stack[-1][3], f)

    for batch in batches:
        for values in zip(*[c.to_pylist() for c in batch.columns]):
            words = tuple(values[1])
            if values[0] != lang:
                pop(0)
                lang = values[0]
            shared = 0
            while shared < min(len(stack), len(words)) and stack[shared][0] == words[:shared]:
                shared += 1
            pop(shared)
            for size in range(len(stack), len(words)):
                stack.append([words[:size], 0, None, 0])
            row = [*values, [above[1] for above in stack], 0]
            held.append(row)
            stack.append([words, values[2], row, 0])
        # the rows on the stack may still meet extensions
        waiting = [e[2] for e in stack if e[2] is not None]
        ids = {id(r) for r in waiting}
        done = [r for r in held if id(r) not in ids]
        held = waiting
        if done:
            yield _stream(done)
    pop(0)
    if held:
        yield _stream(held)
    if borders:
        yield _stream([[name, list(words), -1, [], 0, [], best]
                       for (name, words), best in borders.items()])


STREAM = pa.schema([
    ("lang", pa.string()), ("words", pa.list_(pa.string())), ("f", pa.int64()),
    ("before", pa.list_(pa.int64())), ("left", pa.int64()),
    ("parts", pa.list_(pa.int64())), ("best", pa.int64())])
STREAM_SQL = ("lang string, words array<string>, f long, before array<long>, left long, "
              "parts array<long>, best long")


def _stream(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t.type) for c, t in zip(zip(*rows), STREAM)], schema=STREAM)


def merged(stream: DataFrame, name: str) -> tuple[DataFrame, Broadcast]:
    """The scanned stream in its order (rows with f >= 0) and, for its borders, the
    count and the best extension of each prefix that a later task asked for."""
    order = ["lang", "words"]
    done = materialize(stream.repartitionByRange(*order).sortWithinPartitions(*order)
                       .mapInArrow(scan, STREAM_SQL), name)
    asked = done.where("f < 0").groupBy("lang", "words").agg(F.max("best").alias("more"))
    # at most ``most`` prefixes a task
    answers = asked.join(done.where("f >= 0").select("lang", "words", "f"), ["lang", "words"])
    table = {(r["lang"], tuple(r["words"])): (r["f"], r["more"]) for r in answers.collect()}
    return (done.where("f >= 0"),
            stream.sparkSession.sparkContext.broadcast(table))


def filled(lang: str, words: tuple, parts: list[int], best: int, borders: dict
           ) -> tuple[list[int], int]:
    """Counts of the prefixes and the best extension, with what other tasks hold."""
    if borders:
        parts = [f or borders[lang, words[:i]][0] for i, f in enumerate(parts)]
        best = max(best, borders.get((lang, words), (0, 0))[1])
    return parts, best


def lowest_cut(a: int, n: int, firsts: list[int], rests: list[int]) -> tuple[int, int, int]:
    """(score, l, r) of the cut with the lowest score, the earliest of several."""
    score, _, first, rest = min((1000 * a * n // (x * y), k, x, y)
                                for k, (x, y) in enumerate(zip(firsts, rests)))
    return score, first, rest


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """lang, phrase, a, l, r, n, score of every phrase that no longer one absorbs."""
    phrases = frequent_phrases(docs, least, most)
    words = F.when(F.col("phrase") == "", F.array().cast("array<string>")).otherwise(
        F.split("phrase", " "))
    none = F.array().cast("array<long>")
    forward, forward_borders = merged(phrases.select(
        "lang", words.alias("words"), "f", none.alias("before"),
        F.lit(0).cast("long").alias("left")), "prefix-order")

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                path = tuple(r["words"])
                parts, best = filled(r["lang"], path, r["parts"], r["best"],
                                     forward_borders.value)
                rows.append([r["lang"], path[::-1], r["f"], parts, best, [], 0])
            if rows:
                yield _stream(rows).select(["lang", "words", "f", "before", "left"])

    backward, backward_borders = merged(forward.mapInArrow(
        turn, "lang string, words array<string>, f long, before array<long>, left long"),
        "suffix-order")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                path = tuple(r["words"])
                if len(path) < 2:
                    continue
                parts, best = filled(r["lang"], path, r["parts"], r["best"],
                                     backward_borders.value)
                a, n = r["f"], r["before"][0]
                if max(best, r["left"]) >= a:
                    continue
                score, first, rest = lowest_cut(a, n, r["before"][1:], parts[:0:-1])
                rows.append((r["lang"], " ".join(path[::-1]), a, first, rest, n, score))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*rows)],
                    names=["lang", "phrase", "a", "l", "r", "n", "score"])

    return backward.mapInArrow(finish, OUTPUT)


def op12_stream_collocations(spark, sf_dir) -> DataFrame:
    found = materialize(collocations(load_table(spark, sf_dir, "documents")), "phrases")
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # each task sends its first TOP of a language only
    return (found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= TOP)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                    "n", "score"))


_LETTERS = ("'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'")

ORACLE_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), {_LETTERS[0]}, {_LETTERS[1]}),
           '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, list_slice(w, i, i + m - 1) AS g, m
  FROM placed, (SELECT unnest(range(1, {MOST + 1})) AS m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, g, m, count(*)::HUGEINT AS f FROM grams GROUP BY lang, g, m
      HAVING count(*) >= {LEAST}),
cut AS (
  SELECT c.lang, c.g, c.m, c.f AS a, x.f AS l, y.f AS r, n, k,
         (1000::HUGEINT * c.f * n) // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1) c
  JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k)
  JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, c.m)
  JOIN total t ON t.lang = c.lang),
best AS (SELECT * FROM cut
         QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
part AS (
  SELECT lang, list_slice(g, i, i + s - 1) AS p, f
  FROM (SELECT *, unnest(range(1, m + 1)) AS i FROM f WHERE m > 2),
       (SELECT unnest(range(2, {MOST})) AS s) WHERE s < m AND i + s - 1 <= m),
longer AS (SELECT lang, p, max(f) AS f FROM part GROUP BY lang, p)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC,
         encode(array_to_string(g, ' ')))::BIGINT AS rank,
       array_to_string(g, ' ') AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score
FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.p = b.g
WHERE x.f IS NULL OR 100 * x.f < 100 * a
QUALIFY row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC,
          encode(array_to_string(g, ' '))) <= {TOP}"""

QUERIES = {"op12_stream_collocations": op12_stream_collocations}
ORACLE = {"op12_stream_collocations": ORACLE_SQL}
