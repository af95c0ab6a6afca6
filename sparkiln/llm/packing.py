"""Operator 10: best-fit packing after Martello-Toth dominance reduction.

Documents become token sequences (public vocabulary plus an end token); longer
ones are cut into pieces of the sequence length.  Packing needs only the
*lengths*: pieces of equal length are interchangeable, so the whole instance
is its length histogram, at most ``capacity`` rows whatever the corpus size.
Both steps run on that histogram, run-length encoded:

1. *Reduction* (Martello and Toth): go through the lengths from the largest
   down.  A set of one to three pieces holding the current length is fixed for
   good when it dominates every other set that could hold it, and the fixed
   pieces leave the instance.
2. *Best fit* (decreasing) of what is left.

The result is a small plan: (length, first rank, count) -> sequences and
offsets.  Spark ranks the pieces of each length (per-task ranks plus per-task
counts, so the thousands of copies of one text are not gathered) and joins
them with the plan.

Defined cases: a NULL or empty text is the end token alone; a NULL doc_id is
kept; repeated rows are separate documents; an empty table packs into nothing;
extra columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkiln.llm.tables import load_table, materialize

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.tiktoken"
END_OF_TEXT = "<|endoftext|>"

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "task int, local_rank long")


@lru_cache(maxsize=2)
def _encoder(path: str):
    """Encoder with the ids of ``byte_bpe_50k.json``: the same vocabulary as a
    rank file, read by the faster of the two libraries.  As there, the text of
    the one special token is that token."""
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=PATTERN, mergeable_ranks=ranks,
                             special_tokens={END_OF_TEXT: len(ranks)})


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_ids(text: str | None, path: str) -> np.ndarray:
    """Ids of a whole text and the end token, unsigned 32-bit."""
    if not text:
        return np.array([END_ID], np.uint32)
    ids = _encoder(path).encode_to_numpy(text, allowed_special="all", disallowed_special=())
    return np.append(ids.astype(np.uint32, copy=False), np.uint32(END_ID))


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: full ones
    but for the first."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    return [(0, head)] * (head > 0) + [(s, capacity) for s in range(head, n, capacity)]


def tokenized_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None
                     ) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in the
    same task.  Whole texts; only ids' lengths and checksums leave the task."""
    path = vocabulary or vocabulary_path()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "local_rank"]
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = token_ids(text.as_py(), path).astype("<u4", copy=False)
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    rows.append((doc.as_py(), k, start, length, crc, task, seen[length]))
                    seen[length] += 1
            cols = list(zip(*rows)) if rows else [()] * len(names)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(),
                     pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(pieces, PIECES)


class _Instance:
    """Lengths still to be packed and the sets chosen so far."""

    def __init__(self, histogram: dict[int, int], capacity: int) -> None:
        self.left = {s: n for s, n in histogram.items() if n > 0}
        self.capacity = capacity
        self.chosen: list[tuple[tuple[int, ...], int]] = []  # (lengths, how many sequences)

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for s in lengths:
            self.left[s] -= times
            if not self.left[s]:
                del self.left[s]
        self.chosen.append((lengths, times))


def _largest(sizes: list[int], left: dict[int, int], room: int, used: tuple[int, ...]
             ) -> int | None:
    """Largest length of at most ``room`` with a piece not in ``used``
    (``sizes`` ascending)."""
    for s in reversed(sizes):
        if s <= room and left.get(s, 0) > used.count(s):
            return s
    return None


def _smallest(sizes: list[int], left: dict[int, int], k: int, used: tuple[int, ...],
              above: int = 0) -> list[int]:
    """The ``k`` smallest pieces not in ``used`` longer than ``above``."""
    out: list[int] = []
    for s in sizes:
        if s > above and left.get(s, 0):
            out += [s] * min(k - len(out), max(0, left[s] - used.count(s)))
            if len(out) == k:
                break
    return out


def dominating_set(left: dict[int, int], j: int, capacity: int) -> tuple[int, ...] | None:
    """A set with a piece of length ``j`` that dominates every feasible set
    with such a piece, or None.

    Set A dominates B when B's other pieces can be grouped so that each group
    fits into the room of one piece of A.  Let b be the largest piece that fits
    beside j.

    * nothing fits beside j: {j};
    * j + b fills the sequence, or no two pieces fit beside j: {j, b}, since
      the others of any set are together no longer than b;
    * at most two fit beside j: every pair is no longer than b together ->
      {j, b}; or, with q the largest that fits beside {j, b}, no pair of pieces
      both longer than q fits -> {j, b, q} (any x >= y: x fits into b, y into q).
    """
    sizes = sorted(left)
    room = capacity - j
    b = _largest(sizes, left, room, (j,))
    if b is None:
        return (j,)
    small = _smallest(sizes, left, 3, (j,))
    if b == room or len(small) < 2 or sum(small[:2]) > room:
        return (j, b)
    if len(small) == 3 and sum(small) <= room:
        return None
    best_pair = 0
    for x in sizes:
        if x < room and left[x] > (x == j):
            y = _largest(sizes, left, room - x, (j, x))
            if y is not None:
                best_pair = max(best_pair, x + y)
    if best_pair <= b:
        return (j, b)
    q = _largest(sizes, left, room - b, (j, b))
    if q is not None:
        longer = _smallest(sizes, left, 2, (j,), above=q)
        if len(longer) < 2 or sum(longer) > room:
            return (j, b, q)
    return None


def reduce_instance(inst: _Instance) -> None:
    """Fix dominating sets, from the largest length down, until none is left
    to fix.  A set is taken as often as its pieces last, as far as the test
    that proved it still holds: taking pieces away only removes rival sets,
    while j, b and q stay the choice until one of them runs out."""
    again = True
    while again:
        again = False
        for j in sorted(inst.left, reverse=True):
            while inst.left.get(j):
                chosen = dominating_set(inst.left, j, inst.capacity)
                if chosen is None:
                    break
                inst.take(chosen, min(inst.left[s] // chosen.count(s) for s in set(chosen)))
                again = True


def best_fit(inst: _Instance) -> None:
    """Best fit decreasing: each piece goes to the fullest open sequence that
    has room.  Equal open sequences are one group, equal pieces one run."""
    groups: dict[int, list[list]] = defaultdict(list)  # room -> [lengths, how many]
    for s in sorted(inst.left, reverse=True):
        n = inst.left[s]
        while n:
            rooms = [r for r, g in groups.items() if g and r >= s]
            if rooms:
                room = min(rooms)
                lengths, many = groups[room].pop()
            else:
                room, lengths, many = inst.capacity, (), n
            fit = room // s
            full = min(many, n // fit)
            if full:
                groups[room - fit * s].append([lengths + (s,) * fit, full])
            n -= full * fit
            over = many - full
            if over and n and n < fit:
                groups[room - n * s].append([lengths + (s,) * n, 1])
                n, over = 0, over - 1
            if over and lengths:
                groups[room].append([lengths, over])
    inst.left = {}
    inst.chosen += [(tuple(lengths), many) for g in groups.values() for lengths, many in g]


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY
                 ) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Plan rows (length, first rank, rank count, first sequence, pieces of
    the length in each sequence, offset of the first of them) and the number
    of sequences.  Bounded by the histogram, so it is solved on the driver."""
    if any(not 1 <= s <= capacity for s in histogram):
        raise ValueError("piece lengths must lie between 1 and the capacity")
    inst = _Instance(histogram, capacity)
    reduce_instance(inst)
    best_fit(inst)
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for lengths, many in inst.chosen:
        offset = 0
        for s in sorted(set(lengths), reverse=True):
            each = lengths.count(s)
            rows.append((s, used[s], each * many, sequence, each, offset))
            used[s] += each * many
            offset += each * s
        sequence += many
    return rows, sequence


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces (``length``,
    ``task``, ``local_rank``)."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("_n"))
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    rows, _ = packing_plan(histogram, capacity)
    plan = spark.createDataFrame(
        rows, "p_length long, p_first long, p_count long, p_sequence long, p_each long, "
              "p_offset long")
    along = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("length").alias("_l"), F.col("task").alias("_t"),
                          F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_base"))
    ranked = pieces.join(bases, (F.col("length") == F.col("_l")) & (F.col("task") == F.col("_t")))
    rank = F.col("_base") + F.col("local_rank")
    # the plan has a few rows per length and its size is bounded by the capacity
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("p_length"))
                         & (rank >= F.col("p_first"))
                         & (rank < F.col("p_first") + F.col("p_count")))
    at = rank - F.col("p_first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("p_sequence") + F.floor(at / F.col("p_each"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + at % F.col("p_each") * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None
                   ) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialize(tokenized_pieces(docs, capacity, vocabulary), "pieces")
    return pack(pieces, capacity)


def op10_dominance_packing(spark, sf_dir) -> DataFrame:
    return pack_documents(load_table(spark, sf_dir, "documents"))


QUERIES = {"op10_dominance_packing": op10_dominance_packing}
ORACLE: dict[str, str] = {}
