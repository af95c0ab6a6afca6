"""Operator 5: benchmark decontamination by SimHash windows.

For every benchmark item of n words, documents are looked at through windows of
n words.  A window's 64-bit SimHash (over its k-word shingles, with their
counts as weights) is looked up among the items' fingerprints by multi-index
Hamming blocks: 8 blocks of 8 bits, and by the pigeonhole principle two
fingerprints within ``RADIUS`` = 23 bits agree to 2 bits in some block, so the
lookup misses no fingerprint within the radius.  Candidates are decided by the
exact weighted-shingle similarity, sum of minima over sum of maxima of shingle
counts, at least ``THRESHOLD``.

Two multisets at weighted similarity 0.8 differ in 15 % of the fingerprint bits
on average (9.7 bits, standard deviation 2.9), so radius 23 lies 4.6 standard
deviations out.  Fingerprints are made only for windows that hold at least one
shingle of an item: any other window has similarity zero with every item of
that block, whatever its fingerprint.

The items are the query set: they go to the tasks in blocks of bounded size
(``BLOCK_ITEMS`` items and ``BLOCK_CHARS`` characters, one longer item being a
block of its own), one pass over the documents per block.  Documents are never
shuffled.

Words are runs of letters, digits and non-ASCII characters, lower-cased.  An
item with fewer than k words matches where exactly its words stand in a row.

Defined cases: NULL or wordless texts and items match nothing; an item with a NULL
item_id has no name to report, so ``find_leaks`` leaves it out, but ``remove_leaks``
goes by the items' texts alone and matches it; a document
shorter than an item is one window; rows are matched one by one, so repeated
rows give repeated results and a NULL doc_id is carried; ties between windows
go to the first; empty tables give empty results; only ids and texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkiln.llm import kernels as K
from sparkiln.llm.tables import load_table, materialize, row_key

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 23
BLOCKS = 8  # of 8 bits
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 20_000_000
LEAKS = "key long, doc_id long, item_id long, similarity double, word_start long, n_words long"

_POPCOUNT = np.bitwise_count(np.arange(256, dtype=np.uint8))


def word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of all words, first word of each text) per chunk."""
    for lo, _, data, offsets in K.text_chunks(column):
        start, end, first = K.words(data, offsets, K.PUNCT)
        yield lo, K.span_hash(K.prefix_hash(data), start, end), first


def fingerprints(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash of the windows of ``width`` shingles at ``starts``."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    total = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(2 * bits - 1, axis=0, out=total[1:])
    return np.packbits(total[starts + width] > total[starts], axis=1).view(np.uint64).ravel()


@dataclass
class SizeIndex:
    """Items with the same number of words."""
    n_words: int
    items: np.ndarray
    prints: np.ndarray
    counts: list[tuple[np.ndarray, np.ndarray]]  # distinct shingles and their counts
    near: np.ndarray = field(default=None)  # blocks x 256 values x items: within 2 bits

    def lookup(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius."""
        if self.near is None:
            parts = self.prints.view(np.uint8).reshape(-1, BLOCKS)
            values = np.arange(256, dtype=np.uint8)
            self.near = np.stack([_POPCOUNT[values[:, None] ^ parts[None, :, b]]
                                  <= RADIUS // BLOCKS for b in range(BLOCKS)])
        out = []
        for lo in range(0, len(prints), 1024):
            parts = prints[lo:lo + 1024].view(np.uint8).reshape(-1, BLOCKS)
            hit = self.near[0][parts[:, 0]]
            for b in range(1, BLOCKS):
                hit = hit | self.near[b][parts[:, b]]
            w, i = np.nonzero(hit)
            close = np.bitwise_count(prints[lo + w] ^ self.prints[i]) <= RADIUS
            out.append((w[close] + lo, i[close]))
        return tuple(np.concatenate(x) for x in zip(*out))


class ItemBlock:
    """Items of one block, ready to be matched (pickled to the tasks)."""

    def __init__(self, ids: list[int], texts: list[str], k: int) -> None:
        self.k = k
        sized: dict[int, list[tuple[int, np.ndarray]]] = {}
        for lo, h, first in word_hashes(pa.array(texts, pa.string())):
            for row in range(len(first) - 1):
                own = h[first[row]:first[row + 1]]
                if len(own):
                    sized.setdefault(len(own), []).append((ids[lo + row], own))
        self.sizes: dict[int, SizeIndex] = {}
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        owners: list[tuple[np.ndarray, int]] = []
        for n, found in sorted(sized.items()):
            items = np.array([i for i, _ in found], np.int64)
            grams = [K.shingles(own, np.array([0, n]), k)[0] for _, own in found]
            if n < k:
                self.short[n] = (items, np.concatenate(grams))
                continue
            prints = np.concatenate([fingerprints(g, np.array([0]), len(g)) for g in grams])
            self.sizes[n] = SizeIndex(n, items, prints,
                                      [np.unique(g, return_counts=True) for g in grams])
            owners += [(g, n) for g in grams]
        # shingle -> sizes of the items that hold it
        flat = np.concatenate([g for g, _ in owners]) if owners else np.empty(0, np.uint64)
        size = np.repeat([n for _, n in owners], [len(g) for g, _ in owners]) if owners else flat
        pairs = np.unique(np.stack([flat, size.astype(np.uint64)], axis=1), axis=0)
        self.shingle, self.first = np.unique(pairs[:, 0], return_index=True)
        self.first = np.append(self.first, len(pairs))
        self.size = pairs[:, 1].astype(np.int64)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.shingle >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of item shingles, which shingle)."""
        if not len(self.shingle):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.sieve[(grams >> np.uint64(44)).astype(np.int64)])
        which = np.minimum(np.searchsorted(self.shingle, grams[at]), len(self.shingle) - 1)
        same = self.shingle[which] == grams[at]
        return at[same], which[same]

    def match(self, grams: np.ndarray, n_words: int, at: np.ndarray, which: np.ndarray,
              threshold: float) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of one document's leaks."""
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        counts = self.first[which + 1] - self.first[which]
        pos = np.repeat(at, counts)
        sizes = self.size[np.concatenate([np.arange(self.first[w], self.first[w + 1])
                                          for w in which])]
        for n in np.unique(sizes):
            index = self.sizes[int(n)]
            words = min(int(n), n_words)
            width = words - self.k + 1  # shingles in a window
            last = len(grams) - width
            own = pos[sizes == n]
            mark = np.zeros(last + 2, np.int64)
            np.add.at(mark, np.clip(own - width + 1, 0, last), 1)
            np.add.at(mark, np.clip(own, 0, last) + 1, -1)
            starts = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            lo = int(starts[0])
            prints = fingerprints(grams[lo:int(starts[-1]) + width], starts - lo, width)
            for w, i in zip(*index.lookup(prints)):
                s = int(starts[w])
                similarity = weighted_similarity(grams[s:s + width], *index.counts[i])
                key = (int(n), int(i))
                if similarity >= threshold and similarity > best.get(key, (0.0,))[0]:
                    best[key] = (similarity, s, words)
        out: dict[int, tuple[float, int, int]] = {}
        for (n, i), found in sorted(best.items()):
            item = int(self.sizes[n].items[i])
            if found[0] > out.get(item, (0.0,))[0]:
                out[item] = found
        return [(item, *found) for item, found in out.items()]


def weighted_similarity(window: np.ndarray, shingle: np.ndarray, count: np.ndarray) -> float:
    """Sum of minima over sum of maxima of the shingle counts."""
    own, n = np.unique(window, return_counts=True)
    both, i, j = np.intersect1d(own, shingle, assume_unique=True, return_indices=True)
    low = int(np.minimum(n[i], count[j]).sum())
    return low / (len(window) + int(count.sum()) - low)


def match_chunk(block: ItemBlock, h: np.ndarray, first: np.ndarray, threshold: float
                ) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, similarity, first word, words) of the leaks of a chunk."""
    grams, bounds = K.shingles(h, first, block.k)
    at, which = block.hits(grams)
    doc = np.searchsorted(bounds, at, "right") - 1
    for row in np.unique(doc):
        n_words = int(first[row + 1] - first[row])
        if n_words < block.k:
            continue
        own = doc == row
        for found in block.match(grams[bounds[row]:bounds[row + 1]], n_words,
                                 at[own] - bounds[row], which[own], threshold):
            yield int(row), *found
    for n, (items, wanted) in block.short.items():
        grams, bounds = K.shingles(h, first, n)
        at = np.flatnonzero(np.isin(grams, wanted))
        doc = np.searchsorted(bounds, at, "right") - 1
        seen = set()
        for row, a in zip(doc, at):
            for item in items[wanted == grams[a]]:
                if (row, item) not in seen:
                    seen.add((row, item))
                    yield int(row), int(item), 1.0, int(a - bounds[row]), n


def item_blocks(benchmark: DataFrame, k: int) -> Iterator[ItemBlock]:
    """The distinct items in blocks of bounded size.  Results are per item, so
    copies of a row add nothing, and they would all fall into one block."""
    items = materialize(benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text")).where(
        "item_id IS NOT NULL AND text IS NOT NULL").distinct(), "items")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(-(-size["n"] // BLOCK_ITEMS), -(-(size["chars"] or 0) // BLOCK_CHARS))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        rows.sort(key=lambda r: (r["item_id"], r["text"]))
        if rows:
            yield ItemBlock([r["item_id"] for r in rows], [r["text"] for r in rows], k)


def find_leaks(docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE,
               threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row and item it leaks: key (see ``row_key``),
    doc_id, item_id, similarity, word_start, n_words."""
    texts = docs.select("doc_id", "text").select(
        row_key("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.lower("text").alias("text"))
    out = texts.select("key", "doc_id").where(F.lit(False)).select(
        "key", "doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("similarity"),
        F.lit(0).cast("long").alias("word_start"), F.lit(0).cast("long").alias("n_words"))
    for n, block in enumerate(item_blocks(benchmark, k)):
        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for lo, h, first in word_hashes(batch.column("text")):
                    rows += [(lo + row, *rest) for row, *rest in
                             match_chunk(block, h, first, threshold)]
                cols = list(zip(*rows)) if rows else [()] * 5
                at = pa.array(cols[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(at), batch.column("doc_id").take(at),
                     *[pa.array(c, t) for c, t in zip(
                         cols[1:], [pa.int64(), pa.float64(), pa.int64(), pa.int64()])]],
                    names=["key", "doc_id", "item_id", "similarity", "word_start", "n_words"])

        found = texts.mapInArrow(run, LEAKS)
        out = found if n == 0 else out.unionByName(found)
    return out


def remove_leaks(docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE,
                 threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all their columns) that leak no item, whatever the
    items' ids."""
    lower = "_lower"
    while lower in docs.columns:
        lower = "_" + lower
    out = docs.withColumn(lower, F.lower("text"))
    # any item will do, so items are their texts
    for block in item_blocks(benchmark.select(F.lit(0).alias("item_id"), "text"), k):
        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for lo, h, first in word_hashes(batch.column(lower)):
                    for row, *_ in match_chunk(block, h, first, threshold):
                        keep[lo + row] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, out.schema)
    return out.drop(lower)


def op5_simhash_decontamination(spark, sf_dir) -> DataFrame:
    leaks = find_leaks(load_table(spark, sf_dir, "documents"),
                       load_table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"),
                        "word_start", "n_words")


QUERIES = {"op5_simhash_decontamination": op5_simhash_decontamination}
ORACLE: dict[str, str] = {}
