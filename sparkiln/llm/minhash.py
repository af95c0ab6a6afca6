"""Operator 9: MinHash near-duplicates verified through odd sketches.

1. *Sketch* (one Arrow pass over whole texts): lower-cased words, the set of
   distinct k-word shingle hashes, its MinHash samples, the samples' banded
   keys, and an odd sketch: every sample (i, minimum) flips one bit of a parity
   bitmap, so the population count of two bitmaps' XOR estimates how many
   samples differ, precisely where few do.  A second bitmap takes the parities of
   the whole set instead of its samples: two of them differ in at most as many bits
   as the sets in shingles, so a pair that differs in more than the threshold allows
   for their sizes is surely no link, and no candidate either.
2. *Classes*: texts with equal sets are one class; its smallest doc_id stands
   for it, so thousands of copies cost one row from here on.
3. *Stars*: in every band bucket each member is a candidate of ``HUBS`` members
   only, the hubs, which needs no pairs within the bucket.  Candidates pass the
   odd-sketch estimate, then the exact test on full sets, and the links make
   components.
4. *Closure*: what is left are buckets with members in several components.  Those
   of more than ``BLOCK`` members (texts that share a long passage, say) are dealt
   anew: their members get ``FINE_BANDS`` bands of ``FINE_ROWS`` rows and an odd
   sketch of all these samples, which tell similarities apart more sharply, and
   stars of their own.  In the buckets that
   then are still open, every member outside the largest component is compared
   with all members of other components by their odd sketches, in groups of about
   ``BLOCK`` of one and ``BLOCK`` of the other, and only pairs that pass
   leave the group, each from the first bucket that it shares.  Buckets with the same
   largest component are a family; where its distinct members make fewer pairs than its
   buckets one by one (near copies meet in most of their bands), the family is compared
   as one bucket in groups of about ``FAMILY``, and sketches are sent once, not once a band.
   So no pair that shares a bucket goes untested unless its
   members are connected already, and no task ever holds a whole bucket.
5. Components of the verified links, spread to all class members.

With ``rows_per_band`` 4 and 30 bands, a pair at similarity 0.85 shares no
bucket with probability 2.4e-10 (0.8: 1.3e-7), with 120 fine bands of 8 rows
2.9e-17 (0.8: 3.4e-10).  The sketch limit lies more than 4.5 standard deviations
of the MinHash estimate below the threshold.

Defined cases: NULL texts and texts without words have empty sets and link with
nothing; fewer than k words are one shingle; rows that share a doc_id are one
node, with the links of each; a row with a NULL doc_id is compared with
nothing, has a NULL component and is kept; an empty table gives an empty
result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkiln.llm import kernels as K
from sparkiln.llm.components import components
from sparkiln.llm.tables import load_table, materialize

BANDS = 30
ROWS_PER_BAND = 4
FINE_BANDS = 120
FINE_ROWS = 8
SKETCH_BITS = 512
FINE_BITS = 4096
PARITY_BITS = 1024  # of whole sets
HUBS = 2  # members of a bucket that all others are compared with
BLOCK = 256  # members of a bucket compared in one go
FAMILY = 1024  # members of a family compared in one go
PAIRS_AT_ONCE = 50_000
SIEVE_BITS = 1 << 26  # 8 MB
SIEVE_IDS = 1 << 24  # more of them fill too many of the sieve's bits

SKETCH = ("doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, "
          "sketch array<long>, parity array<long>")
SETS = "doc_id long, set_a long, set_b long, hashes array<long>"


@lru_cache(maxsize=2)
def _functions(n: int) -> np.ndarray:
    return K.stream(99, n) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text and their bounds."""
    data = K.LOWER[data]
    start, end, first = K.words(data, offsets)
    h = K.span_hash(K.prefix_hash(data), start, end)
    return K.distinct(*K.shingles(h, first, k))


def band_keys(sets: np.ndarray, first: np.ndarray, bands: int, rows: int
              ) -> tuple[np.ndarray, np.ndarray]:
    """MinHash samples (texts x samples) and band keys (texts x bands)."""
    n = len(first) - 1
    minima = np.empty((n, bands * rows), np.uint64)
    for i, a in enumerate(_functions(bands * rows)):
        minima[:, i] = K.reduce_spans(np.minimum, sets * a, first, np.uint64(K.MASK))
    keys = np.zeros((n, bands), np.uint64)
    by_band = minima.reshape(n, bands, rows)
    for r in range(rows):
        keys = K.splitmix(keys ^ by_band[:, :, r])
    return minima, K.splitmix(keys + np.arange(bands, dtype=np.uint64))


def sketches(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (texts x bands) and odd sketches (texts x bytes)."""
    minima, keys = band_keys(sets, first, BANDS, ROWS_PER_BAND)
    return keys, odd_sketch(minima, SKETCH_BITS)


def odd_sketch(minima: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps (texts x bytes): every sample flips the bit it hashes to."""
    n, samples = minima.shape
    bit = K.splitmix(minima + np.arange(samples, dtype=np.uint64)) % np.uint64(bits)
    flips = np.zeros((n, bits), np.uint8)
    for i in range(samples):
        flips[np.arange(n), bit[:, i].astype(np.int64)] ^= 1
    return np.packbits(flips, axis=1)


def set_parity(sets: np.ndarray, first: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps (texts x bytes) of whole sets: every member flips a bit.  Two
    of them differ in no more bits than the sets have members that are not shared."""
    bit = (K.splitmix(~sets) % np.uint64(bits)).astype(np.int64)
    out = np.zeros((len(first) - 1, bits // 8), np.uint8)
    for lo in range(0, len(out), 128):
        bounds = first[lo:lo + 129]
        n = len(bounds) - 1
        own = np.repeat(np.arange(n) * bits, np.diff(bounds))
        flips = np.bincount(own + bit[bounds[0]:bounds[-1]], minlength=n * bits) & 1
        out[lo:lo + n] = np.packbits(flips.astype(np.uint8).reshape(n, bits), axis=1)
    return out


def sketch_limit(threshold: float, samples: int = BANDS * ROWS_PER_BAND,
                 bits: int = SKETCH_BITS) -> int:
    """Largest XOR count that still is a candidate: the count expected at a
    similarity ``4.7`` standard deviations of the estimate below the
    threshold, and a margin for bits that share a flip."""
    low = threshold - 4.7 * float(np.sqrt(threshold * (1 - threshold) / samples))
    flips = 2 * samples * (1 - low)
    expected = bits / 2 * (1 - np.exp(-2 * flips / bits))
    return int(np.ceil(expected + 1.1 * np.sqrt(bits / 4 * (1 - np.exp(-4 * flips / bits)))))


def set_names(sets: np.ndarray, first: np.ndarray) -> list[pa.Array]:
    """128 bits that name a set: a sum and an XOR of its mixed hashes."""
    mixed = K.splitmix(sets ^ np.uint64(0x5DEECE66D))
    zero = np.uint64(0)
    return [pa.array(K.reduce_spans(np.add, mixed, first, zero).view(np.int64)),
            pa.array(K.reduce_spans(np.bitwise_xor, K.splitmix(mixed), first, zero)
                     .view(np.int64))]


def _rows(table: np.ndarray) -> pa.Array:
    """List column with a list per row of a 2-D array of longs."""
    bounds = np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(table.ravel().view(np.int64)))


def sketch_documents(docs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in K.text_chunks(batch.column("text")):
                sets, first = shingle_sets(data, offsets, k)
                keys, bits = sketches(sets, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(first)),
                     *set_names(sets, first), _rows(keys), _rows(bits.view(np.uint64)),
                     _rows(set_parity(sets, first, PARITY_BITS).view(np.uint64))],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch", "parity"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SKETCH)


def set_table(docs: DataFrame, k: int, cells: Broadcast | None = None) -> DataFrame:
    """Full shingle sets of a table of documents, with their names; with the ``cells`` of
    a sieve, of the documents that pass it.  The worker that sifts a batch also makes its
    sets, so that a task holds its texts in one Python process."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if cells is not None:
                batch = sifted(batch, cells.value)
            for lo, hi, data, offsets in K.text_chunks(batch.column("text")):
                sets, first = shingle_sets(data, offsets, k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), *set_names(sets, first),
                     K.long_lists(sets, first)], names=["doc_id", "set_a", "set_b", "hashes"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (docs if cells is None else with_bit(docs)).mapInArrow(run, SETS)


def odd_distance(a, b) -> Column:
    """Bits in which two odd sketches differ."""
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda n, x: n + x)


def may_link(bits, total, percent: int):
    """Whether sets of ``total`` members in all, whose parity bitmaps differ in
    ``bits``, can be as similar as ``percent``; numbers, arrays or columns."""
    return bits * (100 + percent) <= total * (100 - percent)


def near_pairs(group: np.ndarray, side: np.ndarray, node: np.ndarray, component: np.ndarray,
               sketch: np.ndarray, parity: np.ndarray, size: np.ndarray, band: np.ndarray,
               whole: np.ndarray, bands: np.ndarray, limit: int, percent: int
               ) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a side-0 and a side-1 row of the same group (numbered from 0, in
    order) that lie in different components, pass the sketch tests and share one of
    their ``bands``, in groups that are not ``whole`` families the group's ``band``
    and no earlier one."""
    zero, one = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    first = np.searchsorted(group[one], np.arange(group[-1] + 2)) if len(group) else one
    out = []
    sizes = (first[group[zero] + 1] - first[group[zero]]) if len(zero) else zero
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(zero):  # about PAIRS_AT_ONCE pairs at a time
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - sizes[lo] + PAIRS_AT_ONCE, "right")))
        n = sizes[lo:hi]
        x = np.repeat(zero[lo:hi], n)
        y = one[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                + np.repeat(first[group[zero[lo:hi]]], n)]
        apart = component[x] != component[y]
        x, y = x[apart], y[apart]
        away = np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1, dtype=np.int64)
        x, y = x[away <= limit], y[away <= limit]
        apart = np.bitwise_count(parity[x] ^ parity[y]).sum(axis=1, dtype=np.int64)
        close = may_link(apart, size[x] + size[y], percent)
        x, y = x[close], y[close]
        shared = bands[x] == bands[y]
        own = bands[x, shared.argmax(axis=1)] == band[x]
        here = np.where(whole[x], shared.any(axis=1), own)
        out.append((node[x[here]], node[y[here]]))
        lo = hi
    if not out:
        return node[:0], node[:0]
    a, b = (np.concatenate(z) for z in zip(*out))
    return np.maximum(a, b), np.minimum(a, b)


def _block_pairs(limit: int, percent: int):
    """``near_pairs`` over rows in order of (band, i, j), whole groups at a time."""
    def solve(table: pa.Table) -> pa.RecordBatch:
        keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("band", "i", "j")])
        fresh = np.concatenate([[0], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]).astype(np.int64)
        rows = table.num_rows
        sketch, parity, bands = (
            table.column(c).combine_chunks().flatten().to_numpy().reshape(rows, -1)
            for c in ("sketch", "parity", "bands"))
        a, b = near_pairs(np.cumsum(fresh), table.column("side").to_numpy(),
                          table.column("node").to_numpy(), table.column("component").to_numpy(),
                          sketch.view(np.uint64), parity.view(np.uint64),
                          table.column("n_shingles").to_numpy(), keys[0], keys[1] < 0, bands,
                          limit, percent)
        pairs = np.unique(np.stack([a, b], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                                          names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows of a group that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            key = [held.column(c).to_numpy() for c in ("band", "i", "j")]
            last = np.logical_and.reduce([k == k[-1] for k in key])
            cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            if cut:
                yield solve(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None:
            yield solve(held)
    return run


def id_sieve(ids: DataFrame) -> np.ndarray:
    """Fixed number of bits, made by the tasks cell by cell, that tell which doc_ids
    may be among the given ones: a false hit is removed by a join, a miss cannot occur."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(SIEVE_BITS))
    made = (ids.select(F.shiftright(bit, 6).alias("cell"),
                       F.expr("shiftleft(1L, int(pmod(xxhash64(doc_id), 64)))").alias("held"))
            .groupBy("cell").agg(F.bit_or("held").alias("held")).toArrow())
    cells = np.zeros(SIEVE_BITS >> 6, np.int64)
    cells[made.column("cell").to_numpy()] = made.column("held").to_numpy()
    return cells


def with_bit(docs: DataFrame) -> DataFrame:
    """The rows that have a doc_id, with the bit of the sieve that it is tested by."""
    return docs.where("doc_id IS NOT NULL").select(
        "doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(SIEVE_BITS)).alias("bit"))


def sifted(batch: pa.RecordBatch, cells: np.ndarray) -> pa.RecordBatch:
    """The rows of a batch whose ``bit`` is set in a sieve."""
    bit = batch.column("bit").to_numpy()
    return batch.filter(pa.array((cells[bit >> 6] >> (bit & 63)) & 1 == 1))


def sets_among(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """Sets of the rows of ``docs`` whose doc_id is one of ``ids`` and, up to ``SIEVE_IDS``
    ids, few others: those are found by a sieve as the texts are scanned, so that no
    text is shuffled.  More ids than a sieve tells apart are joined."""
    if ids.count() > SIEVE_IDS:
        return set_table(docs.join(ids.distinct(), "doc_id", "left_semi"), k)
    return set_table(docs, k, docs.sparkSession.sparkContext.broadcast(id_sieve(ids)))


def candidate_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, k: int
                   ) -> tuple[DataFrame, DataFrame]:
    """(row, hashes): full shingle sets, written as the texts are scanned, and
    (node, row): the row that holds the set of a class."""
    wanted = materialize(nodes.distinct().join(
        classes.select("node", F.col("rep").alias("doc_id"), "set_a", "set_b"), "node"), "wanted")
    # numbered as written, so the numbers are fixed
    sets = materialize(sets_among(docs, wanted.select("doc_id"), k).withColumn(
        "row", F.monotonically_increasing_id()), "sets")
    rows = materialize(sets.drop("hashes").join(wanted, ["doc_id", "set_a", "set_b"]).groupBy(
        "node").agg(F.min("row").alias("row")), "set_rows")
    return sets.select("row", "hashes"), rows


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int
             ) -> DataFrame:
    """Of pairs (a, b) of classes, those whose full sets are similar enough."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(
        pairs.select(F.col("b").alias("node")))
    sets, rows = candidate_sets(nodes, classes, docs, k)
    placed = pairs.join(rows.toDF("a", "row_a"), "a").join(rows.toDF("b", "row_b"), "b")
    both = (placed.join(sets.toDF("row_a", "left"), "row_a")
            .join(sets.toDF("row_b", "right"), "row_b").select(
        "a", "b", F.size(F.array_intersect("left", "right")).alias("shared"),
        (F.size("left") + F.size("right")).alias("total")))
    return both.where(100 * F.col("shared") >= percent * (F.col("total") - F.col("shared"))
                      ).select("a", "b")


def placed_in(buckets: DataFrame, found: DataFrame | None) -> DataFrame:
    """band, node and the node's component so far."""
    if found is None:
        return buckets.withColumn("component", F.col("node"))
    return buckets.join(found, "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("component"))


def star_pairs(placed: DataFrame, marks: DataFrame, limit: int, percent: int) -> DataFrame:
    """(member, hub of its bucket) pairs of different components that pass the
    sketch tests; the hubs of a bucket are drawn by hash."""
    def drawn(turn: int):
        return F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "component"))

    hubs = (placed.groupBy("band").agg(
        F.array(*[drawn(t) for t in range(HUBS)]).alias("hubs"),
        F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low != high").select("band", F.explode(F.array_distinct("hubs")).alias("hub"))
        .select("band", "hub.node", "hub.component").toDF("band", "b", "of"))
    pairs = (placed.join(hubs, "band").where("component != of")
             .select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct())
    sketch = marks.select("node", "sketch", "parity", "n_shingles")
    both = (pairs.join(sketch.toDF("a", "left", "left_set", "left_n"), "a")
            .join(sketch.toDF("b", "right", "right_set", "right_n"), "b"))
    return both.where(odd_distance("left", "right") <= limit).where(may_link(
        odd_distance("left_set", "right_set"), F.col("left_n") + F.col("right_n"), percent)
    ).select("a", "b")


def families(open_: DataFrame, members: DataFrame) -> DataFrame:
    """(top, all, out): the families, buckets with the same largest component ``top``,
    whose distinct members are fewer pairs than those of their buckets one by one."""
    of_family = members.groupBy("top").agg(
        F.count(F.lit(1)).alias("all"), F.count_if(F.col("component") != F.col("top")).alias("out"))
    of_buckets = open_.groupBy("top").agg(F.sum(F.col("all") * F.col("out")).alias("apart"))
    return of_family.join(of_buckets, "top").where("all * out <= apart").select(
        "top", "all", "out")


def closure_pairs(placed: DataFrame, marks: DataFrame, limit: int, percent: int) -> DataFrame:
    """Cross-component pairs that share a bucket and pass the sketch tests.  In a
    bucket of two the star was the only pair."""
    parts = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    open_ = materialize(parts.groupBy("band").agg(
        F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("top"))
        .where("all > top.n AND all > 2").select(
            "band", F.col("top.component").alias("top"), "all",
            (F.col("all") - F.col("top.n")).alias("out")), "open")
    in_family = materialize(placed.join(open_, "band").select("top", "node", "component").distinct(),
                            "family")
    whole = materialize(families(open_, in_family), "families")

    def blocks(size: int) -> list[Column]:
        return [F.ceil(F.col("all") / size).cast("int").alias("blocks"),
                F.ceil(F.col("out") / size).cast("int").alias("few")]

    group = ["band", "top", "node", "component", "whole"]
    by_family = in_family.join(whole, "top").withColumns(
        {"band": F.col("top"), "whole": F.lit(True)}).select(*group, *blocks(FAMILY))
    by_bucket = placed.join(open_.join(whole.select("top"), "top", "left_anti"), "band").withColumn(
        "whole", F.lit(False)).select(*group, *blocks(BLOCK))
    sketch = ["sketch", "parity", "n_shingles", "bands"]
    members = by_family.unionByName(by_bucket).join(marks.select("node", *sketch), "node")
    h = F.xxhash64("node")
    cols = ["band", "node", "component", *sketch]

    # all members, met by each block of those outside the largest component
    every = members.select(*cols, "whole", F.explode(F.sequence(F.lit(0), F.col("few") - 1)).alias("i"),
                           F.pmod(h, F.col("blocks")).cast("int").alias("j"))
    away = members.where("component != top").select(
        *cols, "whole", F.pmod(h, F.col("few")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    order = ["band", "i", "j"]
    both = every.withColumn("side", F.lit(1)).unionByName(away.withColumn("side", F.lit(0)))
    # the blocks of a family are numbered from -1 down
    numbered = both.withColumn("i", F.when(F.col("whole"), -1 - F.col("i")).otherwise(F.col("i")))
    sent = numbered.drop("whole").repartition(*order).sortWithinPartitions(*order)
    return sent.mapInArrow(_block_pairs(limit, percent), "a long, b long").distinct()


def fine_marks(nodes: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """node, fine bands and fine bitmaps of classes in crowded buckets, written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                lists = [np.asarray(x.values).view(np.uint64) for x in part.column("hashes")]
                first = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
                minima, keys = band_keys(np.concatenate(lists), first, FINE_BANDS, FINE_ROWS)
                bits = odd_sketch(minima, FINE_BITS).view(np.uint64)
                parity = set_parity(np.concatenate(lists), first, FINE_BITS).view(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(np.diff(first)), _rows(keys), _rows(bits),
                     _rows(parity)],
                    names=["node", "n_shingles", "bands", "sketch", "parity"])

    sets, rows = candidate_sets(nodes, classes, docs, k)
    return materialize(rows.join(sets, "row").select("node", "hashes").mapInArrow(
        run, "node long, n_shingles long, bands array<long>, sketch array<long>, "
        "parity array<long>"), "fine")


def shared_buckets(banded: DataFrame) -> DataFrame:
    """(band, node) of the buckets with several members, written."""
    several = (banded.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"))
               .where("low != high").select("band"))
    return materialize(banded.join(several, "band").select("band", "node"), "buckets")


class Linker:
    """Links found so far and the components they make."""

    def __init__(self, classes: DataFrame, docs: DataFrame, links: DataFrame, k: int,
                 percent: int) -> None:
        self.classes, self.docs, self.k, self.percent = classes, docs, k, percent
        self.links, self.found = links, None
        self.limit = sketch_limit(percent / 100)

    def add(self, pairs: DataFrame) -> None:
        """Verify candidate pairs and link what holds."""
        pairs = materialize(pairs, "pairs")
        if not pairs.isEmpty():
            self.links = self.links.unionByName(materialize(verified(
                pairs, self.classes, self.docs, self.k, self.percent), "verified"))
        elif self.found is not None:
            return
        self.found = components(self.links)


def link_classes(classes: DataFrame, docs: DataFrame, same: DataFrame, k: int, percent: int
                 ) -> DataFrame:
    """(node, component) of the classes that are linked to others."""
    buckets = shared_buckets(classes.select("node", F.explode("bands").alias("band")))
    linker = Linker(classes, docs, same, k, percent)
    linker.add(star_pairs(placed_in(buckets, None), classes, linker.limit, percent))
    placed = placed_in(buckets, linker.found)
    open_ = materialize(placed.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("low"),
        F.max("component").alias("high")).where("low != high AND n > 2").select("band", "n"), "open")
    left = buckets.join(open_.where(F.col("n") <= BLOCK).select("band"), "band")
    crowded = open_.where(F.col("n") > BLOCK)
    if not crowded.isEmpty():
        nodes = materialize(buckets.join(crowded.select("band"), "band").select("node").distinct(),
                            "crowded")
        fine = fine_marks(nodes, classes, docs, k)
        again = shared_buckets(fine.select("node", F.explode("bands").alias("band")))
        limit = sketch_limit(percent / 100, FINE_BANDS * FINE_ROWS, FINE_BITS)
        linker.add(star_pairs(placed_in(again, linker.found), fine, limit, percent))
        rest = closure_pairs(placed_in(again, linker.found), fine, limit, percent)
    else:
        rest = None
    pairs = closure_pairs(placed_in(left, linker.found), classes, linker.limit, percent)
    linker.add(pairs if rest is None else pairs.unionByName(rest).distinct())
    return linker.found


def link_documents(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents linked where 100 *
    intersection >= percent * union of their k-word shingle sets."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = materialize(sketch_documents(docs, k), "sketches")
    named = marks.where("doc_id IS NOT NULL AND n_shingles > 0")
    name = ["set_a", "set_b", "n_shingles"]
    # numbered as written, so the numbers are fixed
    classes = materialize(named.groupBy(*name).agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"), F.first("parity").alias("parity"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    members = materialize(named.select("doc_id", *name).join(
        classes.select(*name, "node"), name).select("doc_id", "n_shingles", "node"), "members")
    # classes that share a doc_id are one document
    shared = members.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("top")
                                           ).where("b != top").select("doc_id", "b")
    same = materialize(members.join(shared, "doc_id").select(F.col("node").alias("a"), "b"), "same")
    found = link_classes(classes, docs, same, k, percent)

    placed = classes.select("node", "rep").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    lowest = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_node = placed.join(lowest, "component").select("node", "component_id")
    out = members.join(of_node, "node").select("doc_id", "n_shingles", "component_id")
    alone = marks.where("doc_id IS NULL OR n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The rows of ``docs`` (all their columns) but for one of each group of
    linked rows.  Rows are linked one by one, whatever their doc_id: the row with
    the smallest doc_id stays, NULL being the last, and of rows that share it the
    one with the smallest hash of its text."""
    row = "_row"
    while row in docs.columns:
        row = "_" + row
    # numbered as written, so the numbers are fixed
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    linked = link_documents(rows.select(F.col(row).alias("doc_id"), "text"), k, percent).select(
        F.col("doc_id").alias("_linked"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.col(row).alias("row"))
    placed = rows.select(row, order.alias("place")).join(linked, F.col(row) == F.col("_linked"))
    first = placed.groupBy("component_id").agg(F.min("place").alias("place")).select(
        F.col("place.row").alias(row))
    return rows.join(first, row, "left_semi").drop(row)


def op9_minhash_odd_sketch(spark, sf_dir) -> DataFrame:
    return link_documents(load_table(spark, sf_dir, "documents"), k=3, percent=85)


QUERIES = {"op9_minhash_odd_sketch": op9_minhash_odd_sketch}
ORACLE: dict[str, str] = {}
