"""Operator 4: removal of repeated long byte strings with a threshold-bounded
Burrows-Wheeler transform.

Every byte covered by a ``LENGTH``-byte string that starts at another place
too, in the same or another document, is removed.

A Burrows-Wheeler transform of the whole corpus would be one huge sequential
object, so it is taken in parts that no repeated string crosses:

1. *Anchors.*  Every window of ``LENGTH`` bytes has an anchor, its smallest
   hashed ``CORE``-byte substring (the leftmost of equals), which depends on the
   window's bytes alone: equal windows have equal anchors at equal places.
   Consecutive windows with one anchor form a *segment*.
2. Segments whose anchor string occurs once in the corpus hold no repeated
   window and are left behind; equal segments (128-bit hash) are counted and
   one stands for all, being repeated throughout when there are two or more.
3. Segments that share an anchor string but are not equal go through the
   transform, a batch of whole anchor groups at a time (``marked_windows``).  The
   shared core is one symbol, so a window has ``LENGTH - core + 1`` symbols.
   Longest common prefixes of neighbouring suffixes are derived in increasing
   order by breadth-first backward extension of intervals, and the search stops
   at the window's number of symbols: boundaries still open then join suffixes
   with that many symbols in common, i.e. repeated windows.
4. An anchor group of more than ``GROUP`` different segments is not taken whole:
   its windows are dealt to finer groups by a longer core (``STEPS``), equal
   pieces counted first.  In the last step the core is the whole window, so equal
   windows are equal pieces and no group has more than one: any passage, however
   common, ends in bounded groups and the result is the same.

Defined cases: NULL is an empty text; texts shorter than ``LENGTH`` bytes are
kept; rows are documents of their own, so equal rows repeat each other; a NULL
doc_id is carried; an empty table gives an empty result; columns other than
doc_id and text are not read.  Strings are compared as UTF-8 bytes, so a kept text
need not be valid UTF-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkiln.llm import kernels as K
from sparkiln.llm.tables import load_table, materialize

LENGTH = 400
CORE = 128
GROUP = 2000
STEPS = (16, 1)  # windows per piece in groups that are too large
BATCH_SYMBOLS = 1_000_000
SEED_SYMBOLS = 12

SEGMENTS = ("h long, s1 long, s2 long, doc_id long, th long, lo int, hi int, a int")
PIECES = "c1 long, c2 long, left binary, right binary, s1 long, s2 long, off int, wins int"
_PLACE = np.uint64((1 << 20) - 1)
_CODES = (K.BYTE_CODE, K.stream(23, 256))


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def sliding_minimum(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values, from block prefixes and suffixes."""
    n = len(v) - w + 1
    blocks = np.concatenate([v, np.full(-len(v) % w, np.iinfo(v.dtype).max, v.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def anchored_segments(data: np.ndarray, offsets: np.ndarray, length: int, core: int
                      ) -> tuple[np.ndarray, ...]:
    """(row, h, s1, s2, first window, last window, anchor) of all segments;
    places count from the start of the row's text."""
    if len(data) < length:
        return tuple(np.empty(0, np.int64) for _ in range(7))
    prefix = [K.prefix_hash(data, c) for c in _CODES]
    h = K.window_hash(prefix[0], core)
    w = length - core + 1
    found = []
    step = (1 << 20) - w  # places within a stretch fit the low 20 bits
    for b in range(0, len(h) - w + 1, step):
        part = h[b:b + step + w - 1]
        keyed = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64)
        found.append((sliding_minimum(keyed, w) & _PLACE).astype(np.int64) + b)
    anchor = np.concatenate(found)  # of the window that starts at each place
    row = np.searchsorted(offsets, np.arange(len(anchor)), "right") - 1
    valid = np.arange(len(anchor)) + length <= offsets[row + 1]
    fresh = np.ones(len(anchor), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | ~valid[:-1]
    lo = np.flatnonzero(fresh & valid)
    ends = np.ones(len(anchor), bool)
    ends[:-1] = fresh[1:] | ~valid[1:]
    hi = np.flatnonzero(ends & valid)
    base = offsets[row[lo]]
    spans = [K.span_hash(p, lo, hi + length) for p in prefix]
    return (row[lo], h[anchor[lo]], *spans, lo - base, hi - base, anchor[lo] - base)


def segment_table(docs: DataFrame, length: int, core: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "s1", "s2", "doc_id", "th", "lo", "hi", "a"]
        for batch in batches:
            for first, _, data, offsets in K.text_chunks(batch.column("text")):
                row, h, s1, s2, lo, hi, a = anchored_segments(data, offsets, length, core)
                at = pa.array(row + first)
                yield pa.RecordBatch.from_arrays(
                    [_longs(h), _longs(s1), _longs(s2), batch.column("doc_id").take(at),
                     batch.column("th").take(at),
                     *[pa.array(x.astype(np.int32)) for x in (lo, hi, a)]], names=names)

    return docs.where(F.octet_length("text") >= length).select("doc_id", "th", "text").mapInArrow(
        run, SEGMENTS)


def cut_segment(raw: bytes, a: int, w_lo: int, w_hi: int, width: int, length: int
                ) -> list[tuple[bytes, bytes, bytes, int, int]]:
    """(core, left, right, first window, windows) of the pieces of a segment.

    Windows w_lo..w_hi (places in ``raw``, which has the anchor at ``a``) are
    dealt by their distance to the anchor, ``width`` distances to a piece; the
    core is what all windows of these distances have in common."""
    out = []
    for c in range((a - w_hi) // width, (a - w_lo) // width + 1):
        lo = max(w_lo, a - (c + 1) * width + 1)
        hi = min(w_hi, a - c * width)
        start = a - c * width
        end = start - width + 1 + length
        out.append((raw[start:end], raw[lo:start], raw[end:hi + length], lo, hi - lo + 1))
    return out


def core_name(core: bytes, distance: int) -> tuple[int, int]:
    """128 bits that name a core and its distance class."""
    digest = hashlib.blake2b(core, digest_size=16, salt=distance.to_bytes(8, "little")).digest()
    return (int.from_bytes(digest[:8], "little", signed=True),
            int.from_bytes(digest[8:], "little", signed=True))


def piece_rows(raw: bytes, a: int, w_lo: int, w_hi: int, s1: int, s2: int, width: int,
               length: int) -> Iterator[tuple]:
    for core, left, right, off, wins in cut_segment(raw, a, w_lo, w_hi, width, length):
        yield (*core_name(core, (a - off - wins + 1) // width), left, right, s1, s2, off, wins)


_PIECE_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(),
                pa.int32(), pa.int32()]
_PIECE_NAMES = ["c1", "c2", "left", "right", "s1", "s2", "off", "wins"]


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(_PIECE_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _PIECE_TYPES)],
                                      names=_PIECE_NAMES)


def cut_pieces(segments: DataFrame, width: int, length: int) -> DataFrame:
    """Pieces of segments given as raw, a, w_lo, w_hi, s1, s2."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512).to_pydict()
                yield _piece_batch([p for row in zip(*(part[c] for c in (
                    "raw", "a", "w_lo", "w_hi", "s1", "s2")))
                    for p in piece_rows(*row, width, length)])

    return segments.select("raw", "a", "w_lo", "w_hi", "s1", "s2").mapInArrow(run, PIECES)


def suffix_order(symbols: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array in order of the first ``depth`` symbols, which neighbours
    differ within the first ``seed``), by prefix doubling."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    h, early = 1, None
    while True:
        if h < depth and rank.max(initial=0) < n - 1:
            ahead = np.zeros(n, np.int64)
            ahead[:n - h] = rank[h:] + 1
            key = rank * (n + 1) + ahead
            order = np.argsort(key)
            sorted_key = key[order]
            change = np.concatenate([[False], sorted_key[1:] != sorted_key[:-1]])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(change)
            h *= 2
            if h <= seed:
                early = (rank.copy(), h)
        else:
            break
    order = np.argsort(rank, kind="stable")
    seen, at = early if early else (np.zeros(n, np.int64), 0)
    differ = np.concatenate([[True], seen[order[1:]] != seen[order[:-1]]])
    return order, differ, at


def open_boundaries(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and, for each place p in it, whether suffixes p-1 and p
    agree in ``depth`` symbols or more (symbol 0 ends a string).

    Interval of a string: the suffixes that start with it.  Its right
    boundary has a common prefix shorter than the string.  Extending the strings
    of the last round by each symbol that stands before them, round by round,
    gives every boundary its value the first time it is met, the smallest first.
    Strings hold no symbol 0 but as their last, as no window spans one.
    """
    n = len(symbols)
    sa, known, size = suffix_order(symbols, depth, min(SEED_SYMBOLS, depth))
    place = np.empty(n, np.int64)
    place[sa] = np.arange(n)
    before = symbols[sa - 1]  # the transform; the text's last symbol is 0
    step = place[sa - 1]
    left = np.flatnonzero(known)
    right = np.append(left[1:], n) - 1
    if size == 0:  # start from the empty string
        left, right = np.array([0]), np.array([n - 1])
        known = np.zeros(n, bool)
    known = np.append(known, True)
    while size < depth and len(left):
        sizes = right - left + 1
        group = np.repeat(np.arange(len(left)), sizes)
        at = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + left[group]
        use = before[at] > 0
        if size == 0:
            use |= True
        group, at = group[use], at[use]
        if not len(at):
            break
        to = step[at]
        order = np.argsort(group * n + to)
        group, to, symbol = group[order], to[order], before[at][order]
        first = np.ones(len(to), bool)
        first[1:] = (group[1:] != group[:-1]) | (symbol[1:] != symbol[:-1])
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(to)) - 1
        new = ~known[to[ends] + 1]
        if size == 0:
            new |= True  # the last interval borders the end
        left, right = to[starts][new], to[ends][new]
        known[right + 1] = True
        size += 1
    known[0] = True
    return sa, ~known[:n]


def marked_windows(groups: list[int], lefts: list[bytes], rights: list[bytes], wins: list[int],
                   width: int) -> list[np.ndarray]:
    """For each piece (left + core of its group + right), its windows, by
    place, that occur in another piece of the batch."""
    sizes = np.array([len(a) + len(b) + 2 for a, b in zip(lefts, rights)])
    base = np.concatenate([[0], np.cumsum(sizes)])
    symbols = np.zeros(base[-1], np.int64)
    for i, (g, a, b) in enumerate(zip(groups, lefts, rights)):
        p = base[i]
        symbols[p:p + len(a)] = np.frombuffer(a, np.uint8)
        symbols[p:p + len(a)] += 1
        symbols[p + len(a)] = 257 + g
        symbols[p + len(a) + 1:p + len(a) + 1 + len(b)] = np.frombuffer(b, np.uint8)
        symbols[p + len(a) + 1:p + len(a) + 1 + len(b)] += 1
    sa, open_ = open_boundaries(symbols, width)
    at = np.flatnonzero(open_)
    mark = np.zeros(len(symbols), bool)
    mark[sa[at]] = True
    mark[sa[at - 1]] = True
    return [np.flatnonzero(mark[base[i]:base[i] + wins[i]]) for i in range(len(groups))]


def _ranges(places: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive places as (first, last)."""
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.append(0, cuts + 1)].tolist(),
                    places[np.append(cuts, len(places) - 1)].tolist()))


def marked_ranges(pieces: DataFrame, width: int) -> DataFrame:
    """(c1, c2, left, right, lo, hi): repeated windows of distinct pieces, by
    place in the piece.  ``pieces`` has whole groups (c1, c2) per task, in
    order."""
    schema = "c1 long, c2 long, left binary, right binary, lo int, hi int"

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        names: dict[tuple[int, int], int] = {}
        groups = [names.setdefault(r[:2], len(names)) for r in rows]
        marked = marked_windows(groups, [r[2] for r in rows], [r[3] for r in rows],
                                [r[4] for r in rows], width) if rows else []
        out = [(*r[:4], lo, hi) for r, m in zip(rows, marked) for lo, hi in _ranges(m)]
        cols = list(zip(*out)) if out else [()] * 6
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=["c1", "c2", "left", "right", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, cut = 0, 0  # symbols held; where the last group begins
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist()
                             for c in ("c1", "c2", "left", "right", "wins"))):
                if held and row[:2] != held[-1][:2]:
                    cut = len(held)
                    if size >= BATCH_SYMBOLS:
                        yield solve(held)
                        held, size, cut = [], 0, 0
                held.append(row)
                size += len(row[2]) + len(row[3]) + 2
        yield solve(held)

    return pieces.select("c1", "c2", "left", "right", "wins").mapInArrow(run, schema)


def repeated_windows(segments: DataFrame, width: int, length: int, group: int = GROUP
                     ) -> DataFrame:
    """(s1, s2, lo, hi): windows, by place in the segment, that occur in another
    of the distinct ``segments`` (raw, a, w_lo, w_hi, s1, s2)."""
    out, widths = None, [width, *[s for s in STEPS if s < width]]
    content = ["c1", "c2", "left", "right"]
    for w in widths:
        pieces = materialize(cut_pieces(segments, w, length), "pieces")
        distinct = pieces.groupBy(*content).agg(F.count(F.lit(1)).alias("n"),
                                                F.min("wins").alias("wins"))
        sizes = distinct.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("m"))
        distinct = materialize(distinct.join(sizes, ["c1", "c2"]), "distinct")
        same = distinct.where("n > 1").select(
            *content, F.lit(0).alias("lo"), (F.col("wins") - 1).alias("hi"))
        few = (distinct.where((F.col("m") > 1) & (F.col("m") <= group))
               .repartition("c1", "c2").sortWithinPartitions("c1", "c2"))
        marks = same.unionByName(marked_ranges(few, w)) if w > 1 else same
        found = pieces.join(materialize(marks, "marks"), content).select(
            "s1", "s2", (F.col("off") + F.col("lo")).alias("lo"),
            (F.col("off") + F.col("hi")).alias("hi"))
        out = found if out is None else out.unionByName(found)
        if w == 1:
            break
        many = distinct.where(F.col("m") > group).select("c1", "c2").distinct()
        crowded = materialize(pieces.join(many, ["c1", "c2"]).select("s1", "s2", "off", "wins"),
                              "crowded")
        if crowded.isEmpty():
            break
        segments = crowded.join(segments.drop("w_lo", "w_hi"), ["s1", "s2"]).select(
            "raw", "a", F.col("off").alias("w_lo"),
            (F.col("off") + F.col("wins") - 1).alias("w_hi"), "s1", "s2")
    return out


def dedup_substrings(docs: DataFrame, length: int = LENGTH, core: int = CORE,
                     group: int = GROUP, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the
    remaining bytes, if ``with_text``)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        "doc_id", F.xxhash64("text").alias("th"), "text")
    key = ["doc_id", "th"]
    every = materialize(segment_table(docs, length, core), "segments")
    # written on its own: a join right on the aggregate could not be split at a hot anchor
    shared = materialize(every.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                         .select("h"), "repeated")
    cand = materialize(every.join(shared, "h"), "shared")
    place = F.struct(*key, "lo", "hi", "a")
    distinct = cand.groupBy("h", "s1", "s2").agg(F.count(F.lit(1)).alias("n"),
                                                 F.min(place).alias("at"))
    distinct = materialize(distinct.select("h", "s1", "s2", "n", "at.*"), "distinct")
    varied = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("h")
    wanted = distinct.join(varied, "h").groupBy(*key).agg(F.collect_list(
        F.struct("s1", "s2", "lo", "hi", "a")).alias("wanted"))

    # one pass over the texts: those with shared anchors go on, others are done
    touched = cand.select(*key).distinct().join(
        wanted.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "wanted"),
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), "left")
    touched = touched.select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"), "wanted")
    joined = docs.join(touched, F.col("doc_id").eqNullSafe(F.col("_doc"))
                       & (F.col("th") == F.col("_th")), "left")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    open_ = F.col("_th").isNotNull()
    texts = materialize(joined.select(
        *key, open_.alias("open"), F.octet_length(raw).cast("long").alias("n_bytes"),
        F.when(~open_, F.sha2(raw, 256)).alias("sha"),
        F.when(open_ | F.lit(with_text), raw).alias("raw"), "wanted"), "texts")

    segments = texts.where("wanted IS NOT NULL").select("raw", F.explode("wanted").alias("s")).select(
        F.substring("raw", F.col("s.lo") + 1, F.col("s.hi") - F.col("s.lo") + length).alias("raw"),
        (F.col("s.a") - F.col("s.lo")).alias("a"), F.lit(0).alias("w_lo"),
        (F.col("s.hi") - F.col("s.lo")).alias("w_hi"), "s.s1", "s.s2")
    found = repeated_windows(segments, length - core + 1, length, group)
    found = found.unionByName(distinct.where("n > 1").select(
        "s1", "s2", F.lit(0).alias("lo"), (F.col("hi") - F.col("lo")).alias("hi")))
    found = materialize(found.groupBy("s1", "s2").agg(
        F.collect_set(F.struct("lo", "hi")).alias("marks")), "found")
    spans = (cand.join(found, ["s1", "s2"])
             .select(*key, "lo", F.explode("marks").alias("mark"))
             .groupBy(*key).agg(F.collect_list(F.struct(
                 (F.col("lo") + F.col("mark.lo")).alias("a"),
                 (F.col("lo") + F.col("mark.hi") + length).alias("b"))).alias("spans")))
    spans = spans.select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"), "spans")
    closed = texts.where("NOT open").select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"),
        *([F.col("raw").alias("kept")] if with_text else []))
    rest = texts.where("open").join(spans, F.col("doc_id").eqNullSafe(F.col("_doc"))
                                    & (F.col("th") == F.col("_th")), "left")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [without(raw.as_py(), spans) for raw, spans in
                    zip(batch.column("raw"), batch.column("spans").to_pylist())]
            cols = [batch.column("doc_id"), batch.column("n_bytes"),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols.append(pa.array([r[2] for r in rows], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return closed.unionByName(rest.select("doc_id", "n_bytes", "raw", "spans").mapInArrow(
        remove, schema + (", kept binary" if with_text else "")))


def without(raw: bytes, spans: list[dict] | None) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs removed, bytes that stay)."""
    runs: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    kept, last = [], 0
    for a, b in runs:
        kept.append(raw[last:a])
        last = b
    kept.append(raw[last:])
    return sum(b - a for a, b in runs), len(runs), b"".join(kept)


def op4_bwt_substring_dedup(spark, sf_dir) -> DataFrame:
    return dedup_substrings(load_table(spark, sf_dir, "documents"))


QUERIES = {"op4_bwt_substring_dedup": op4_bwt_substring_dedup}
ORACLE: dict[str, str] = {}
