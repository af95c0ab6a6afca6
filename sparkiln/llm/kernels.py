"""Array helpers for texts inside a task: word spans, word hashes, shingles.

Everything works on a batch of texts laid end to end as UTF-8 bytes, so the
cost per byte is a handful of numpy passes and no Python object is made per
word.  Batches are cut to a byte budget (``text_chunks``), which bounds memory
whatever the row count of an Arrow batch; a single longer text is a batch of
its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
CHUNK_BYTES = 1 << 20


def splitmix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer (splitmix64 finaliser)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` reproducible 64-bit numbers."""
    return splitmix(np.arange(n, dtype=np.uint64) + np.uint64((seed * 0x100000001B3) & MASK))


_BASE = 0x9E6C63D0876A9A47 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
BYTE_CODE = stream(17, 256)


class _Powers:
    """Powers of the rolling-hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                steps = np.full(size, base & MASK, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``max_bytes``: (first
    row, end row, bytes, offsets of rows in the bytes).  NULL is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def prefix_hash(data: np.ndarray, codes: np.ndarray = BYTE_CODE) -> np.ndarray:
    """Prefix sums of the rolling hash; ``span_hash`` reads spans off it."""
    up, _ = _POWERS.get(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * up[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every span [start, end); equal bytes give equal hashes."""
    _, down = _POWERS.get(len(prefix))
    return splitmix((prefix[end] - prefix[start]) * down[start]
                    + (end - start).astype(np.uint64))


def window_hash(prefix: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes at every position that has so many."""
    _, down = _POWERS.get(len(prefix))
    n = len(prefix) - width
    return splitmix((prefix[width:] - prefix[:n]) * down[:n])


def separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: ``[^\x20\x09-\x0D]+``
SPACE = separators(b" \t\n\x0b\f\r")
#: every ASCII byte that is neither a letter nor a digit
PUNCT = separators(bytes(b for b in range(128) if not chr(b).isalnum()))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the words of every text: (start, end, first word of each text
    with the total appended).  Words never cross texts."""
    inside = ~breaks[data]
    n = len(data)
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0] = after[-1] = False
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
        edges = offsets[(offsets > 0) & (offsets < n)]
        before[edges] = False
        after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word windows of every text, in order, and the first
    window of each text (total appended).  A text with fewer words has its
    whole sequence as its one window; one without words has none."""
    n_words = np.diff(first)
    count = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    out_first = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(n_words)), count)
    at = np.arange(out_first[-1]) - out_first[doc] + first[doc]
    have = np.minimum(n_words[doc], k)
    acc = np.zeros(len(at), np.uint64)
    for j in range(k):
        step = acc * np.uint64(0xD6E8FEB86659FD93) + h[np.minimum(at + j, max(len(h) - 1, 0))]
        acc = np.where(j < have, step, acc)
    return splitmix(acc + have.astype(np.uint64)), out_first


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every text and their first positions."""
    out = [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:])]
    sizes = np.fromiter((len(x) for x in out), np.int64, len(out))
    flat = np.concatenate(out) if out else values[:0]
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def reduce_spans(ufunc: np.ufunc, values: np.ndarray, first: np.ndarray, empty) -> np.ndarray:
    """``ufunc`` over the values of every text; ``empty`` where it has none."""
    out = np.full(len(first) - 1, empty, values.dtype)
    has = np.flatnonzero(np.diff(first) > 0)
    if len(has):
        out[has] = ufunc.reduceat(values, first[:-1][has])
    return out


def long_lists(flat: np.ndarray, first: np.ndarray) -> pa.Array:
    """Arrow list<int64> column from flat values and list bounds."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)),
                                    pa.array(flat.view(np.int64) if flat.dtype == np.uint64
                                             else flat.astype(np.int64)))


def word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray
               ) -> tuple[np.ndarray, pa.Array]:
    """A number for every word (spans in order, not overlapping), and the distinct
    words that the numbers stand for.  Words are compared as they are, not by hashes."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    words_ = pa.LargeStringArray.from_buffers(
        len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at])))
    coded = words_.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary
