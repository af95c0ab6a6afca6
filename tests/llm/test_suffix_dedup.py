import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sparkiln.llm import suffix_dedup as S
from llm_fixtures import documents  # noqa: F401


def brute(rows, length):
    raws = [(d, (t or "").encode()) for d, t in rows]
    counts = Counter(r[i:i + length] for _, r in raws for i in range(len(r) - length + 1))
    out = []
    for d, r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if counts[r[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((d, len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=repr)


def naive_open(symbols, depth):
    n = len(symbols)
    text = symbols.tolist()

    def key(i):
        return text[i:i + depth]
    order = sorted(range(n), key=key)
    return {frozenset((a, b)) for a, b in zip(order, order[1:])
            if key(a) == key(b) and len(key(a)) == depth and 0 not in key(a)}


@pytest.mark.parametrize("seed", range(25))
def test_open_boundaries_are_the_long_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    depth = int(rng.integers(1, 40))
    base = rng.integers(1, 4, 30)
    parts = []
    for _ in range(int(rng.integers(1, 12))):
        part = base.copy() if rng.random() < 0.7 else rng.integers(1, 4, 30)
        part[rng.integers(0, 30, 2)] = rng.integers(1, 5)
        parts += [*part[:rng.integers(1, 31)].tolist(), 0]
    symbols = np.array(parts, np.int64)
    sa, open_ = S.open_boundaries(symbols, depth)
    assert sorted(sa.tolist()) == list(range(len(symbols)))
    got = set()
    for p in np.flatnonzero(open_):
        for i in (sa[p - 1], sa[p]):
            if i + depth <= len(symbols) and 0 not in symbols[i:i + depth]:
                got.add(int(i))
    counts = Counter(tuple(symbols[i:i + depth]) for i in range(len(symbols) - depth + 1))
    want = {i for i in range(len(symbols) - depth + 1)
            if 0 not in symbols[i:i + depth] and counts[tuple(symbols[i:i + depth])] > 1}
    assert got == want


def corpus(rng, length):
    def text(n):
        return "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [text(length * 3) for _ in range(4)] + [text(length + 3)]
    rows = []
    for i in range(70):
        parts = [text(rng.randint(0, 2 * length))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            parts += [s[a:a + rng.randint(length - 4, 2 * length)], text(rng.randint(0, length))]
        rows.append((i, "".join(parts)))
    rows += [(100, None), (101, ""), (102, "x" * (length - 1)), (103, "y" * (length * 5)),
             (104, "ab" * length * 2), (105, rows[0][1]), (106, rows[0][1]), (106, rows[0][1]),
             (None, rows[3][1]), (107, "z" * length), (108, "ñ" * length)]
    return rows


@pytest.mark.parametrize("core,group", [(12, 2000), (12, 3), (24, 1)])
def test_against_brute_force(spark, documents, core, group):
    length = 40
    rows = corpus(random.Random(core), length)
    docs = documents(rows, h=1, n_bytes=2, th=3, raw="x")
    got = sorted((tuple(r) for r in S.dedup_substrings(
        docs, length, core, group, with_text=True).collect()), key=repr)
    got = [(*r[:5], bytes(r[5])) for r in got]
    assert sorted(got, key=repr) == brute(rows, length)


def test_segments_tile_the_windows_across_stretches():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 100, (1 << 20) + 5000).astype(np.uint8)
    offsets = np.array([0, 300, 300, len(data) - 500, len(data)])
    row, h, s1, s2, lo, hi, a = S.anchored_segments(data, offsets, 400, 128)
    for r in range(4):
        own = row == r
        n = max(0, offsets[r + 1] - offsets[r] - 399)
        covered = np.zeros(n, int)
        for x, y in zip(lo[own], hi[own]):
            covered[x:y + 1] += 1
        assert (covered == 1).all()
    assert ((a >= hi) & (a <= lo + 272)).all()


def test_empty_table(spark, documents):
    assert S.dedup_substrings(documents([])).count() == 0
