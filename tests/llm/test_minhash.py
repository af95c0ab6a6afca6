import random
import re
from itertools import combinations

import pytest

from sparkiln.llm import minhash as M
from sparkiln.llm.components import components
from llm_fixtures import documents  # noqa: F401


def sets(text, k):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} or ({tuple(ws)} if ws else set())


def brute(rows, k, percent):
    """Component of every doc_id: union of exact links over all pairs."""
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    named = [(d, s) for d, t in rows if d is not None and (s := sets(t, k))]
    for (a, x), (b, y) in combinations(named, 2):
        if 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {d: find(d) for d in root}


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        ws = list(base)
        for _ in range(rng.randint(0, edits)):
            ws[rng.randrange(len(ws))] = f"new{rng.random()}"
        out.append(" ".join(ws))
    return out


@pytest.mark.parametrize("k,percent,block", [(3, 85, 256), (5, 80, 4)])
def test_against_brute_force(spark, documents, monkeypatch, k, percent, block):
    monkeypatch.setattr(M, "BLOCK", block)  # small blocks: several per bucket
    rng = random.Random(k)
    texts = [None, "", " \n\t", "one", "one two", "ONE Two", "a b c", "A  b\nc"]
    for size, n, edits in ((60, 25, 3), (120, 30, 9), (200, 20, 14), (20, 10, 1)):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
        texts += family(rng, base, n, edits)
    texts += [" ".join(f"u{rng.randint(0, 10**6)}" for _ in range(50)) for _ in range(20)]
    texts += texts[20:30]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[5]), (3, texts[3]), (3, texts[50])]
    got = M.link_documents(documents(rows, node=1, kept=1, sketch="x"), k, percent).collect()
    want = brute(rows, k, percent)
    assert len(got) == len(rows)
    sizes = sorted((d if d is not None else -1, len(sets(t, k))) for d, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles) for r in got) == sizes
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        elif r.n_shingles:
            assert r.component_id == want[r.doc_id], r
            assert r.kept == (r.doc_id == want[r.doc_id])
        else:
            assert r.component_id == r.doc_id and r.kept


def test_empty_table(spark, documents):
    assert M.link_documents(documents([]), 3, 85).count() == 0


def test_odd_sketch_tells_similar_from_dissimilar():
    assert 60 < M.sketch_limit(0.85) < 110
    assert M.sketch_limit(0.85) < M.sketch_limit(0.8)


def test_parities_of_sets_never_exceed_their_difference():
    """So the test on them loses no link, however large the sets are."""
    import numpy as np
    rng = np.random.default_rng(1)
    for size in (0, 1, 40, 700, 9000):
        base = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        for edits in (0, 1, size // 50, size // 12, size // 2):
            other = np.unique(np.concatenate([base[edits:], rng.integers(
                0, 2**63, edits, dtype=np.uint64)]))
            first = np.array([0, len(base), len(base) + len(other)])
            for bits in (M.PARITY_BITS, M.FINE_BITS):
                maps = M.set_parity(np.concatenate([base, other]), first, bits)
                away = int(np.bitwise_count(maps[0] ^ maps[1]).sum())
                shared, union = len(np.intersect1d(base, other)), len(np.union1d(base, other))
                assert away <= union - shared
                if 100 * shared >= 85 * union:
                    assert M.may_link(away, len(base) + len(other), 85)
    many = rng.integers(0, 2**63, 3000, dtype=np.uint64)  # more texts than one turn takes
    first = np.concatenate([[0], np.sort(rng.integers(0, 3000, 299)), [3000]])
    maps = M.set_parity(many, first, 128)
    for i in (0, 127, 128, 255, 256, 299):
        assert (maps[i] == M.set_parity(many[first[i]:first[i + 1]],
                                        np.array([0, first[i + 1] - first[i]]), 128)[0]).all()


def test_near_pairs_equal_all_pairs(monkeypatch):
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(0)
    n = 120
    band, side = np.sort(rng.integers(0, 9, n)), rng.integers(0, 2, n).astype(np.int32)
    node, component = rng.permutation(n), rng.integers(0, 30, n)
    sketch = rng.integers(0, 2**63, (n, 8), dtype=np.uint64)
    parity = rng.integers(0, 2**63, (n, 2), dtype=np.uint64)
    size = rng.integers(50, 800, n)
    bands = np.stack([band, rng.integers(0, 40, n)], axis=1)[:, ::-1].copy()
    want = {(max(node[x], node[y]), min(node[x], node[y])) for x in range(n) for y in range(n)
            if side[x] == 0 and side[y] == 1 and band[x] == band[y]
            and bands[x][0] != bands[y][0]
            and component[x] != component[y]
            and np.bitwise_count(sketch[x] ^ sketch[y]).sum() <= 255
            and 185 * np.bitwise_count(parity[x] ^ parity[y]).sum() <= 15 * (size[x] + size[y])}
    rows = pa.table({"band": band, "i": band * 0, "j": band * 0, "side": side, "node": node,
                     "component": component, "sketch": M._rows(sketch), "parity": M._rows(parity),
                     "n_shingles": size, "bands": M._rows(bands)})
    for pairs, size in ((7, 120), (10**6, 11)):
        monkeypatch.setattr(M, "PAIRS_AT_ONCE", pairs)
        got = set()
        for out in M._block_pairs(255, 85)(iter(rows.to_batches(max_chunksize=size))):
            got |= set(zip(*(out.column(c).to_pylist() for c in "ab")))
        assert got == want and len(want) > 20


def test_components_of_long_chains(spark):
    rng = random.Random(2)
    order = list(range(300))
    rng.shuffle(order)
    edges = list(zip(order[:199], order[1:200])) + list(zip(order[200:], order[201:])) + [(500, 501)]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: min(order[:200]) for n in order[:200]} | {n: min(order[200:]) for n in order[200:]}
    assert got == want | {500: 500, 501: 500}


def test_keep_one_goes_by_rows(spark, documents):
    rng = random.Random(5)

    def text():
        return " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(40))
    copied, a, b, c, near, alone = (text() for _ in range(6))
    rows = [(None, copied)] * 5 + [(None, alone), (None, None), (None, None)]
    rows += [(7, a), (7, b)]  # one id, two texts
    rows += [(1, near), (9, near + " more"), (9, c), (9, c)]  # one of them a near copy of id 1
    rows += [(None, a), (12, b + " end")]  # copies of both texts of id 7
    got = M.keep_one(documents(rows, _row=1), 5, 80).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(
        [(None, copied), (None, alone), (None, None), (None, None), (7, a), (7, b), (1, near),
         (9, c)], key=repr)
    assert all(r._row == 1 for r in got)


def test_texts_are_sifted_and_made_sets_by_one_worker(spark, documents, monkeypatch):
    rows = [(i, f"a b c d{i}") for i in range(60)] + [(None, "a b c d0"), (7, "x y z"), (8, None)]
    docs = documents(rows)
    ids = spark.createDataFrame([(3,), (7,), (8,), (99,)], "doc_id long")
    made = M.sets_among(docs, ids, 3)
    assert made._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    want = sorted((r.doc_id, r.set_a, r.set_b, tuple(r.hashes)) for r in M.set_table(
        docs.where("doc_id IN (3, 7, 8)"), 3).collect())
    assert len(want) == 5
    assert sorted((r.doc_id, r.set_a, r.set_b, tuple(r.hashes)) for r in made.collect()) == want
    monkeypatch.setattr(M, "SIEVE_IDS", 2)  # more ids than the sieve takes: a join
    assert sorted((r.doc_id, r.set_a, r.set_b, tuple(r.hashes))
                  for r in M.sets_among(docs, ids, 3).collect()) == want
