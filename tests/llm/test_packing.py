import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparkiln.llm import packing as P
from llm_fixtures import documents  # noqa: F401


def expand(rows):
    """Sequences as lists of (offset, length) from plan rows."""
    bins, ranks = defaultdict(list), defaultdict(set)
    for s, first, count, seq, each, offset in rows:
        for r in range(count):
            bins[seq + r // each].append((offset + r % each * s, s))
            assert first + r not in ranks[s]
            ranks[s].add(first + r)
    return bins, ranks


def best_possible(sizes, c):
    """Exact minimum by branch and bound over small instances."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                place(i + 1, rooms[:k] + [rooms[k] - sizes[i]] + rooms[k + 1:])
        place(i + 1, rooms + [c - sizes[i]])
    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    c = rng.choice([10, 17, 30])
    sizes = [rng.randint(1 if seed % 3 else c // 4, c) for _ in range(rng.randint(1, 10))]
    inst = P._Instance(dict(Counter(sizes)), c)
    P.reduce_instance(inst)
    fixed = sum(n for _, n in inst.chosen)
    rest = [s for s, n in inst.left.items() for _ in range(n)]
    assert all(sum(lengths) <= c for lengths, _ in inst.chosen)
    assert fixed + (best_possible(rest, c) if rest else 0) == best_possible(sizes, c)


@pytest.mark.parametrize("seed", range(20))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    hist = {s: rng.randint(1, 60) for s in rng.sample(range(1, 101), rng.randint(1, 60))}
    rows, n = P.packing_plan(hist, 100)
    bins, ranks = expand(rows)
    assert {s: len(r) for s, r in ranks.items()} == hist
    assert all(r == set(range(hist[s])) for s, r in ranks.items())
    assert len(bins) == n and set(bins) == set(range(n))
    for places in bins.values():
        end = 0
        for offset, s in sorted(places):
            assert offset == end
            end += s
        assert end <= 100
    assert n >= -(-sum(s * k for s, k in hist.items()) // 100)


def test_best_fit_equals_plain_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(30):
        sizes = [rng.randint(1, 50) for _ in range(rng.randint(1, 80))]
        rooms = []
        for s in sorted(sizes, reverse=True):
            fit = [r for r in rooms if r >= s]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - s)
            else:
                rooms.append(50 - s)
        inst = P._Instance(dict(Counter(sizes)), 50)
        P.best_fit(inst)
        got = sorted(50 - sum(lengths) for lengths, n in inst.chosen for _ in range(n))
        assert got == sorted(rooms)


def test_cut():
    assert P.cut(5, 10) == [(0, 5)]
    assert P.cut(20, 10) == [(0, 10), (10, 10)]
    assert P.cut(23, 10) == [(0, 3), (3, 10), (13, 10)]


def test_ids_equal_the_json_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["Hello world's  x\n\n 12 ", "a<|endoftext|>b", "ñó É  \u0085 x\x1c y 　z",
             "\U0001F600 é ١٢ ²", "\t\r\n \x0b\x0c", "a" * 5000, " " * 700 + "b"]
    for t in texts:
        want = tok.encode(t, add_special_tokens=False).ids + [2]
        assert P.token_ids(t, P.vocabulary_path()).tolist() == want


def test_pack_documents(spark, documents):
    rng = random.Random(3)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "Ünï"]) for _ in range(3000))
    rows = [(1, None), (2, ""), (None, "no id"), (4, long), (5, "same"), (5, "same"), (6, "x " * 300)]
    docs = documents(rows, length=7, offset=9)
    got = P.pack_documents(docs).collect()
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert len(by_doc[5]) == 2
    path = P.vocabulary_path()
    for doc, text in {(d, t) for d, t in rows}:
        ids = P.token_ids(text, path)
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)[:1 if doc == 5 else None]
        assert [(p.start, p.length) for p in pieces] == P.cut(len(ids), 1024)
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(
                ids[p.start:p.start + p.length].astype("<u4").tobytes())
    for places in bins.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= 1024
    assert P.pack_documents(documents([])).count() == 0
    assert np.array_equal(P.token_ids(None, path), [2])
