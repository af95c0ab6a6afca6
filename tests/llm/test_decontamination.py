import random
import re
from collections import Counter

from sparkiln.llm import decontamination as D
from llm_fixtures import documents  # noqa: F401


def words(t):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())


def grams(ws, k):
    return Counter(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))


def brute(docs, items, k=5, threshold=0.8):
    out = {}
    for d, t in docs:
        ws = words(t)
        for item, it in items:
            iw = words(it)
            if not iw or item is None or not ws:
                continue
            n = min(len(iw), len(ws))
            if len(iw) < k:
                if any(ws[s:s + len(iw)] == iw for s in range(len(ws) - len(iw) + 1)):
                    out[d, item] = 1.0
                continue
            want = grams(iw, k)
            for s in range(len(ws) - n + 1):
                got = grams(ws[s:s + n], k)
                low = sum((got & want).values())
                sim = low / (got.total() + want.total() - low)
                if sim >= threshold:
                    out[d, item] = max(sim, out.get((d, item), 0.0))
    return {key: round(v, 6) for key, v in out.items()}


def make(rng):
    vocab = [f"w{i}" for i in range(300)] + ["é", "Ñu", "the", "of"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 40)))) for i in range(30)]
    items += [(30, None), (31, "..."), (None, "w1 w2 w3 w4 w5 w6"), (32, "x y z x y z x y z x y z"),
              (33, items[4][1])]
    docs = []
    for i in range(120):
        ws = [rng.choice(vocab) for _ in range(rng.randint(0, 80))]
        if i % 2:
            leak = (items[rng.randrange(33)][1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                if leak:
                    leak[rng.randrange(len(leak))] = "changed"
            at = rng.randint(0, len(ws))
            ws[at:at] = [x.upper() + rng.choice(["", ",", "."]) for x in leak]
        docs.append((i, " ".join(ws)))
    docs += [(200, None), (201, ""), (202, items[7][1] + "\n" + items[7][1]), (203, items[7][1][:-8])]
    return docs, items


def test_against_brute_force(spark, documents, monkeypatch):
    docs, items = make(random.Random(8))
    want = brute(docs, items)
    assert len(want) > 30
    for block in (20_000, 10):  # one block and several
        monkeypatch.setattr(D, "BLOCK_ITEMS", block)
        bench = spark.createDataFrame(items, "item_id long, text string")
        got = D.find_leaks(documents(docs, key=1, item_id=3), bench).collect()
        assert len(got) == len({(r.doc_id, r.item_id) for r in got})
        assert {(r.doc_id, r.item_id): round(r.similarity, 6) for r in got} == want
        for r in got:
            assert 0 <= r.word_start <= len(words(dict(docs)[r.doc_id])) - r.n_words


def test_empty_and_repeated(spark, documents):
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    rows = [(5, "x a b c d e f g h y"), (5, "x a b c d e f g h y"), (None, "a b c d e f g h")]
    assert D.find_leaks(documents(rows), none).count() == 0
    assert D.find_leaks(documents([]), bench).count() == 0
    got = D.find_leaks(documents(rows), bench).collect()
    assert sorted(str(r.doc_id) for r in got) == ["5", "5", "None"]


def test_index_finds_all_within_the_radius():
    import numpy as np
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**63, 50, dtype=np.uint64)
    index = D.SizeIndex(9, np.arange(50), prints, [])
    probes = np.concatenate([p ^ np.bitwise_or.reduce(
        np.uint64(1) << rng.choice(64, rng.integers(1, 30), replace=False).astype(np.uint64))
        for p in prints[:, None]] + [prints])
    got = set(zip(*map(list, index.lookup(probes))))
    want = {(a, b) for a in range(len(probes)) for b in range(50)
            if np.bitwise_count(probes[a] ^ prints[b]) <= D.RADIUS}
    assert got == want and len(want) > 60


def test_items_without_an_id_are_removed(spark, documents):
    bench = spark.createDataFrame([(None, "a b c d e f g h"), (None, "x y"), (1, "k l m n o p q"),
                                   (None, None)], "item_id long, text string")
    rows = [(1, "u a b c d e f g h v"), (2, "u x y v"), (3, "k l m n o p q"), (4, "u v w"),
            (None, "a b c d e f g h"), (5, None)]
    got = D.remove_leaks(documents(rows), bench).collect()
    assert sorted(r.doc_id for r in got) == [4, 5]


def test_blocks_stay_bounded_under_repeated_items(spark, documents, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 40)
    items = [(i, " ".join(f"w{i}x{j}" for j in range(8))) for i in range(120)]
    bench = spark.createDataFrame(items + [items[0]] * 400, "item_id long, text string")
    sizes = [sum(len(x.items) for x in block.sizes.values()) for block in D.item_blocks(bench, 5)]
    assert sum(sizes) == 120 and max(sizes) <= 60
    found = D.find_leaks(documents([(1, items[0][1]), (2, items[7][1])]), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 0), (2, 7)]
