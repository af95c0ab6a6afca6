import random

from sparkiln.llm import line_dedup as L
from llm_fixtures import documents  # noqa: F401


def brute(rows):
    seen, out = {}, []
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for d, t in dict.fromkeys(rows):
        lines = (t or "").split("\n")
        keys = [x.strip(" \t\r") for x in lines]
        gone = set()
        for i in range(len(lines) - 2):
            w = tuple(keys[i:i + 3])
            if "".join(w):
                if w in seen:
                    gone |= {i, i + 1, i + 2}
                seen.setdefault(w, (d, i))
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out += [(d, 0 if t is None else len(lines), len(gone), kept if gone else t)] * rows.count((d, t))
    return sorted(out, key=repr)


def test_against_brute_force(spark, documents):
    rng = random.Random(1)
    rows = [(i, "\n".join(rng.choice(["a", " a ", "b", "c\t", "", "d e"])
                          for _ in range(rng.randint(0, 14)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "\n\n\n\n"), (None, "x\ny\nz"), (63, "x\ny\nz"),
             (64, "p\nq\nr\ns"), (64, "p\nq\nr\ns"), (65, "u\n" * 2000), (66, "one\ntwo")]
    docs = documents(rows, pos=1, key="k", h1=2, lines="clash", starts=0)
    got = sorted(((r.doc_id, r.n_lines, r.n_removed, r.text)
                  for r in L.dedup_lines(docs).collect()), key=repr)
    assert got == brute(rows)


def test_empty_table(spark, documents):
    assert L.dedup_lines(documents([])).count() == 0
