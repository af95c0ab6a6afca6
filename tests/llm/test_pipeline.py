import random
from collections import defaultdict

from llm_fixtures import documents  # noqa: F401
from test_decontamination import brute as leaks
from test_line_dedup import brute as cut_lines
from test_minhash import brute as components

import __spark_entry__ as E
import corpus_pipeline as C
from sparkiln.llm import language_id, packing

WORDS = {"en": "the of and river house green walk stone light bird".split(),
         "fr": "le la des rivière maison vert marche pierre lumière oiseau".split()}


def corpus(rng):
    def text(lang, n):
        ws = [rng.choice(WORDS[lang]) + str(rng.choice("abcdefghij")) * rng.randint(1, 6)
              for _ in range(n)]
        return "\n".join(" ".join(ws[i:i + 7]) for i in range(0, n, 7))
    rows = [(i, text("en" if i % 2 else "fr", rng.randint(20, 120)), "en" if i % 2 else "fr")
            for i in range(50)]
    items = [(i, text("en", 20).replace("\n", " ")) for i in range(6)] + [(9, None)]
    header = "shared line one\nshared line two\nshared line three\n"
    rows += [(100 + i, header + text("en", 60), "en") for i in range(5)]
    rows += [(110, rows[4][1], "fr"), (111, rows[5][1].replace("\n", " ") + " extra", "en"),
             (112, rows[5][1].replace("\n", " "), None)]
    rows += [(120 + i, text("en", 30) + "\n" + items[i][1] + "\n" + text("en", 30), "en")
             for i in range(4)]
    rows += [(130, None, "en"), (131, "", "en"), (132, "12 34 ##", "en"), (133, "word", "en"),
             (None, text("fr", 40), "fr")]
    return rows, items


def test_stages_against_brute_force(spark, documents, tmp_path):  # noqa: F811
    rows, items = corpus(random.Random(6))
    sf = str(tmp_path)
    docs = documents(rows, score=1, kept="x", shard=3)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{sf}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for k, (name, stage) in enumerate(C.STAGES):
        stage(spark, now, sf).write.parquet(f"{sf}/out{k}")
        now = spark.read.parquet(f"{sf}/out{k}")
        if k < 4:
            assert now.columns == list(C.COLUMNS)
            seen[name] = {r.doc_id: r for r in now.collect()}
    text = {d: t for d, t, *_ in rows}
    # language ID: only texts without a letter go
    known = {d: t for d, t in text.items() if t and len(language_id.ngrams(t))}
    assert {d: r.text for d, r in seen["language_id"].items()} == known
    # line dedup
    want = {r[0]: r[3] for r in cut_lines(list(known.items())) if r[2] == 0 or r[3].strip()}
    assert {d: r.text for d, r in seen["line_dedup"].items()} == want
    assert all(r.n_chars == len(r.text) for r in seen["line_dedup"].values())
    assert 110 not in want and "shared" not in want[101]
    # near copies
    root = components(list(want.items()), 5, 80)
    want = {d: t for d, t in want.items() if d is None or root[d] == d}
    assert set(seen["minhash_dedup"]) == set(want) and 111 not in want
    # benchmark
    bad = {d for d, _ in leaks(list(want.items()), items)}
    assert {120, 121, 122, 123} <= bad
    want = {d: t for d, t in want.items() if d not in bad}
    assert {d: r.text for d, r in seen["decontamination"].items()} == want
    # packing
    got = defaultdict(list)
    for r in now.collect():
        got[r.doc_id].append((r.start, r.length))
    assert {d: sorted(p) for d, p in got.items()} == {
        d: packing.cut(len(packing.token_ids(t, packing.vocabulary_path())), 1024)
        for d, t in want.items()}
    assert sorted(map(tuple, C.run(spark, sf).select("doc_id", "piece", "ids_crc32").collect()),
                  key=repr) == sorted(map(tuple, now.select(
                      "doc_id", "piece", "ids_crc32").collect()), key=repr)


def test_empty_documents(spark, documents, tmp_path):  # noqa: F811
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = set(E.queries())
    assert {"pipeline"} | {n for n in C.QUERIES} <= names
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
