"""Operator 12 against brute force, and its defined cases."""

import re
from collections import Counter

import pytest

from sparkiln.llm import collocations as C
from llm_fixtures import documents, sf_small  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def brute(rows, least, most=5):
    """{(lang, phrase): (a, l, r, n, score)}, by counting every contiguous phrase."""
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate(str.maketrans(UPPER, UPPER.lower()))
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, most + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i:i + m])] += 1
    often = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    inside = {}
    for (lang, g), v in often.items():
        for m in range(2, len(g)):
            for i in range(len(g) - m + 1):
                key = lang, g[i:i + m]
                inside[key] = max(inside.get(key, 0), v)
    out = {}
    for (lang, g), a in often.items():
        if 100 * inside.get((lang, g), 0) >= 100 * a:
            continue
        n = total[lang]
        cuts = [(1000 * a * n // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out[lang, " ".join(g)] = (a, f[lang, g[:k]], f[lang, g[k:]], n, score)
    return out


def found(docs, least, most=5):
    rows = C.collocations(docs, least, most).collect()
    out = {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_equals_brute_force_on_the_given_table(spark, sf_small, monkeypatch):
    monkeypatch.setattr(C, "BYTES_AT_ONCE", 20_000)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    want = brute([(r["text"], r["lang"]) for r in docs.collect()], 4)
    assert len(want) > 500
    assert found(docs, 4) == want


@pytest.mark.parametrize("partitions", [1, 64])
def test_hot_first_word_over_many_tasks(spark, documents, partitions):
    """A third of all phrases start with one word, and whole chains repeat."""
    rows = [(i, f"the w{i % 40} of x{i % 7} the the the! the w{i % 40} of", "en")
            for i in range(400)]
    rows += [(900 + i, "a a a a a a; a\x01 b a", None) for i in range(9)]
    docs = documents(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(docs, 5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert got == brute([(r[1], r[2]) for r in rows], 5)


def test_defined_cases(spark, documents):
    assert C.collocations(documents([])).count() == 0
    assert C.collocations(documents([(1, None), (2, ""), (3, " .,\n")])).count() == 0
    long = "Ab cD\teé " * 30_000
    rows = [(1, long, "x"), (1, long, "x"), (None, "ab cd", None), (4, "ab cd", "und")]
    docs = documents(rows, f=1, phrase="clash", words=2, n=3)
    got = found(docs, 2)
    assert got == brute([(r[1], r[2]) for r in rows], 2)
    assert got["und", "ab cd"] == (2, 2, 2, 4, 2000)  # no language and that name are one
    assert found(docs, 2, most=2) == brute([(r[1], r[2]) for r in rows], 2, 2)


def test_a_crowded_sieve_changes_nothing(spark, sf_small, documents, monkeypatch):
    monkeypatch.setattr(C, "SIEVE_BITS", 64)
    rows = [(i, f"one two three {i % 5} four one two", "en") for i in range(60)]
    assert found(documents(rows), 10) == brute([(r[1], r[2]) for r in rows], 10)


def test_arithmetic_passes_64_bits():
    a, n = 3 * 10 ** 12, 10 ** 14
    assert C.lowest_cut(a, n, [10 ** 13, a], [a, 2 * a]) == (10_000, 10 ** 13, a)


def test_ranks(spark, duck, sf_small, monkeypatch):
    """Limits and order of the query against its SQL, with ranks cut short."""
    monkeypatch.setattr(C, "TOP", 3)
    got = [tuple(r) for r in C.op12_stream_collocations(spark, sf_small).collect()]
    sql = C.ORACLE_SQL.replace("<= 2000", "<= 3")
    assert sorted(got) == sorted(duck.execute(sql).fetchall())
