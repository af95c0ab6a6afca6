import random
import re

from sparkiln.llm import quality_rules as Q
from llm_fixtures import documents  # noqa: F401


def brute(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    hit = {i + j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(5)}
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(hit))


def test_measures_against_brute_force(spark, documents):
    rng = random.Random(4)
    texts = [None, "", " \t\n", "a b c d e " * 6, "x y z " * 3 + "\n" + "x y z", "é# ü$ k\x1cz",
             "line\nline\n\n \nline", "w " * 4, "one"]
    texts += ["".join(rng.choice(["a ", "b ", "c\n", "d  ", "#"]) for _ in range(rng.randint(0, 90)))
              for _ in range(60)]
    rows = [(i, t, None, "s") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in Q.judge(documents(rows, n_words=3, h=1, kept=True)).collect()}
    for i, t in enumerate(texts):
        n, chars, symbols, dup, repeat = brute(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == \
            (n, chars, symbols, dup, repeat), t
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)


def test_hosts_are_shrunk(spark, documents):
    good = " ".join(f"word{i}" for i in range(40))
    bad = "spam ham spam ham eggs " * 20
    rows = [(i, bad if i % 10 else good, None, "farm") for i in range(200)]
    rows += [(1000 + i, good, None, f"host{i % 20}") for i in range(400)]
    rows += [(2000, bad, None, "tiny"), (2001, good, None, "tiny"), (2002, good, None, None),
             (2003, good, None, None), (2003, good, None, None)]
    got = {r.doc_id: r for r in Q.judge(documents(rows)).collect()}
    assert got[0].host_failed and not got[0].base_failed and not got[0].kept
    assert got[1000].kept and got[2001].kept and got[2002].kept and got[2003].kept
    assert got[2002].host_rate is None
    assert 0 < got[2001].host_rate < 0.5
    assert Q.judge(documents([])).count() == 0


GOOD = " ".join(f"word{i}" for i in range(40))
BAD = "spam ham spam ham eggs " * 20


def hosts(spec):
    """Documents of hosts given as name: (bad, all)."""
    return [(i, BAD if turn < bad else GOOD, None, name)
            for i, (name, turn, bad) in enumerate(
                (name, turn, bad) for name, (bad, n) in spec.items() for turn in range(n))]


def brute_rates(spec):
    """Beta-binomial moments by the definition, for one rule that ``BAD`` fails."""
    total, n_all, k = (sum(b for b, _ in spec.values()), sum(n for _, n in spec.values()), len(spec))
    m = total / n_all
    spread = sum(n * (b / n - m) ** 2 for b, n in spec.values())
    room = n_all - sum(n * n for _, n in spec.values()) / n_all - (k - 1)
    rho = (spread / (m * (1 - m)) - (k - 1)) / room if room > 1e-6 else 0
    weight = max(1, 1 / rho - 1) if rho > 0 else None
    return m, {h: (b + m * weight) / (n + weight) if weight else m for h, (b, n) in spec.items()}


def test_small_hosts_with_the_rate_of_a_failing_host_stay(spark, documents):
    spec = {"farm": (36, 40), "mill": (27, 30), "one": (1, 1), "two": (1, 1)}
    spec |= {f"clean{i}": (i % 3 == 0, 40) for i in range(40)}
    rows = hosts(spec)
    got = {r.source: r for r in Q.judge(documents(rows)).join(
        documents(rows).select("doc_id", "source"), "doc_id").collect()}
    m, rates = brute_rates(spec)
    for name, row in got.items():
        assert abs(row.host_rate - rates[name]) < 2e-6
        assert row.host_failed == (rates[name] > m + (1 - m) * Q.HOST_LIMIT), name
    assert got["farm"].host_failed and got["mill"].host_failed
    assert not got["one"].host_failed and not got["two"].host_failed


def test_hosts_of_one_document_tell_nothing(spark, documents):
    """At any rate of bad documents, a host of one is not judged by that one."""
    for bad in (4, 10, 100):
        spec = {f"h{i}": (int(i < bad), 1) for i in range(200)}
        got = Q.judge(documents(hosts(spec))).collect()
        assert not any(r.host_failed for r in got)
        assert {r.host_rate for r in got} == {round(bad / 200, 6)}
        assert sum(r.kept for r in got) == 200 - bad


def test_mostly_hosts_of_one_document(spark, documents):
    spec = {f"h{i}": (int(i % 20 == 0), 1) for i in range(300)} | {"farm": (57, 60), "fair": (3, 60)}
    rows = hosts(spec)
    got = {r.doc_id: r for r in Q.judge(documents(rows)).collect()}
    m, rates = brute_rates(spec)
    for doc_id, _, _, name in rows:
        assert abs(got[doc_id].host_rate - rates[name]) < 2e-6
        assert got[doc_id].host_failed == (rates[name] > m + (1 - m) * Q.HOST_LIMIT), name
    assert any(got[d].host_failed for d, _, _, name in rows if name == "farm")
    assert not any(got[d].host_failed for d, _, _, name in rows if name == "fair")


def test_corpus_of_failing_documents_fails_no_host_by_itself(spark, documents):
    got = Q.judge(documents(hosts({f"h{i}": (20, 20) for i in range(5)}))).collect()
    assert not any(r.host_failed for r in got) and all(r.base_failed for r in got)


def test_no_python_on_the_main_path(spark, documents):
    plan = Q.judge(documents([(1, "a b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
