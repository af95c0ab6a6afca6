import itertools
import math
import random
import re
from collections import Counter

from sparkiln.llm import url_filters as U


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fit = [(len(r), r, v) for v, r in U.RULES
           if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
           and path.startswith("/" + r.split("/", 1)[1])]
    return max(fit)[1:] if fit else (None, None)


def best_split(run, counts, total):
    def cost(w):
        n = counts.get(w)
        return math.log(total) - math.log(n) if n else math.log(total) + (len(w) - 1) * math.log(10)
    options = []
    for cuts in itertools.product([0, 1], repeat=len(run) - 1):
        ws, last = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                ws.append(run[last:i])
                last = i
        ws.append(run[last:])
        options.append((sum(map(cost, ws)), ws))
    return min(options)


def test_viterbi_finds_the_best_split():
    rng = random.Random(1)
    words = ["a", "ab", "abc", "ca", "sino", "win", "casino", "b", "cab"]
    counts = {w: rng.randint(1, 50) for w in words}
    for _ in range(60):
        run = "".join(rng.choice("abcsinow") for _ in range(rng.randint(1, 10)))
        known = {(i, len(w)): counts[w] for w in words for i in range(len(run))
                 if run.startswith(w, i)}
        got = U.viterbi(run, known, 1000)
        assert "".join(got) == run
        want = best_split(run, counts, 1000)
        assert math.isclose(best_split_cost(got, counts), want[0])


def best_split_cost(ws, counts):
    return sum(math.log(1000) - math.log(counts[w]) if w in counts
               else math.log(1000) + (len(w) - 1) * math.log(10) for w in ws)


def brute(rows):
    counts = Counter()
    for _, _, html in rows:
        body = re.sub(r"<[^>]*>", " ", html or "").lower()
        counts.update(w for w in re.split("[^a-z]+", body) if w and len(w) <= U.MAX_WORD)
    total = float(sum(counts.values()))
    extra = max(1.0, total * U.TERM_SHARE)
    for t in U.BLOCK_TERMS:
        counts[t] += extra
    total += extra * len(U.BLOCK_TERMS)

    def tokens(text, split):
        for t in re.findall(r"[a-z]+|[0-9]+|[^\x00-\x7f]+", text):
            if t.isascii() and t.isdigit():
                yield f"#{len(t)}"
            elif split and t.isascii():
                known = {(i, n): counts[t[i:i + n]] for i in range(len(t))
                         for n in range(1, len(t) - i + 1) if counts[t[i:i + n]]}
                yield from U.viterbi(t, known, total)
            else:
                yield t
    seen, by_class, prior = [], {"allow": Counter(), "block": Counter()}, Counter()
    for page, url, _ in rows:
        host, path = parts(url)
        words = list(tokens(host, True))
        bag = ["h:" + w for w in words] + ["p:" + w for w in tokens(path.lower(), False)]
        r, v = rule(host, path)
        label = v or ("block" if set(words) & set(U.BLOCK_TERMS) else "allow")
        by_class[label].update(bag)
        prior[label] += 1
        seen.append((page, host, path, r, v, bag))
    vocab = len(set(by_class["allow"]) | set(by_class["block"]))
    odds = {}
    for t in set(by_class["allow"]) | set(by_class["block"]):
        odds[t] = (math.log((by_class["block"][t] + 1) / (by_class["block"].total() + vocab))
                   - math.log((by_class["allow"][t] + 1) / (by_class["allow"].total() + vocab)))
    base = math.log(prior["block"] + 1) - math.log(prior["allow"] + 1)
    out = []
    for page, host, path, r, v, bag in seen:
        score = base + sum(odds[t] for t in bag)
        out.append((page, host, path, r, v or ("block" if score > 0 else "allow"), score))
    return out


def rows_of(seed):
    rng = random.Random(seed)
    names = ["cheappills", "goodnews", "casino-win", "thecat", "x1y22", "müller", "sextrack", "News"]
    rows = []
    for i in range(150):
        url = (rng.choice(["http://", "HTTPS://", "//", ""]) + rng.choice(["", "www.", "M."])
               + rng.choice(names) + rng.choice([".example.org", ".example.com", ".net", ".org"])
               + rng.choice(["", "/", "/fr/", "/de/12", "/es/x", "/en/1", "/en/19?q=/a", "#/z"]))
        rows.append((i, url, rng.choice([None, "", "<p>the good news of the cat</p> a b win"])))
    rows += [(200, None, "x"), (201, "", None), (None, "http://a.org/", None), (3, "http://", ""),
             (5, "http://a.b/c\nd", "<b"), (6, "http://" + "ab" * 400 + ".org/", None)]
    return rows


def test_against_brute_force(spark):
    rows = rows_of(3)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    from pyspark.sql import functions as F
    df = df.withColumn("host", F.lit(1)).withColumn("tokens", F.lit("t")).withColumn("n", F.lit(2))
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.score)
                  for r in U.judge(df).collect()), key=repr)
    want = sorted(brute(rows), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-5 for g, w in zip(got, want))
    assert {g[4] for g in got if g[3] is None} == {"allow", "block"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert U.judge(df).count() == 0
