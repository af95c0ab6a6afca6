"""Operator 6: URL verdicts from rules, word segmentation and naive Bayes.

A URL that fits a rule gets the rule's verdict (the longest that fits).  The
others are judged by their words: letter runs of the host are split into words
by the most probable segmentation under a unigram model (Viterbi), path tokens
are taken as they stand, and a multinomial naive Bayes model scores them.

* Unigram counts come from the words of all page bodies; ``BLOCK_TERMS`` are
  added with a share of ``TERM_SHARE`` each, so that listed words are known.
  An unknown word of n letters costs as much as 1 / (N 10^(n-1)).
* Teaching labels of the naive Bayes model: the rule's verdict where one fits,
  else ``block`` for a host with a word of ``BLOCK_TERMS`` and ``allow`` for
  others.  Counts are taken over all pages, with add-one smoothing.

Plan: URLs are first reduced to (host, path tokens) signatures with counts,
where numbers are tokens of their digit count.  Only the distinct letter runs
are segmented: their substrings meet the unigram table in a join, so the
vocabulary is never broadcast, and each run's own matches (at most
``MAX_WORD`` per letter) go through Viterbi in one row.

Defined cases: a NULL URL or one without ``://`` has empty host and path, no
tokens, and the verdict of the class priors; ties are ``allow``; repeated rows
are judged alike and counted each; NULL bodies have no words; empty tables give
empty results; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkiln.llm.tables import load_table, materialize

MAX_WORD = 24
TERM_SHARE = 1e-4
ALLOW, BLOCK = "allow", "block"
#: Words whose hosts teach the block class.
BLOCK_TERMS = (
    "adult", "ads", "bet", "bets", "casino", "escort", "gamble", "gambling", "malware",
    "phish", "pill", "pills", "poker", "porn", "sex", "spam", "spyware", "track", "tracker",
    "tracking", "viagra", "warez", "xxx",
)
RULES = (
    (ALLOW, "org/"), (BLOCK, "example.org/es/"), (BLOCK, "example.org/en/1"),
    (ALLOW, "com/fr/"), (BLOCK, "com/de/"),
)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty where there is no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES
                  ) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else NULLs."""
    rule = verdict = None
    for name, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, name) if verdict is None else verdict.when(fits, name)
    null = F.lit(None).cast("string")
    return (null, null) if rule is None else (rule, verdict)


def runs(text: Column) -> Column:
    """Letter runs, digit runs and runs of other non-ASCII characters."""
    return F.regexp_extract_all(text, F.lit(r"([a-z]+|[0-9]+|[^\x00-\x7f]+)"), F.lit(1))


def plain_tokens(tokens: Column) -> Column:
    """Tokens with numbers replaced by their digit count."""
    return F.transform(tokens, lambda t: F.when(
        t.rlike("^[0-9]+$"), F.concat(F.lit("#"), F.length(t).cast("string"))).otherwise(t))


def unigrams(pages: DataFrame, terms: Sequence[str] = BLOCK_TERMS) -> tuple[DataFrame, float]:
    """(word, n) over all page bodies with the terms added, and the total."""
    body = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), "<[^>]*>", " "))
    counted = (pages.select(F.explode(F.split(body, "[^a-z]+")).alias("word"))
               .where((F.col("word") != "") & (F.length("word") <= MAX_WORD))
               .groupBy("word").agg(F.count(F.lit(1)).cast("double").alias("n")))
    counted = materialize(counted, "unigrams")
    total = counted.agg(F.sum("n")).first()[0] or 0.0
    extra = max(1.0, total * TERM_SHARE)
    spark = pages.sparkSession
    listed = spark.createDataFrame([(t, extra) for t in sorted(set(terms))],
                                   "word string, n double")
    both = counted.unionByName(listed).groupBy("word").agg(F.sum("n").alias("n"))
    return both, total + extra * len(set(terms))


def viterbi(run: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """Most probable split of ``run``; ``known`` maps (start, length) to the
    count of the word there.  Of equal splits the one with the longer last
    word wins."""
    cost, back = [0.0] + [math.inf] * len(run), [0] * (len(run) + 1)
    unit, digit = math.log(total), math.log(10.0)
    for end in range(1, len(run) + 1):
        for start in range(max(0, end - MAX_WORD), end):
            n = known.get((start, end - start))
            own = unit - math.log(n) if n else unit + (end - start - 1) * digit
            if cost[start] + own < cost[end]:
                cost[end], back[end] = cost[start] + own, start
    out, end = [], len(run)
    while end:
        out.append(run[back[end]:end])
        end = back[end]
    return out[::-1]


def segment(names: DataFrame, words: DataFrame, total: float) -> DataFrame:
    """(run, words) for the distinct letter runs of column ``run``."""
    starts = names.select("run", F.explode(F.sequence(F.lit(0), F.length("run") - 1))
                          .alias("start"))
    pieces = starts.select("run", "start", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(MAX_WORD), F.length("run") - F.col("start")))).alias("len"))
    pieces = pieces.withColumn("word", F.substring("run", F.col("start") + 1, F.col("len")))
    found = (pieces.join(words, "word").groupBy("run")
             .agg(F.collect_list(F.struct("start", "len", "n")).alias("known")))
    rows = names.join(found, "run", "left")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [viterbi(run, {(k["start"], k["len"]): k["n"] for k in known or ()}, total)
                   for run, known in zip(*(batch.column(c).to_pylist() for c in ("run", "known")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("run"), pa.array(out, pa.list_(pa.string()))],
                names=["run", "words"])

    return rows.select("run", "known").mapInArrow(split, "run string, words array<string>")


def host_words(hosts: DataFrame, words: DataFrame, total: float) -> DataFrame:
    """(host, word) rows, a row per occurrence."""
    tokens = hosts.select("host", F.explode(plain_tokens(runs(F.col("host")))).alias("run"))
    letters = tokens.where(F.col("run").rlike("^[a-z]+$"))
    split = segment(letters.select("run").distinct(), words, total)
    return letters.join(split, "run").select("host", F.explode("words").alias("word")).unionByName(
        tokens.where(~F.col("run").rlike("^[a-z]+$")).select("host", F.col("run").alias("word")))


def token_weights(tokens: DataFrame) -> DataFrame:
    """(token, weight): log odds of block from (token, blocked, allowed) rows,
    with add-one smoothing."""
    counts = tokens.groupBy("token").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
    counts = materialize(counts, "tokens")
    all_ = counts.agg(F.sum("b").alias("b"), F.sum("a").alias("a"),
                      F.count(F.lit(1)).alias("v")).first()
    b, a, v = all_["b"] or 0, all_["a"] or 0, all_["v"]
    return counts.select("token", (F.log((F.col("b") + 1) / F.lit(float(b + v)))
                                   - F.log((F.col("a") + 1) / F.lit(float(a + v)))).alias("weight"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
          terms: Sequence[str] = BLOCK_TERMS) -> DataFrame:
    """page_id, host, path, rule, verdict, score (log odds of block)."""
    host, path = url_parts(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    signature = F.array_join(plain_tokens(runs(F.lower("path"))), " ")
    parsed = parsed.select("page_id", "host", "path", rule.alias("rule"),
                           verdict.alias("ruled"), signature.alias("tokens"))
    kinds = materialize(parsed.groupBy("host", "tokens").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("ruled") == BLOCK).alias("ruled_block"),
        F.count_if(F.col("ruled") == ALLOW).alias("ruled_allow")), "urls")

    words, total = unigrams(pages, terms)
    named = materialize(host_words(kinds.select("host").distinct(), words, total), "hosts")
    listed = named.groupBy("host").agg(
        F.max(F.col("word").isin(*terms).cast("long")).alias("listed"))
    free = F.col("n") - F.col("ruled_block") - F.col("ruled_allow")
    kinds = kinds.join(listed, "host", "left").select(
        "host", "tokens", "n",
        (F.col("ruled_block") + free * F.coalesce("listed", F.lit(0))).alias("blocked"))
    kinds = kinds.withColumn("allowed", F.col("n") - F.col("blocked"))
    counts = ["blocked", "allowed"]
    tokens = kinds.join(named, "host").select(
        "host", "tokens", F.concat(F.lit("h:"), "word").alias("token"), *counts).unionByName(
        kinds.where("tokens != ''").select(
            "host", "tokens", F.explode(F.split("tokens", " ")).alias("token"), *counts)
        .withColumn("token", F.concat(F.lit("p:"), "token")))
    tokens = materialize(tokens, "url_tokens")
    prior = kinds.agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a")).first()
    base = math.log((prior["b"] or 0) + 1) - math.log((prior["a"] or 0) + 1)
    scores = (tokens.join(token_weights(tokens), "token").groupBy("host", "tokens")
              .agg(F.sum("weight").alias("weight")))
    scored = parsed.join(scores, ["host", "tokens"], "left").withColumn(
        "score", F.round(F.lit(base) + F.coalesce("weight", F.lit(0.0)), 6))
    own = F.when(F.col("score") > 0, BLOCK).otherwise(ALLOW)
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", own).alias("verdict"), "score")


def op6_url_words(spark, sf_dir) -> DataFrame:
    return judge(load_table(spark, sf_dir, "pages"))


QUERIES = {"op6_url_words": op6_url_words}
ORACLE: dict[str, str] = {}
