"""Operator 3: host-level quality rules with an empirical beta prior.

Each document gets measures of its whole text and fails or passes a few rules.
Failures are counted by host (the ``source`` column), the host rates of each
rule are shrunk towards the rate of all documents with a beta prior, and a host
whose shrunk rate of any rule lies more than ``HOST_LIMIT`` of the way from that
overall rate to 1 fails: its documents are not kept, even those that pass by
themselves.

The prior is fitted by beta-binomial moments weighted by the hosts' documents, which
take the binomial noise of a host's rate out of the spread between hosts.  What is left
is the share of the spread that hosts explain, rho, and the prior counts as
1 / rho - 1 documents, at least ``LEAST_WEIGHT``.  Where hosts do not differ by more
than chance, or where every host has one document so that nothing can be told, rho is
0 and every host has the overall rate: none fails.

Built-in expressions only.  Repeated windows are found inside the row (hash
per window; only texts with a repeated hash are sorted), so nothing is exploded
and no text is shuffled; the shuffle has one partial count per task and host.
Windows are compared by a 64-bit hash within one text.

Defined cases: NULL and empty texts have no words and fail; a NULL source
belongs to no host, so only the document's own rules count; repeated rows are
judged and counted one by one; an empty table gives an empty result; input
columns other than doc_id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkiln.llm.columns import (
    NON_BLANK, bound, line_array, positions, word_array,
)
from sparkiln.llm.tables import load_table, materialize

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_SYMBOL_PERCENT = 50
MAX_DUP_LINE_PERCENT = 50
HOST_LIMIT = 0.5  # part of the way from the rate of all documents to 1
LEAST_WEIGHT = 1.0  # documents that the prior counts as, at least
ROOM = 1e-6  # documents beyond the first of each host; under it hosts tell nothing
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""
    keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        def twin(k: Column) -> Column:
            h = F.get(s, k)["h"]
            return (F.coalesce(F.get(s, k - 1)["h"] == h, F.lit(False))
                    | F.coalesce(F.get(s, k + 1)["h"] == h, F.lit(False)))
        return F.sort_array(F.transform(F.filter(positions(F.size(s)), twin),
                                        lambda k: F.get(s, k)["i"]))

    def cover(p: Column) -> Column:
        own = F.transform(p, lambda x, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + x)

    return bound(bound(keyed, repeated), cover)


def repeat_words(words: Column) -> Column:
    """Words of ``words`` in 5-word windows found twice or more in the text,
    the first included."""
    def windows(h: Column) -> Column:
        return F.transform(positions(F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(
            *[F.get(h, i + j) for j in range(WINDOW)]))

    hashes = bound(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return bound(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered(h)))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, source and the measures of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = word_array(F.col("text"))
    lines = F.filter(line_array(F.col("text")), lambda x: x.rlike(NON_BLANK))
    return docs.select(
        "doc_id", "source",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")
        .alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        repeat_words(words).alias("n_repeat_words"))


def rules() -> dict[str, Column]:
    """Failures by rule; the first two are the document's own base rules."""
    return {
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words"),
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
    }


BASE_RULES = ("short", "repeats")


def shrunk_rates(counts: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, float]]:
    """Host rates shrunk with a beta prior per rule, and the rate of all documents
    per rule, the prior's mean.

    ``counts`` has a row per host: ``n`` and a failure count per rule.  With N documents
    on K hosts, mean m and spread S = sum n (rate - m)^2, the expected spread is
    m (1 - m) (K - 1 + rho (N - sum n^2 / N - (K - 1))).
    """
    n = F.col("n").cast("double")
    # one row of scalars
    total = counts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("n"),
                       F.sum(n * n).alias("squares"),
                       *[F.sum(r).alias(f"x_{r}") for r in names],
                       *[F.sum(F.col(r) / n * F.col(r)).alias(f"s_{r}") for r in names]).first()
    out, means = [], {}
    for r in names:
        means[r] = m = total[f"x_{r}"] / total["n"] if total["n"] else 0.0
        rho = _between_hosts(total, m, total[f"s_{r}"])
        if rho <= 0:
            out.append(F.lit(m).alias(r))
            continue
        weight = max(LEAST_WEIGHT, 1 / rho - 1)
        out.append(((F.col(r) + F.lit(m * weight)) / (F.col("n") + F.lit(weight))).alias(r))
    return counts.select("source", *out), means


def _between_hosts(total, m: float, squares: float | None) -> float:
    """rho: the share of a rule's spread that hosts explain; 0 where it cannot be told."""
    if not 0 < m < 1:
        return 0.0
    spare = total["hosts"] - 1
    room = total["n"] - total["squares"] / total["n"] - spare
    spread = squares - total["n"] * m * m
    return (spread / (m * (1 - m)) - spare) / room if room > ROOM else 0.0


def judge(docs: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """Measures, own verdict, host rate (largest shrunk rate) and kept."""
    found = rules()
    names = list(found)
    # the measures are the dear part and two steps read them: written once
    measured = materialize(measure(docs), "quality")
    failed = F.lit(False)
    for r in BASE_RULES:
        failed = failed | found[r]
    flagged = measured.withColumn("base_failed", failed)
    counts = (flagged.where(F.col("source").isNotNull()).groupBy("source")
              .agg(F.count(F.lit(1)).alias("n"),
                   *[F.sum(found[r].cast("long")).alias(r) for r in names]))
    rates, means = shrunk_rates(counts, names)
    over = F.lit(False)
    for r in names:
        over = over | (F.col(r) > F.lit(means[r] + (1 - means[r]) * host_limit))
    hosts = rates.select(F.col("source").alias("_host"), F.greatest(*names).alias("host_rate"),
                         over.alias("_over"))
    # Spark broadcasts the host table only when its size allows, else it splits hot hosts
    joined = flagged.join(hosts, F.col("source") == F.col("_host"), "left")
    host_failed = F.coalesce(F.col("_over"), F.lit(False))
    return joined.select(
        "doc_id", *MEASURES, "base_failed",
        (~F.col("base_failed") & ~host_failed).alias("kept"),
        F.round("host_rate", 6).alias("host_rate"), host_failed.alias("host_failed"))


def op3_host_rules(spark, sf_dir) -> DataFrame:
    return judge(load_table(spark, sf_dir, "documents"))


def _rho_sql(r: str) -> str:
    return (f"CASE WHEN x_{r} > 0 AND x_{r} < n AND n - n2 / n - (k - 1) > {ROOM} THEN "
            f"((s_{r} - x_{r} * (x_{r} / n)) / ((x_{r} / n) * (1 - x_{r} / n)) - (k - 1)) "
            "/ (n - n2 / n - (k - 1)) ELSE 0 END")


def _rate_sql(r: str) -> str:
    weight = f"greatest({LEAST_WEIGHT}, 1 / rho_{r} - 1)"
    return (f"CASE WHEN rho_{r} > 0 THEN (h.{r} + m_{r} * {weight}) / (h.n + {weight}) "
            f"ELSE m_{r} END")


_NAMES = ("short", "repeats", "symbols", "dup_lines")
ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, source, t,
         list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
wins AS (
  SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
hits AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM wins)
  WHERE c > 1),
covered AS (
  SELECT rid, count(DISTINCT i + o) AS n FROM hits, range(5) r(o) GROUP BY rid),
m AS (
  SELECT w.doc_id, w.source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         len(ls)::BIGINT AS n_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (rid)),
f AS (
  SELECT *, n_words < {MIN_WORDS} AS short,
         100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS repeats,
         100 * n_symbols > {MAX_SYMBOL_PERCENT} * n_words AS symbols,
         100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines AS dup_lines
  FROM m),
h AS (
  SELECT source, count(*) AS n, {", ".join(f"sum({r}::int) AS {r}" for r in _NAMES)}
  FROM f WHERE source IS NOT NULL GROUP BY source),
t AS (SELECT count(*) AS k, sum(n) AS n, sum(n::DOUBLE * n) AS n2,
             {", ".join(f"sum({r}) AS x_{r}, sum({r}::DOUBLE * {r} / n) AS s_{r}" for r in _NAMES)}
      FROM h),
p AS (SELECT {", ".join(f"x_{r} / n AS m_{r}, {_rho_sql(r)} AS rho_{r}" for r in _NAMES)} FROM t),
q AS (SELECT source, {", ".join(f"m_{r}, {_rate_sql(r)} AS r_{r}" for r in _NAMES)} FROM h, p),
v AS (SELECT source, greatest({", ".join(f"r_{r}" for r in _NAMES)}) AS host_rate,
             {" OR ".join(f"r_{r} > m_{r} + (1 - m_{r}) * {HOST_LIMIT}" for r in _NAMES)} AS over
      FROM q)
SELECT doc_id, {", ".join(MEASURES)}, short OR repeats AS base_failed,
       NOT (short OR repeats) AND NOT coalesce(v.over, false) AS kept,
       round(host_rate, 6) AS host_rate, coalesce(v.over, false) AS host_failed
FROM f LEFT JOIN v ON f.source = v.source"""

QUERIES = {"op3_host_rules": op3_host_rules}
ORACLE = {"op3_host_rules": ORACLE_SQL}
