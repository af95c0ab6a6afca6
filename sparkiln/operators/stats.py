"""Grouped and distribution statistics behind the reference's charts
(AGG14-AGG24, AGG27, SRT1-SRT3, PRJ6-PRJ14, WIN4, WIN5).

Every statistic is one partial/final aggregate (or a fixed small number of
them); none gathers a group into a single task.  Exact quantiles count the
distinct values of a group first (ties cost one row per task) and number them
range-partitioned, instead of the ``percentile`` aggregate, whose buffer holds
every distinct value of a group in memory.

NaN is a missing value like NULL, and rows with a NULL group key belong to no
group, as in the reference's data frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from sparkiln.functions.literals import literal_rows
from sparkiln.session import materialize


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(df: DataFrame, c: str) -> Column:
    """Column ``c`` with NaN as NULL."""
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        return F.when(~F.isnan(c), F.col(c))
    return F.col(c)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """PRJ14: names of numeric columns (minus ``exclude``)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def group_means(df: DataFrame, keys: Sequence, values: Sequence[str],
                prefix: str = "avg_") -> DataFrame:
    """AGG14/AGG15/AGG24/JN7: mean of several measures per group, one pass."""
    means = df.groupBy(*[_as_col(k) for k in keys]).agg(
        *[F.avg(present(df, v)).alias(f"{prefix}{v}") for v in values])
    return means.dropna("any", subset=means.columns[:len(keys)])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """AGG16: (value, count) ordered by count descending then value; NULLs
    are not counted (pandas ``value_counts`` default)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)))


def top_n(df: DataFrame, col: str, n: int = 5) -> DataFrame:
    """SRT2: the ``n`` most frequent values (ties broken by value).  The
    limit is the feature: a top-k over the grouped counts."""
    return value_counts(df, col).limit(n)


def top_n_series(df: DataFrame, key: str, year, n: int = 5, at_year: int | None = None,
                 out: str = "quantity") -> DataFrame:
    """SRT3 + PRJ7 + AGG17: the top-``n`` keys by row count in ``at_year``,
    then their row count for every year.  The top list has at most ``n``
    rows, so it is broadcast into a semi-join."""
    year_col = _as_col(year).alias("year")
    with_year = df.select(F.col(key), year_col).where(F.col("year").isNotNull())
    base = with_year if at_year is None else with_year.where(F.col("year") == F.lit(at_year))
    top = top_n(base, key, n).select(key)
    picked = with_year.join(F.broadcast(top), key, "left_semi")
    return picked.groupBy(key, "year").agg(F.count(F.lit(1)).alias(out))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """PRJ12: distinct values of a column."""
    return df.select(col).distinct()


def distinct_share(df: DataFrame, key: str, entity: str) -> DataFrame:
    """AGG23 + WIN5: distinct entities per key and their share of the sum
    over keys (a one-row total)."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count_distinct(entity).alias("n_entities"))
    total = counts.agg(F.sum("n_entities")).scalar()
    return counts.withColumn("share", F.col("n_entities") / total)


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG19: Pearson correlation of every ordered column pair (a, b, r),
    pairwise-complete like pandas.

    One aggregate computes all pairs.  ``r = covar_pop / (sd_a * sd_b)`` over
    the rows where both are non-NULL, with ``try_divide`` so a constant
    column gives NULL instead of an ANSI divide-by-zero error.
    """
    cols = list(cols)
    aggs, pairs = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            # pandas treats NaN as missing too
            both = (F.col(a).isNotNull() & ~F.isnan(F.col(a).cast("double"))
                    & F.col(b).isNotNull() & ~F.isnan(F.col(b).cast("double")))
            ca, cb = F.when(both, F.col(a)), F.when(both, F.col(b))
            name = f"r_{i}_{j}"
            aggs.append(F.try_divide(F.covar_pop(ca, cb),
                                     F.stddev_pop(ca) * F.stddev_pop(cb)).alias(name))
            pairs.append((a, b, name))
            if i != j:
                pairs.append((b, a, name))
    row = df.select(*cols).agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', `{name}`" for a, b, name in pairs)
    return row.selectExpr(f"stack({len(pairs)}, {stack}) AS (a, b, r)")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """AGG20: equal-width histogram per column with the bin edges of
    ``numpy.linspace(min, max, bins + 1)``: bin i holds edge_i <= v < edge_i+1,
    the last bin is closed.  Empty bins are kept with count 0.

    Two passes: a one-row min/max aggregate (scalars to the driver), then a
    grouped count of (column, bin) pairs, combined map-side so at most
    ``bins`` rows per column and task reach the shuffle.
    """
    cols = list(cols)
    bounds = df.agg(*[F.min(present(df, c)).cast("double").alias(f"mn{i}")
                      for i, c in enumerate(cols)],
                    *[F.max(present(df, c)).cast("double").alias(f"mx{i}")
                      for i, c in enumerate(cols)]).first()
    probes, spine = [], []
    for i, c in enumerate(cols):
        mn, mx = bounds[f"mn{i}"], bounds[f"mx{i}"]
        if mn is None:
            continue
        if mx == mn:  # numpy widens a zero range to +-0.5
            mn, mx = mn - 0.5, mx + 0.5
        step = (mx - mn) / bins
        edges = [k * step + mn for k in range(bins)] + [mx]
        # bin = number of interior edges <= v: exact against the edges, the
        # last bin closed, one flat comparison per edge (one SQL expression)
        v = f"CAST(`{c}` AS DOUBLE)"
        b2 = F.expr(" + ".join(f"(CASE WHEN {v} >= CAST('{e!r}' AS DOUBLE) THEN 1 ELSE 0 END)"
                               for e in edges[1:bins]) or "0")
        in_range = F.expr(f"{v} IS NOT NULL AND {v} >= CAST('{mn!r}' AS DOUBLE)"
                          f" AND {v} <= CAST('{mx!r}' AS DOUBLE)")
        probes.append(F.struct(F.lit(c).alias("column"), F.when(in_range, b2).alias("bin")))
        spine += [(c, k, edges[k], edges[k + 1]) for k in range(bins)]
    if not probes:
        return literal_rows(df.sparkSession, [],
                            "column string, bin int, lo double, hi double, count bigint")
    # one (column, bin) row per value, then a partial/final count per bin
    counts = (df.select(F.explode(F.array(*probes)).alias("p")).select("p.*")
              .where(F.col("bin").isNotNull())
              .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count")))
    # every bin is listed, empty ones with 0: the bin table has len(cols) * bins rows
    spine_df = literal_rows(df.sparkSession, spine, "column string, bin int, lo double, hi double")
    return (F.broadcast(spine_df).join(counts, ["column", "bin"], "left")
            .select("column", "bin", "lo", "hi",
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def _quantile_positions(q: float, n: Column):
    pos = F.lit(q) * (n - 1).cast("double")
    lo = F.floor(pos).cast("long")
    hi = F.ceil(pos).cast("long")
    return pos, lo, hi


def running_value_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, value, c (rows with it), before (rows of the key with a smaller
    value) and n (rows of the key): one row per distinct value.

    Counting comes first (map-side, so ties are one row per task); the distinct
    values are range-partitioned on (key, value), so a hot key is spread over many
    tasks, each numbers its own stretch, and one sum per (task, key) places the
    stretches."""
    counts = (df.select(F.col(key), present(df, value).alias(value))
              .where(F.col(key).isNotNull() & F.col(value).isNotNull())
              .groupBy(key, value).agg(F.count(F.lit(1)).alias("c")))
    # written: the bounds of a range shuffle come from a sample
    staged = materialize(counts.repartitionByRange(key, value)
                         .withColumn("_pid", F.spark_partition_id()), "values")
    parts = staged.groupBy("_pid", key).agg(F.sum("c").alias("_n"))
    whole = Window.partitionBy(key)
    ahead = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("_pid").alias("_p"), F.col(key).alias("_k"), F.sum("_n").over(whole).alias("n"),
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_pid", key).orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1)
    local = staged.withColumn("_in", F.coalesce(F.sum("c").over(inside), F.lit(0)))
    return local.join(parts, (F.col("_pid") == F.col("_p")) & (F.col(key) == F.col("_k"))).select(
        key, value, "c", (F.col("_base") + F.col("_in")).alias("before"), "n")


def quantiles_of(running: DataFrame, key: str, value: str, qs: Sequence[float],
                 names: Sequence[str]) -> DataFrame:
    """Quantiles per key with linear interpolation from running counts."""
    def at(pos: Column) -> Column:
        return F.max(F.when((pos >= F.col("before")) & (pos < F.col("before") + F.col("c")),
                            F.col(value)))

    aggs = []
    for q, name in zip(qs, names):
        pos, lo, hi = _quantile_positions(q, F.col("n"))
        aggs += [at(lo).alias(f"_{name}_lo"), at(hi).alias(f"_{name}_hi"),
                 F.max(pos - lo.cast("double")).alias(f"_{name}_f")]
    g = running.groupBy(key).agg(F.max("n").alias("n"), *aggs)
    return g.select(key, "n", *[
        (F.col(f"_{x}_lo") + (F.col(f"_{x}_hi") - F.col(f"_{x}_lo")) * F.col(f"_{x}_f")).alias(x)
        for x in names])


def group_quantiles(df: DataFrame, key: str, value: str, qs: Sequence[float],
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles per group with linear interpolation (numpy / pandas
    default).  Output: key, n, one column per quantile."""
    names = list(names or [f"q{int(q * 100)}" for q in qs])
    return quantiles_of(running_value_counts(df, key, value), key, value, qs, names)


def _fences(q: DataFrame, key: str, whis: float) -> DataFrame:
    reach = F.lit(whis) * (F.col("q3") - F.col("q1"))
    return q.select(key, (F.col("q1") - reach).alias("_lo"), (F.col("q3") + reach).alias("_hi"))


def box_stats(df: DataFrame, key: str, value: str, whis: float = 1.5) -> DataFrame:
    """AGG21: box-plot numbers per group: quartiles, IQR, whiskers at the
    most extreme values within ``whis`` IQR of the box, outlier count.  All of
    it comes from one table of counted values."""
    running = materialize(running_value_counts(df, key, value), "running")
    q = quantiles_of(running, key, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    v = F.col(value)
    inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
    w = running.join(_fences(q, key, whis), key).groupBy(key).agg(
        F.min(F.when(inside, v)).alias("whisker_lo"),
        F.max(F.when(inside, v)).alias("whisker_hi"),
        F.sum(F.when(inside, 0).otherwise(F.col("c"))).alias("n_outliers"))
    return q.join(w, key, "inner").select(
        key, "n", "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
        "whisker_lo", "whisker_hi", "n_outliers")


def box_outliers(df: DataFrame, key: str, value: str, whis: float = 1.5,
                 keep: Sequence[str] = ()) -> DataFrame:
    """AGG21: the rows drawn as outlier points (outside the whisker fences)."""
    q = group_quantiles(df, key, value, [0.25, 0.75], ["q1", "q3"])
    rows = (df.select(*keep, key, value).where(present(df, value).isNotNull())
            .join(_fences(q, key, whis), key))
    v = F.col(value)
    return rows.where((v < F.col("_lo")) | (v > F.col("_hi"))).select(*keep, key, value)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str],
         var: str = "variable", val: str = "value") -> DataFrame:
    """PRJ13: wide to long."""
    return df.unpivot(list(ids), list(values), var, val)


def melt_means(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """PRJ13 + AGG22: mean per (key, variable) after a melt."""
    known = df.where(F.col(key).isNotNull()).select(
        key, *[present(df, v).alias(v) for v in values])
    long = melt(known, [key], values)
    return long.groupBy(key, "variable").agg(F.avg("value").alias("mean_value"))
