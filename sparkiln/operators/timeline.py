"""Calendar operators: per-day counts, gap filling, first row per key,
year re-indexing and monthly running totals (JN2, JN3, WIN1, WIN2, AGG18,
AGG26, PRJ8, PRJ9, SET4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def daily_counts(df: DataFrame, ts: str, out: str = "date") -> DataFrame:
    """(date, count) for every day that has rows."""
    return df.groupBy(F.to_date(F.col(ts)).alias(out)).agg(F.count(F.lit(1)).alias("count"))


def date_spine(df: DataFrame, date_col: str, out: str = "date") -> DataFrame:
    """Every calendar day between the min and max of ``date_col``.

    Built from the one-row min/max aggregate by ``explode(sequence(...))``:
    its size is the calendar span, never the data size.
    """
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.col("lo"), F.col("hi"), F.expr("INTERVAL 1 DAY"))).alias(out))


def daily_counts_filled(df: DataFrame, ts: str, out: str = "date") -> DataFrame:
    """JN2 + AGG18: per-day counts over the full min..max date range,
    missing days filled with 0."""
    daily = daily_counts(df, ts, out)
    spine = date_spine(daily, out, out)
    return spine.join(daily, out, "left").select(
        out, F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


def select_between(df: DataFrame, col, lo, hi) -> DataFrame:
    """PRJ10: rows whose ``col`` lies in [lo, hi] (slider and dropdown filters)."""
    return df.where(_as_col(col).between(lo, hi))


def nonzero_days(filled: DataFrame, count: str = "count") -> DataFrame:
    """PRJ9: drop zero-count rows."""
    return filled.where(F.col(count) != 0)


def with_group_count(df: DataFrame, key, out: str = "count") -> DataFrame:
    """WIN1: each row carries the row count of its group (pandas
    ``transform('count')``).  The count is a partial/final aggregate joined
    back on the key, so a hot key is a skewed join key (split by AQE) rather
    than one window partition in one task."""
    key_col = _as_col(key)
    keyed = df.withColumn("_k", key_col)
    counts = keyed.groupBy("_k").agg(F.count(F.lit(1)).alias(out))
    return keyed.join(counts, "_k", "inner").drop("_k")


def first_per_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[Column]) -> DataFrame:
    """WIN2/SET4: first row of each key under ``order`` (callers add a unique
    tie-break so the result is deterministic).  ``row_number() = 1`` lets
    Spark insert a partial per-task group limit before the shuffle, so a hot
    key ships one row per task."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def events_in_month(spark: SparkSession, view: str, ts: str, year: int,
                    months: tuple[int, int] = (1, 12)) -> DataFrame:
    """PRJ8/SRC10: parameterised SQL over a named view; one query for a
    range of months instead of one query per month.  The months are one
    half-open date range, which prunes partitions and row groups."""
    from datetime import date
    first, last = months
    end = date(year + last // 12, last % 12 + 1, 1)
    return spark.sql(f"SELECT * FROM {view} WHERE {ts} >= :first AND {ts} < :end",
                     args={"first": date(year, first, 1), "end": end})


def yearly_mean_reindexed(df: DataFrame, year, value: str, where: Column | None = None,
                          out: str = "mean_value") -> DataFrame:
    """PRJ6 + AGG14 + JN3: mean of ``value`` per year after a filter, listed
    for every year between the first and last year present (NULL where a
    year has no rows)."""
    if where is not None:
        df = df.where(where)
    from sparkiln.operators.stats import present
    means = df.groupBy(_as_col(year).alias("year")).agg(F.avg(present(df, value)).alias(out))
    bounds = means.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    years = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.col("lo"), F.col("hi"))).alias("year"))
    return years.join(means, "year", "left")


def monthly_increments(df: DataFrame, ts: str) -> DataFrame:
    """AGG26/ST9: rows per calendar month and the running total.

    The running total is a window over the monthly table (one row per month),
    not over the data.  Months without rows are skipped, as in the reference's
    replay, which stalls at an empty month.
    """
    monthly = df.groupBy(F.trunc(F.col(ts).cast("date"), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("new_rows"))
    w = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.where(F.col("month").isNotNull()).withColumn(
        "total_rows", F.sum("new_rows").over(w))
