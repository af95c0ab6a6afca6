"""Skew-proof ranking: global dense indexes and ranks within (possibly huge) groups.

A window ``row_number() OVER (PARTITION BY g ORDER BY v)`` sends a whole
group to one task; when one group holds a third of the data that task is the
job.  Here rows are range-partitioned on (group, order) instead, so a hot
group is spread over many tasks; each task numbers its own rows, and a tiny
per-(task, group) count table turns local positions into exact ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from sparkiln.session import materialize

_POS_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the row position in the low 33 bits


def _num_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def _sorted_positions(df: DataFrame, keys: Sequence[str], order: Sequence,
                      partitions: int | None) -> DataFrame:
    cols = [*[F.col(k) for k in keys], *[F.col(o) if isinstance(o, str) else o for o in order]]
    # Without an explicit count AQE may coalesce adjacent range partitions
    # (order is kept), so small inputs do not fan out into
    # spark.sql.shuffle.partitions tiny tasks.
    ranged = (df.repartitionByRange(partitions, *cols) if partitions
              else df.repartitionByRange(*cols))
    out = (ranged.sortWithinPartitions(*cols)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))))
    # Materialise: the partition boundaries of a range shuffle come from a
    # sample, so the positions must be fixed (as columns of a written table)
    # before offsets are computed.
    return materialize(out, "ranked")


def dense_index(df: DataFrame, order: Sequence, out: str = "id", start: int = 1,
                partitions: int | None = None) -> DataFrame:
    """Number the rows of ``df`` 0.. (plus ``start``) in ``order``: an exact
    global row number computed without funnelling rows through one task.
    Rows tied on ``order`` get distinct consecutive numbers."""
    staged = _sorted_positions(df, [], order, partitions)
    sizes = sorted((r["_pid"], r["n"]) for r in
                   staged.groupBy("_pid").agg((F.max("_pos") + 1).alias("n")).collect())
    offsets: dict[int, int] = {}
    acc = 0
    for pid, n in sizes:
        offsets[pid] = acc
        acc += n
    if offsets:
        offset_col = F.element_at(
            F.array(*[F.lit(offsets.get(p, 0)).cast("long") for p in range(max(offsets) + 1)]),
            F.col("_pid") + 1)
    else:
        offset_col = F.lit(0).cast("long")
    return staged.withColumn(out, offset_col + F.col("_pos") + F.lit(start)).drop("_pid", "_pos")


def group_rank(df: DataFrame, keys: Sequence[str], order: Sequence, out: str = "rank",
               partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row within its group of
    ``keys`` when sorted by ``order`` (ties broken arbitrarily but exactly:
    every position 0..n-1 is used once).  Also adds ``group_n``, the group size.
    """
    staged = _sorted_positions(df, keys, order, partitions)
    chunks = staged.groupBy("_pid", *keys).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_pid") if keys else Window.orderBy("_pid")
    chunks = (chunks.withColumn("_before", F.coalesce(
                  F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("group_n", F.sum("_n").over(
                  Window.partitionBy(*keys) if keys else Window.partitionBy())))
    # renamed copies of the key columns: the chunk table derives from the same
    # plan as the rows, so the join must not rely on column lineage
    chunks = chunks.select(F.col("_pid").alias("_c_pid"),
                           *[F.col(k).alias(f"_c_k{i}") for i, k in enumerate(keys)],
                           "_first", "_before", "group_n")
    # Spark broadcasts the chunk table only if its size allows
    # null-safe key match: NULL keys form their own group
    cond = F.col("_pid") == F.col("_c_pid")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_c_k{i}"))
    joined = staged.join(chunks, cond, "inner")
    return joined.select(
        *[F.col(c) for c in df.columns],
        (F.col("_before") + F.col("_pos") - F.col("_first")).alias(out),
        F.col("group_n"),
    )
