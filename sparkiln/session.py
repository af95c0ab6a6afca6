"""Session helpers: building a session for tests/bench and locating shared storage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "sparkiln") -> SparkSession:
    """Session used by tests, the bench and the entry point when none exists."""
    master = master or os.environ.get("SPARKILN_MASTER", "local[8]")
    shuffle_partitions = int(os.environ.get("SPARKILN_SHUFFLE_PARTITIONS", shuffle_partitions))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARKILN_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system); without it a cluster session is refused, because executors
    cannot see the driver's own folders.  Only a ``local`` master (unit tests
    on a laptop, where driver and executors are one process) falls back to a
    fresh temporary folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            root = current
        elif not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        else:
            root = tempfile.mkdtemp(prefix="sparkiln-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/sparkiln/{name}-{uuid.uuid4().hex[:12]}"


#: Called with every table that is about to be written (plan audits).
PLAN_HOOKS: list = []


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` as a parquet table in the shared
    checkpoint folder and reading it back.

    One computation of the plan (``checkpoint(eager=True)`` on an unpersisted
    plan computes it once for the eager count and again to write the files),
    columnar storage, and the data outlives any executor.
    """
    spark = df.sparkSession
    for hook in PLAN_HOOKS:
        hook(df)
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize_blocks(df: DataFrame, n: int, block: str, name: str = "stage") -> DataFrame:
    """``materialize`` as a table of ``n`` buckets by ``block``: read back, a block's rows
    lie in one partition, so that what works within blocks needs no exchange.  Best
    called on rows that lie by block already; each task writes a file per bucket."""
    spark = df.sparkSession
    for hook in PLAN_HOOKS:
        hook(df)
    path = scratch_path(spark, name)
    table = "sparkiln_" + re.sub(r"\W", "_", path.rsplit("/", 1)[1])
    df.write.format("parquet").bucketBy(n, block).option("path", path).saveAsTable(table)
    return spark.table(table)


def in_blocks(n: int) -> dict[str, str]:
    """Planner settings under which joins on (block, other key) leave rows that lie in
    ``n`` partitions by block where they are, and bring the other side to them."""
    return {"spark.sql.requireAllClusterKeysForCoPartition": "false",
            "spark.sql.shuffle.partitions": str(n)}


def block_of(spark: SparkSession, key: str, n: int) -> Column:
    """The block of a row, one for each partition that ``repartition(n, key)`` makes;
    ``n`` buckets by it hold one block each."""
    keys = F.array(*[F.lit(k).cast("long") for k in partition_keys(spark, n)])
    return F.get(keys, F.pmod(F.hash(key), F.lit(n)))


def tiles_of_blocks(n: int, most: int) -> int:
    """Number of tiles, ``most`` at most, that ``n`` blocks fill evenly, whole blocks each."""
    each = -(-n // min(n, most))
    return -(-n // each)


def tile_of(spark: SparkSession, key: str, n: int, tiles: int) -> Column:
    """The tile of a row: its block of ``n`` (see ``block_of``) with others of them; rows
    that lie by block are written by tile without an exchange, and ``tiles`` buckets hold
    one tile each."""
    keys = F.array(*[F.lit(k).cast("long") for k in partition_keys(spark, tiles)])
    return F.get(keys, F.pmod(F.pmod(F.hash(key), F.lit(n)), F.lit(tiles)))


def sized_partitions(spark, rows: int, rows_per_partition: int = 2_000_000) -> int:
    """Partition count for a table of ``rows`` rows that will be cached and
    scanned repeatedly: about ``rows_per_partition`` rows per task, at least
    one task per core.  (A cached plan keeps its shuffle's partition count,
    so an unsized cache of a small table would cost one tiny task per
    ``spark.sql.shuffle.partitions`` on every scan.)"""
    cores = spark.sparkContext.defaultParallelism
    return max(cores, -(-int(rows) // rows_per_partition))


@contextmanager
def planned_with(spark: SparkSession, settings: dict[str, str]):
    """Run the enclosed actions with planner settings, then put the former ones back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def partition_keys(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` hash partitions a number that ``repartition(n, key)`` puts there,
    so that ``n`` blocks of equal size fill ``n`` partitions evenly.  (A number that
    lands elsewhere would cost balance, never a row.)"""
    found: dict[int, int] = {}
    upto = 16 * n
    while len(found) < n:
        rows: DataFrame = spark.range(upto).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("at")).agg(
            F.min("id").alias("key"))
        found = {r["at"]: r["key"] for r in rows.collect()}
        upto *= 4
    return [found[i] for i in range(n)]
