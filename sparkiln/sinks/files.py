"""File sinks (SNK1-SNK9).

Per-label outputs are one partitioned write with dynamic partition overwrite
(an idempotent ``foreachBatch``: replaying a micro-batch rewrites the same
partitions), never a driver loop of one write per label.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkiln.functions.literals import literal_rows


def write_kv_text(df: DataFrame, path: str, key: str, value: str, mode: str = "overwrite") -> None:
    """SNK1: key<TAB>value lines."""
    (df.select(F.col(key).cast("string"), F.col(value).cast("string"))
     .write.mode(mode).option("sep", "\t").csv(path))


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      fmt: str = "parquet", text_col: str | None = None) -> None:
    """SNK2-SNK4: one write, one folder per label value, overwriting only the
    labels present in ``df`` (dynamic partition overwrite).  For ``text``
    output the single data column is ``text_col``."""
    cols = list(partition_cols)
    if fmt == "text":
        df = df.select(F.col(text_col).cast("string").alias("value"), *cols)
    writer = (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(*cols))
    if fmt == "csv":
        writer = writer.option("header", False)
    writer.format(fmt).save(path)


def label_writer(path: str, prepare: Callable[[DataFrame], DataFrame],
                 partition_cols: Sequence[str], fmt: str = "parquet",
                 text_col: str | None = None) -> Callable[[DataFrame, int], None]:
    """ST6: ``foreachBatch`` writer factory: ``prepare`` turns the micro-batch
    into output rows, which are written partitioned by the label columns."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_partitioned(prepare(batch), path, partition_cols, fmt, text_col)
    return write_batch


def replace_writer(path: str, prepare: Callable[[DataFrame], DataFrame],
                   fmt: str = "parquet", partition_cols: Sequence[str] = ()) -> Callable:
    """``foreachBatch`` writer for complete-mode state: each batch replaces
    the whole output table (the batch holds the whole state)."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        w = prepare(batch).write.mode("overwrite")
        if partition_cols:
            w = w.partitionBy(*partition_cols)
        w.format(fmt).save(path)
    return write_batch


def append_writer(path: str, prepare: Callable[[DataFrame], DataFrame],
                  fmt: str = "parquet") -> Callable:
    """``foreachBatch`` writer that appends (alert lines, telemetry): each
    micro-batch has a folder ``batch_id=<id>`` of its own, which a replay of the
    batch overwrites, so rows are never doubled."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
        write_partitioned(rows, path, ["batch_id"], fmt, text_col=rows.columns[0])
    return write_batch


def write_clusters(assignments: DataFrame, centroids: DataFrame, path: str) -> None:
    """SNK7: clusters and classes as two tables (never one mixed file)."""
    centroids.write.mode("overwrite").parquet(f"{path}/centroids")
    assignments.write.mode("overwrite").parquet(f"{path}/assignments")


class RoundReport:
    """SNK8: the report of a clustering run, a folder per round and kind, written as the
    rounds end: centroids, their top terms, and the loss.  A round counts as
    reported once its loss is there; writing it again replaces its folders only."""

    LOSS, TERMS = "loss double", "cluster int, rank int, term_id int, value double"
    CENTROIDS = "cluster int, term int, value double"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def write_round(self, iteration: int, centroids: DataFrame, top: DataFrame) -> None:
        for kind, table in (("centroids", centroids), ("top_terms", top)):
            table.write.mode("overwrite").parquet(f"{self.path}/{kind}/iteration={iteration}")

    def write_loss(self, iteration: int, loss: float) -> None:
        literal_rows(self.spark, [(float(loss),)], self.LOSS).write.mode("overwrite").parquet(
            f"{self.path}/loss/iteration={iteration}")

    def write_end(self, iteration: int) -> None:
        """The round after which the run's own rules stop it."""
        literal_rows(self.spark, [(iteration,)], "last int").write.mode("overwrite").parquet(
            f"{self.path}/end")

    def ended(self, done: int) -> bool:
        """Whether the run stopped by its own rules at the last reported round."""
        try:
            return self.spark.read.schema("last int").parquet(f"{self.path}/end").first()[0] == done
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return False

    def _table(self, kind: str, schema: str) -> DataFrame:
        return self.spark.read.schema(f"{schema}, iteration int").parquet(f"{self.path}/{kind}")

    def top_terms(self) -> DataFrame:
        return self._table("top_terms", self.TERMS)

    def losses(self) -> DataFrame:
        return self._table("loss", self.LOSS)

    def centroids(self, iteration: int) -> DataFrame:
        return self._table("centroids", self.CENTROIDS).where(
            F.col("iteration") == iteration).drop("iteration")

    def last_round(self) -> int:
        """The last reported round, 0 where there is none."""
        try:
            return self.losses().agg(F.max("iteration")).first()[0] or 0
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK9: CSV with a header row."""
    df.write.mode(mode).option("header", True).csv(path)
