"""Driver tables: one parquet file (or directory) per table under an sf folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def dealt(df: DataFrame, partitions: int | None) -> DataFrame:
    """``df`` dealt round-robin over ``partitions`` tasks before heavy work per row,
    where the caller knows that its files cannot be split; by default as it is."""
    return df.repartition(partitions) if partitions else df
