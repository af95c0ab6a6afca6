"""File sources of the text and clustering jobs (SRC1-SRC5, SRC7, SRC10, SRC11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from sparkiln.functions.text import parent_folder, path_stem
from sparkiln.operators.ranking import dense_index
from sparkiln.session import materialize


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: text lines, one row per line (column ``value``)."""
    return spark.read.text(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: every file under ``path`` (recursively) as lines keyed by
    ``doc_key`` = "<parent folder>.<file stem>"."""
    df = spark.read.option("recursiveFileLookup", True).text(path)
    fp = F.col("_metadata.file_path")
    return df.select(F.concat_ws(".", parent_folder(fp), path_stem(fp)).alias("doc_key"),
                     F.col("value").alias("line"))


def read_dictionary(spark: SparkSession, path: str, out: str = "term") -> DataFrame:
    """SRC3: a one-entry-per-line file as (id, entry), id = line number from 1; the
    files of a folder are numbered on in the order of their paths.

    The file is read in splits by many tasks.  Every line keeps its file, the
    byte where its split starts and its place in the task, as written once; the lines of each
    split are counted, and the sums of the splits before turn places into line
    numbers.  Only the table of splits is ordered in one task.  Entries are
    trimmed; blank lines count, a final newline does not add an entry.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), "value",
        F.monotonically_increasing_id().alias("_at"))
    placed = materialize(lines, "lines")
    splits = placed.groupBy("_file", "_block").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col("_file").alias("_f"), F.col("_block").alias("_b"), "_first",
                           F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    numbered = placed.join(splits, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    return numbered.select(
        (F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("int").alias("id"),
        F.trim(F.regexp_replace("value", "\\r\\z", "")).alias(out))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: "id,x,y" lines; lines whose x or y does not parse are skipped
    (this is how a header line disappears)."""
    parts = F.split(F.trim(F.col("value")), ",")
    df = spark.read.text(path).select(
        F.element_at(parts, 1).alias("id"),
        F.try_element_at(parts, F.lit(2)).try_cast("double").alias("x"),
        F.try_element_at(parts, F.lit(3)).try_cast("double").alias("y"))
    return df.where(F.col("x").isNotNull() & F.col("y").isNotNull())


TRIPLE_SCHEMA = StructType([StructField("term_id", IntegerType()),
                            StructField("doc_id", IntegerType()),
                            StructField("value", DoubleType())])


def read_triples(spark: SparkSession, path: str, schema: StructType = TRIPLE_SCHEMA) -> DataFrame:
    """SRC5: tab-separated sparse triples with a declared schema."""
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def read_csv_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SRC7: CSV with a header row and a declared schema (never inferred)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """SRC10: expose a DataFrame to ``spark.sql`` by name."""
    df.createOrReplaceTempView(name)
    return df


def read_cluster_output(spark: SparkSession, path: str) -> DataFrame:
    """SRC11: read back clustering output written by ``write_clusters``."""
    return spark.read.parquet(path)


def dictionary_from_values(df: DataFrame, col: str, out: str = "term") -> DataFrame:
    """A dictionary (id, entry) from the distinct values of a column, ids by
    byte order of the value (skew-proof dense index)."""
    distinct = df.select(F.col(col).alias(out)).where(F.col(out).isNotNull()).distinct()
    return dense_index(distinct, [out], out="id").select(F.col("id").cast("int"), out)
