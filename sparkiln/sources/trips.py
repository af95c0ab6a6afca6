"""Taxi-trip CSV sources (SRC6, PRJ1-PRJ3, SET1, SET2).

Two record layouts share one headerless CSV stream and are told apart by the
first column.  Every column is read as a string, each layout is filtered and
cast with ``try_cast`` (bad values become NULL instead of ANSI errors), and
the two are unioned by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (FloatType, IntegerType, StringType, StructField, StructType,
                               TimestampType)

# The reference's yellow (20 fields) and green (22 fields) layouts.
YELLOW_SCHEMA = StructType([
    StructField("Type", StringType(), False),
    StructField("VendorID", IntegerType()),
    StructField("Pickup_datetime", TimestampType()),
    StructField("Dropoff_datetime", TimestampType()),
    StructField("Passenger_count", IntegerType()),
    StructField("Trip_distance", FloatType()),
    StructField("Pickup_longitude", FloatType()),
    StructField("Pickup_latitude", FloatType()),
    StructField("Rate_codeID", FloatType()),
    StructField("Store_and_fwd_flag", StringType()),
    StructField("Dropoff_longitude", FloatType()),
    StructField("Dropoff_latitude", FloatType()),
    StructField("Payment_type", IntegerType()),
    StructField("Fare_amount", FloatType()),
    StructField("Extra", FloatType()),
    StructField("Mta_tax", FloatType()),
    StructField("Tip_amount", FloatType()),
    StructField("Tolls_amount", FloatType()),
    StructField("Improvement_surcharge", FloatType()),
    StructField("Total_amount", FloatType()),
])

GREEN_SCHEMA = StructType([
    StructField("Type", StringType(), False),
    StructField("VendorID", IntegerType()),
    StructField("Pickup_datetime", TimestampType()),
    StructField("Dropoff_datetime", TimestampType()),
    StructField("Store_and_fwd_flag", StringType()),
    StructField("Rate_codeID", IntegerType()),
    StructField("Pickup_longitude", FloatType()),
    StructField("Pickup_latitude", FloatType()),
    StructField("Dropoff_longitude", FloatType()),
    StructField("Dropoff_latitude", FloatType()),
    StructField("Passenger_count", IntegerType()),
    StructField("Trip_distance", FloatType()),
    StructField("Fare_amount", FloatType()),
    StructField("Extra", FloatType()),
    StructField("Mta_tax", FloatType()),
    StructField("Tip_amount", FloatType()),
    StructField("Tolls_amount", FloatType()),
    StructField("Ehail_fee", FloatType()),
    StructField("Improvement_surcharge", FloatType()),
    StructField("Total_amount", FloatType()),
    StructField("Payment_type", IntegerType()),
    StructField("Trip_type", IntegerType()),
])

RAW_SCHEMA = StructType([StructField(f"_c{i}", StringType(), True) for i in range(22)])

# The union would widen Rate_codeID (float vs int) to double; both sides
# are cast to one type explicitly instead.
UNIFIED_OVERRIDES = {"Rate_codeID": "double"}


def project_as(df: DataFrame, schema: StructType, overrides: dict | None = None) -> DataFrame:
    """PRJ1: positional cast-and-rename, ``try_cast(_c{i} AS T) AS name``."""
    overrides = overrides or {}
    cols = []
    for i, f in enumerate(schema.fields):
        t = overrides.get(f.name, f.dataType.simpleString())
        cols.append(F.col(f"_c{i}").try_cast(t).alias(f.name))
    return df.select(*cols)


def unify_trips(raw: DataFrame) -> DataFrame:
    """PRJ2 + PRJ1 + SET1 + PRJ3: split the raw stream by record type, cast
    each layout, union by name (green-only columns are NULL for yellow rows)
    and add the ``dropoff`` timestamp."""
    yellow = project_as(raw.where(F.col("_c0") == "yellow"), YELLOW_SCHEMA, UNIFIED_OVERRIDES)
    green = project_as(raw.where(F.col("_c0") == "green"), GREEN_SCHEMA, UNIFIED_OVERRIDES)
    unified = yellow.unionByName(green, allowMissingColumns=True)
    return unified.withColumn("dropoff", F.col("Dropoff_datetime").try_cast("timestamp"))


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of the raw trip CSV files (all strings, no header)."""
    return spark.read.schema(RAW_SCHEMA).csv(path, header=False)


def read_trips_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """SRC6 + ST8: the trip folder as a file stream, rate-limited per trigger."""
    return (spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
            .schema(RAW_SCHEMA).csv(path, header=False))


def union_aligned(a: DataFrame, b: DataFrame, cols) -> DataFrame:
    """SET2: positional union after selecting the same aligned columns."""
    return a.select(*cols).union(b.select(*cols))
