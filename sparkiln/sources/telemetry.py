"""Telemetry records (SRC8, SRC9, ST10): JSON landing folders read as
tables or streams, normalised and flattened with native expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField,
                               StructType)

# The telemetry record of the reference and the fields it drops.
TELEMETRY_SCHEMA = StructType([
    StructField("name", StringType()),
    StructField("id", LongType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("altitude", DoubleType()),
    StructField("velocity", DoubleType()),
    StructField("visibility", StringType()),
    StructField("footprint", DoubleType()),
    StructField("timestamp", LongType()),
    StructField("daynum", DoubleType()),
    StructField("solar_lat", DoubleType()),
    StructField("solar_lon", DoubleType()),
    StructField("units", StringType()),
])
TELEMETRY_DROPPED = ("id", "footprint", "daynum", "solar_lat", "solar_lon")

POSITIONS_SCHEMA = StructType([
    StructField("positions", ArrayType(StructType([
        StructField("satlatitude", DoubleType()),
        StructField("satlongitude", DoubleType()),
    ]))),
])


def read_telemetry(spark: SparkSession, path: str, stream: bool = False,
                   schema: StructType = TELEMETRY_SCHEMA) -> DataFrame:
    """JSON records from a landing folder, as a table or (``stream=True``) as
    a file stream; the schema is declared, never inferred."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).json(path)


def normalize_telemetry(df: DataFrame, drop: Sequence[str] = TELEMETRY_DROPPED,
                        digits: int = 2) -> DataFrame:
    """SRC8: drop the listed fields (when present) and round every double
    column to ``digits`` decimals."""
    kept = [f for f in df.schema.fields if f.name not in set(drop)]
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, DoubleType) else F.col(f.name) for f in kept])


def explode_positions(df: DataFrame, col: str = "positions", keep: Sequence[str] = (),
                      with_index: bool = True) -> DataFrame:
    """SRC9: one row per element of a nested array of structs, the struct's
    fields as columns (``pos`` keeps the element's place in the array)."""
    if with_index:
        ex = df.select(*keep, F.posexplode(F.col(col)).alias("pos", "p"))
        return ex.select(*keep, "pos", "p.*")
    return df.select(*keep, F.explode(F.col(col)).alias("p")).select(*keep, "p.*")
