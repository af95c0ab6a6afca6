"""Small driver-side tables and generated expressions built inside the JVM.

``createDataFrame`` on a Python list is scanned through a Python worker, and
building a large expression call by call costs one Py4J round trip per node.
A table of a few literal rows (k centroids, a histogram's bin list) is
instead one SQL ``inline`` expression over literal structs, parsed once and
kept in the JVM plan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DateType, DoubleType, FloatType,
                               IntegerType, LongType, StringType, StructType,
                               _parse_datatype_string)


def sql_literal(v, t: DataType) -> str:
    """A Spark SQL literal of type ``t``."""
    ts = t.simpleString()
    if v is None:
        return f"CAST(NULL AS {ts})"
    if isinstance(t, StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(t, (DoubleType, FloatType)):
        f = float(v)
        if math.isnan(f):
            return f"CAST('NaN' AS {ts})"
        if math.isinf(f):
            return f"CAST('{'Infinity' if f > 0 else '-Infinity'}' AS {ts})"
        return f"CAST('{f!r}' AS {ts})"
    if isinstance(t, (IntegerType, LongType)):
        return f"CAST({int(v)} AS {ts})"
    if isinstance(t, BooleanType):
        return "true" if v else "false"
    if isinstance(t, DateType):
        return f"DATE'{v.isoformat()}'"
    if isinstance(t, ArrayType):
        if not v:
            return f"CAST(array() AS {ts})"
        return "array(" + ", ".join(sql_literal(x, t.elementType) for x in v) + ")"
    return f"CAST('{v}' AS {ts})"


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema) -> DataFrame:
    """A DataFrame of the given rows (meant for k-row tables, not data)."""
    if isinstance(schema, str):
        schema = _parse_datatype_string(schema)
    assert isinstance(schema, StructType)
    fields = schema.fields
    if not rows:
        return spark.range(0).selectExpr(
            *[f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields])
    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{f.name}', {sql_literal(v, f.dataType)}"
                                    for v, f in zip(r, fields)) + ")" for r in rows)
    return spark.range(1).selectExpr(f"inline(array({structs}))")


def plain_value(v) -> Column:
    """``v`` in every row, but not as a literal: a join on a literal key is
    folded into one without keys, which has to compare everything."""
    return F.when(F.spark_partition_id() < 0, F.lit(None)).otherwise(F.lit(v))
