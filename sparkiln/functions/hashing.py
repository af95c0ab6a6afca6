"""Deterministic pseudo-random draws (FN24, ML1).

``rand(seed)`` depends on partitioning, so a recomputed task (lost executor,
AQE re-plan) may draw different numbers.  A hash of (seed, id) is the same
on every recomputation and in any engine: the draw is the first 32 bits of
md5("<seed>:<id>") scaled to [0, 1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def unit_draw(id_col, seed: int = 0) -> Column:
    """Uniform draw in [0, 1) keyed by (seed, id)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(F.lit(f"{int(seed)}:"), c.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(TWO_POW_32)


def sql_unit_draw(id_expr: str, seed: int = 0) -> str:
    """The same draw in DuckDB SQL (used by the oracle)."""
    return (f"(('0x' || substr(md5('{int(seed)}:' || CAST({id_expr} AS VARCHAR)), 1, 8))::BIGINT"
            f" / {TWO_POW_32!r})")
