"""Input tables and lineage cuts of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from sparkiln.session import materialize
from sparkiln.sources.tables import load_table

__all__ = ["load_table", "materialize", "text_crc32", "row_key", "ship_package"]


def text_crc32(text: Column) -> Column:
    """CRC-32 of the UTF-8 bytes, unsigned; NULL counts as no bytes."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def row_key(id: str, text: str) -> Column:
    """Key of a document row: rows equal in id and text share it."""
    return F.xxhash64(F.col(id), F.col(text))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a session whose
    workers neither start in the repository nor have it on ``PYTHONPATH``: it
    is sent along as ``--py-files`` would, once per application."""
    root = Path(__file__).resolve().parents[2]
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(":") if p]
    app = spark.sparkContext.applicationId
    if root in paths or Path.cwd().resolve() == root or app in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="sparkiln-")) / "sparkiln.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((root / "sparkiln").rglob("*.py")):
            out.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
