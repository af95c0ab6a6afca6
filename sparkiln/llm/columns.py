"""Column helpers shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ``[^\x20\x09-\x0D]+`` are words, so this splits them.
BLANKS = r"[\x20\x09-\x0D]+"
NON_BLANK = r"[^\x20\x09-\x0D]"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: as a lambda variable it
    is not evaluated anew for each element that a lambda in ``body`` visits."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_array(text: Column) -> Column:
    """Words of a whole text, in order; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def line_array(text: Column) -> Column:
    """Lines between newlines; a NULL text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def positions(n: Column) -> Column:
    """0 .. n-1; empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(
        F.array().cast("array<int>"))
