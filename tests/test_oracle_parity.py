"""Every registered query against its DuckDB oracle on sf0.001 (the driver
does the same at sf0.01)."""

import math
import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

ORACLE = E.oracle_sql()
NAMES = sorted(ORACLE)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(rows, order):
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in t))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    dcols = rel.columns
    drows = rel.fetchall()
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    assert _rows(srows, [cols.index(c) for c in order]) == \
        _rows(drows, [dcols.index(c) for c in order])


def test_every_query_has_oracle_or_is_listed():
    rows_only = set(E.queries()) - set(ORACLE)
    # the training-data queries (opN_<name>, pipeline) have brute-force tests of their own
    own = {name for name in rows_only if not re.match(r"op\d+_|pipeline$", name)}
    assert own == set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "day", "hour_label", "count"]
