"""Label normalisation (FN7-FN10, FN25) as one native Column expression."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's make-label corrections, applied after title
# casing, in its order.
MAKE_LABELS = {
    "Bmw": "BMW",
    "Ford Tk": "Ford Truck",
    "Gmc": "GMC",
    "Gmc Truck": "GMC Truck",
    "Landrover": "Land Rover",
    "Mercedes-B": "Mercedes-Benz",
    "Mercedes": "Mercedes-Benz",
    "Vw": "Volkswagen",
}
# The substring rewrite applied last.
TRUCK_PATTERN, TRUCK_REPLACEMENT = " Tk", " Truck"

CASED = "[\\p{Lu}\\p{Ll}\\p{Lt}]"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_no_capital(text) -> Column:
    """FN7: true when the text holds no A-Z letter."""
    return ~_as_col(text).rlike("[A-Z]")


def title_case(text) -> Column:
    """FN8: Python ``str.title()``: a cased character is upper-cased when the
    character before it is not cased (start, digit, space, hyphen, ...),
    lower-cased otherwise.  ``initcap`` differs: it only breaks on spaces."""
    chars = F.split(_as_col(text), "")
    out = F.transform(chars, lambda c, i: F.when(
        (i == 0) | ~F.element_at(chars, F.greatest(i, F.lit(1))).rlike(CASED), F.upper(c))
        .otherwise(F.lower(c)))
    return F.array_join(out, "")


def map_labels(text, mapping: Mapping[str, str]) -> Column:
    """FN9: replace whole labels found in ``mapping``; others unchanged."""
    if not mapping:
        return _as_col(text)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, _as_col(text)), _as_col(text))


def normalize_label(text, mapping: Mapping[str, str] = MAKE_LABELS) -> Column:
    """FN25: all-lower-case labels are title-cased, then the fixed
    corrections are applied, then " Tk" becomes " Truck"."""
    c = _as_col(text)
    titled = F.when(has_no_capital(c), title_case(c)).otherwise(c)
    return F.regexp_replace(map_labels(titled, mapping), TRUCK_PATTERN, TRUCK_REPLACEMENT)
