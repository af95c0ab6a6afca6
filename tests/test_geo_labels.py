import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sparkiln.functions.geo import in_polygon
from sparkiln.functions.labels import normalize_label, title_case
from sparkiln.plans.params import EVENT_REGIONS, TAXI_REGIONS


def ray_cast(x, y, poly):
    """Scalar ray casting written independently for the test."""
    inside = False
    n = len(poly)
    for i in range(n):
        (x1, y1), (x2, y2) = poly[i], poly[(i + 1) % n]
        if min(y1, y2) < y <= max(y1, y2) and x <= max(x1, x2):
            if x1 == x2 or x <= (y - y1) * (x2 - x1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def test_in_polygon_matches_scalar(spark):
    rnd = random.Random(7)
    poly = EVENT_REGIONS[0][1]
    pts = [(rnd.uniform(0, 130), rnd.uniform(0, 80)) for _ in range(3000)]
    pts += [(p[0], p[1]) for p in poly] + [(40.0, 70.0), (5.0, 10.0), (None, 3.0)]
    df = spark.createDataFrame(pts, "x double, y double")
    got = [r[0] for r in df.select(in_polygon("x", "y", poly)).collect()]
    want = [False if x is None else ray_cast(x, y, poly) for x, y in pts]
    assert got == want
    # the array-column form agrees with the unrolled literal form
    arr = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in poly])
    got2 = [r[0] for r in df.select(in_polygon("x", "y", arr)).collect()]
    assert got2 == want


def test_taxi_regions_known_points(spark):
    inside_goldman = (-74.0141, 40.7145)
    df = spark.createDataFrame([inside_goldman, (-74.0, 40.0)], "x double, y double")
    got = [r[0] for r in df.select(in_polygon("x", "y", TAXI_REGIONS[0][1])).collect()]
    assert got == [ray_cast(*inside_goldman, TAXI_REGIONS[0][1]), False]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="abcXYz -'3é_.", max_size=12), min_size=1, max_size=20))
def test_title_case_matches_python(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r[0] for r in df.select(title_case("s")).collect()]
    assert got == [w.title() for w in words]


def test_normalize_label(spark):
    df = spark.createDataFrame([("bmw",), ("ford tk",), ("mercedes-b",), ("Kia",),
                                ("landrover",), ("gmc truck",), ("dodge tk",), (None,)], "s string")
    got = [r[0] for r in df.select(normalize_label("s")).collect()]
    assert got == ["BMW", "Ford Truck", "Mercedes-Benz", "Kia", "Land Rover", "GMC Truck",
                   "Dodge Truck", None]
