"""Parameters of the registered queries over the driver tables.

The reference runs on taxi drop-offs in longitude/latitude.  On the driver's
``events`` table the same operators run in the plane x = ``value``,
y = ``props.k``; the two regions below are quadrilaterals in that plane,
listed in priority order like the reference's two headquarters.
"""

# Region polygons in the (value, props.k) plane, priority order.
EVENT_REGIONS = (
    ("goldman", ((5.0, 10.0), (90.0, 5.0), (120.0, 55.0), (40.0, 70.0))),
    ("citigroup", ((100.0, 60.0), (300.0, 62.0), (280.0, 99.5), (130.0, 95.0))),
)

# The reference's two headquarters polygons ([lon, lat]),
# priority goldman then citigroup.
TAXI_REGIONS = (
    ("goldman", ((-74.0141012, 40.7152191), (-74.013777, 40.7152275),
                 (-74.0141027, 40.7138745), (-74.0144185, 40.7140753))),
    ("citigroup", ((-74.011869, 40.7217236), (-74.009867, 40.721493),
                   (-74.010140, 40.720053), (-74.012083, 40.720267))),
)

# Trend detection on events: about 14 events/hour at sf0.01, so hourly
# windows and a low threshold (the reference uses 10-minute windows, >= 10).
TREND_WIDTH = "1 hour"
TREND_WIDTH_S = 3600
TREND_MIN_COUNT = 5
TREND_RATIO = 2

# Dictionaries derived from the documents: a term in more than half of them is a
# stop word; terms in fewer than two are left out of the vocabulary.
MIN_DF = 2
MAX_DF_RATIO = 0.5

# K-Means parameters (reference defaults).
KMEANS_2D_K = 3
KMEANS_2D_MAX_ITER = 20
KMEANS_2D_TOL = 1e-3
KMEANS_COS_K = 5
KMEANS_COS_MAX_ITER = 10
KMEANS_COS_TOL = 1e-5
KMEANS_SEED = 42
