"""Taxi-format streams end to end on synthetic CSV files (schemas of the
reference's yellow/green layouts), compared with known answers and with the
same plan run in batch."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from sparkiln.operators import windows as W
from sparkiln.plans.params import TAXI_REGIONS
from sparkiln.sources.trips import read_trips, unify_trips
from sparkiln.streaming import jobs as SJ

GOLDMAN = (-74.0141, 40.7146)
CITI = (-74.0110, 40.7209)
ELSEWHERE = (-73.9800, 40.7500)


def yellow(drop, lon, lat):
    pick = (drop - dt.timedelta(minutes=5)).strftime("%Y-%m-%d %H:%M:%S")
    return ",".join(["yellow", "2", pick, drop.strftime("%Y-%m-%d %H:%M:%S"), "1", "1.5",
                     "-74.0", "40.7", "1", "N", str(lon), str(lat), "1", "7.5", "0.5", "0.5",
                     "1.0", "0", "0.3", "9.8"])


def green(drop, lon, lat):
    pick = (drop - dt.timedelta(minutes=5)).strftime("%Y-%m-%d %H:%M:%S")
    return ",".join(["green", "2", pick, drop.strftime("%Y-%m-%d %H:%M:%S"), "N", "1",
                     "-73.9", "40.7", str(lon), str(lat), "1", "2.0", "8", "0.5", "0.5", "0", "0",
                     "", "0.3", "9.3", "2", "1"])


def make_files(folder, start=0, n_files=8):
    base = dt.datetime(2015, 12, 1, 0, 0)
    for f in range(start, start + n_files):
        rows = []
        for i in range(20):
            t = base + dt.timedelta(minutes=7 * (f * 20 + i))
            rows.append(yellow(t, *ELSEWHERE) if i % 3 else green(t, *ELSEWHERE))
        if f == 2:  # a burst of 12 drop-offs at Goldman Sachs between 04:10 and 04:19
            rows += [yellow(base + dt.timedelta(hours=4, minutes=10, seconds=40 * j), *GOLDMAN)
                     for j in range(12)]
            rows += [green(base + dt.timedelta(hours=5, minutes=3), *CITI)]
        with open(os.path.join(folder, f"part-{f:04d}.csv"), "w") as fh:
            fh.write("\n".join(rows) + "\n")


def test_streams_match_batch(spark):
    root = tempfile.mkdtemp(prefix="taxi-", dir="/tmp")
    data = os.path.join(root, "in")
    os.makedirs(data)
    make_files(data)
    batch = unify_trips(read_trips(spark, data))

    SJ.event_count(spark, data, f"{root}/ck1", f"{root}/hourly", files_per_trigger=3, fmt="parquet")
    got = {(r["window_start"], r["count"]) for r in spark.read.parquet(f"{root}/hourly").collect()}
    want = {(r["window_start"], r["count"]) for r in
            W.flatten_window(W.windowed_counts(batch, "dropoff", "1 hour")).collect()}
    assert got == want

    SJ.count_by_type_stream(spark, data, f"{root}/ck2", f"{root}/types", files_per_trigger=3)
    types = {r["type"]: r["count"] for r in spark.read.parquet(f"{root}/types").collect()}
    assert types == {r["Type"]: r["count"] for r in batch.groupBy("Type").count().collect()}

    SJ.region_event_count(spark, data, f"{root}/ck3", f"{root}/regions", files_per_trigger=3)
    lines = sorted(r["value"] for r in spark.read.text(f"{root}/regions").collect())
    assert lines == ["(citigroup,1)", "(goldman,12)"]

    SJ.trending_arrivals(spark, data, f"{root}/ck4", f"{root}/trends", files_per_trigger=3)
    trends = [r["value"] for r in spark.read.text(f"{root}/trends").collect()]
    assert trends == ["(goldman,(12,15000000,0))"]
    alerts = {r["value"] for r in spark.read.text(f"{root}/trends_alerts").collect()}
    assert "The number of arrivals to Goldman Sachs has doubled from 0 to 12 at 15000000!" in alerts


def test_stream_resumes_from_checkpoint(spark):
    root = tempfile.mkdtemp(prefix="taxi-restart-", dir="/tmp")
    data = os.path.join(root, "in")
    os.makedirs(data)
    make_files(data, 0, 4)
    SJ.event_count(spark, data, f"{root}/ck", f"{root}/out", files_per_trigger=2, fmt="parquet")
    make_files(data, 4, 4)  # more files arrive; the job restarts from its checkpoint
    SJ.event_count(spark, data, f"{root}/ck", f"{root}/out", files_per_trigger=2, fmt="parquet")
    got = {(r["window_start"], r["count"]) for r in spark.read.parquet(f"{root}/out").collect()}
    batch = unify_trips(read_trips(spark, data))
    want = {(r["window_start"], r["count"]) for r in
            W.flatten_window(W.windowed_counts(batch, "dropoff", "1 hour")).collect()}
    assert got == want


def test_unify_trips_schema(spark):
    root = tempfile.mkdtemp(prefix="taxi-schema-", dir="/tmp")
    make_files(root, 0, 1)
    u = unify_trips(read_trips(spark, root))
    types = dict(u.dtypes)
    assert types["Rate_codeID"] == "double" and types["dropoff"] == "timestamp"
    assert u.where(F.col("Type") == "yellow").where(F.col("Trip_type").isNotNull()).count() == 0
