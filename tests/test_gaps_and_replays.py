"""Missing values, duplicate ids, replayed micro-batches and hot values."""

import json
import math

import pytest

from sparkiln.operators import geo as GEO
from sparkiln.operators import models as ML
from sparkiln.operators import stats as ST
from sparkiln.operators import timeline as TL
from sparkiln.operators import windows as W
from sparkiln.plans.params import EVENT_REGIONS
from sparkiln.sinks import files as SINK
from sparkiln.streaming import jobs as SJ

NAN = float("nan")


def test_region_table_keeps_duplicate_and_null_ids(spark):
    rows = [(None, 60.0, 30.0), (None, 60.0, 30.0), (7, 60.0, 30.0), (7, 61.0, 30.0),
            (8, -5.0, -5.0), (9, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    want = sorted(map(str, W.label_region(df, "x", "y", EVENT_REGIONS).select(
        "id", "headquarter").collect()))
    got = GEO.label_region_table(df, "x", "y", GEO.region_table(spark, EVENT_REGIONS), cell=10.0,
                                 out="headquarter").select("id", "headquarter").collect()
    assert len(got) == 4 and sorted(map(str, got)) == want


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(8)] + [("a", NAN), (None, 3.0)],
                               "k string, v double")
    box = ST.box_stats(df, "k", "v").first()
    assert (box.n, box.q1, box.median, box.q3) == (8, 1.75, 3.5, 5.25)
    h = ST.histogram(df.where("k = 'a'"), ["v"], bins=7).collect()
    assert [r["count"] for r in sorted(h, key=lambda r: r.bin)] == [1, 1, 1, 1, 1, 1, 2]
    assert [tuple(r) for r in ST.group_means(df, ["k"], ["v"]).collect()] == [("a", 3.5)]
    assert [tuple(r) for r in ST.melt_means(df, "k", ["v"]).collect()] == [("a", "v", 3.5)]
    years = spark.createDataFrame([(2000, 1.0), (2000, NAN), (2002, 4.0)], "y int, v double")
    from pyspark.sql import functions as F
    assert {r.year: r.mean_value for r in TL.yearly_mean_reindexed(
        years, F.col("y"), "v").collect()} == {2000: 1.0, 2001: None, 2002: 4.0}


def test_null_year_is_no_year(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1)], "k string, y int")
    assert {tuple(r) for r in ST.top_n_series(df, "k", "y").collect()} == {("a", 1, 1), ("b", 1, 1)}


def test_equal_values_are_one_row(spark):
    df = spark.range(20000).selectExpr("'k' AS k", "IF(id % 10 < 9, 5.0D, CAST(id AS DOUBLE)) AS v")
    running = ST.running_value_counts(df, "k", "v").collect()
    assert len(running) == 2001 and max(r.c for r in running) == 18000
    values = sorted([5.0] * 18000 + [float(i) for i in range(20000) if i % 10 == 9])
    assert all(values[r.before] == r.v and r.n == 20000 for r in running)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    write = SINK.append_writer(f"{tmp_path}/t", lambda b: b)
    for batch, n in ((0, 3), (1, 2), (0, 3), (1, 2)):
        write(spark.range(n).withColumnRenamed("id", "x"), batch)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5


def test_telemetry_keeps_the_name(spark, tmp_path):
    (tmp_path / "in").mkdir()
    record = {"name": "iss", "id": 1, "latitude": 1.239, "timestamp": 5, "units": "km",
              "solar_lat": 2.0, "daynum": 3.0}
    (tmp_path / "in" / "a.json").write_text(json.dumps(record))
    SJ.telemetry_ingest(spark, f"{tmp_path}/in", f"{tmp_path}/ck", f"{tmp_path}/out")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert set(out.columns) == {"name", "latitude", "longitude", "altitude", "velocity",
                                "visibility", "timestamp", "units", "batch_id"}
    assert out.first().name == "iss" and out.first().latitude == 1.24


def test_unknown_trip_types_are_not_counted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("".join(
        kind + "," * 21 + "\n" for kind in ("yellow", "green", "junk", "yellow")))
    SJ.count_by_type_stream(spark, f"{tmp_path}/in", f"{tmp_path}/ck", f"{tmp_path}/out")
    got = {r["type"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {"yellow": 2, "green": 1}


def test_stream_reads_a_file_or_a_folder_of_that_name(spark, tmp_path):
    spark.range(4).repartition(2).write.parquet(f"{tmp_path}/t.parquet")
    spark.range(9).write.parquet(f"{tmp_path}/t.parquet_old")
    schema = spark.range(1).schema
    seen = []
    SJ.run_available(SJ.table_stream(spark, f"{tmp_path}/t.parquet", schema),
                     lambda b, i: seen.append(b.count()), f"{tmp_path}/ck", "append")
    assert sum(seen) == 4


def test_mesh_of_two_columns(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 2.0)], "x double, y double")
    mesh = ML.mesh_grid(df, ["x", "y"], 0.5, 0.25)
    assert mesh.count() == 3 * 5 and mesh.rdd.getNumPartitions() > 1
    assert ML.mesh_grid(df.where("x > 5"), ["x", "y"], 0.5, 0.25).count() == 0
    with pytest.raises(ValueError):
        ML.mesh_grid(df, ["x"], 0.5, 0.25)


def test_nan_points_join_no_cluster(spark):
    from sparkiln.operators import kmeans as KM
    df = spark.createDataFrame([(i, float(i % 2) * 10, float(i)) for i in range(20)] + [(99, NAN, 1.0)],
                               "id long, x double, y double")
    out = KM.kmeans_2d(df, k=2)
    assert out.assignments.count() == 20
    assert not any(math.isnan(r.x) for r in out.centroids.collect())


def test_console_sink(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    q = SJ.to_console(SJ.table_stream(spark, f"{tmp_path}/t.parquet", spark.range(1).schema)
                      .groupBy().count())
    q.processAllAvailable()
    assert q.lastProgress["numInputRows"] in (0, 3) and q.exception() is None
    q.stop()


def test_months_are_a_half_open_range(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2020-12-31 23:59:59' AS t UNION ALL SELECT TIMESTAMP_NTZ"
                   "'2021-01-01 00:00:00' UNION ALL SELECT TIMESTAMP_NTZ'2020-11-30 10:00:00'")
    df.createOrReplaceTempView("months_probe")
    assert TL.events_in_month(spark, "months_probe", "t", 2020, (12, 12)).count() == 1
    assert TL.events_in_month(spark, "months_probe", "t", 2020, (1, 11)).count() == 1
