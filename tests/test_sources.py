"""File sources and sinks on small files written by the test."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from sparkiln.sinks.files import write_clusters, write_csv, write_kv_text
from sparkiln.sources import files as S
from sparkiln.sources.telemetry import (TELEMETRY_DROPPED, explode_positions,
                                        normalize_telemetry, read_telemetry)
from sparkiln.streaming import jobs as SJ


def _tmp():
    return tempfile.mkdtemp(prefix="src-", dir="/tmp")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_read_corpus_keys_and_lines(spark):
    root = _tmp()
    _write(f"{root}/business/001.txt", "Sales rose.\nShares fell\n")
    _write(f"{root}/tech/012.txt", "New chip\n")
    rows = sorted((r["doc_key"], r["line"]) for r in S.read_corpus(spark, root).collect())
    assert rows == [("business.001", "Sales rose."), ("business.001", "Shares fell"),
                    ("tech.012", "New chip")]


def test_read_dictionary_line_numbers(spark):
    root = _tmp()
    _write(f"{root}/terms.txt", "alpha\n beta \ngamma\n")
    rows = sorted(tuple(r) for r in S.read_dictionary(spark, f"{root}/terms.txt").collect())
    assert rows == [(1, "alpha"), (2, "beta"), (3, "gamma")]


def test_read_points_skips_bad_rows(spark):
    root = _tmp()
    _write(f"{root}/p.csv", "id,x,y\np1,0.5,0.25\np2,abc,1\np3,1e-3,2\n")
    rows = sorted(tuple(r) for r in S.read_points(spark, f"{root}/p.csv").collect())
    assert rows == [("p1", 0.5, 0.25), ("p3", 0.001, 2.0)]


def test_triples_and_kv_roundtrip(spark):
    root = _tmp()
    _write(f"{root}/t.tsv", "3\t1\t2\n5\t1\t1\n")
    t = S.read_triples(spark, f"{root}/t.tsv")
    assert sorted(tuple(r) for r in t.collect()) == [(3, 1, 2.0), (5, 1, 1.0)]
    write_kv_text(t, f"{root}/kv", "term_id", "value")
    lines = sorted(r["value"] for r in spark.read.text(f"{root}/kv").collect())
    assert lines == ["3\t2.0", "5\t1.0"]
    write_csv(t, f"{root}/csv")
    back = S.read_csv_table(spark, f"{root}/csv", S.TRIPLE_SCHEMA)
    assert back.count() == 2
    write_clusters(t.select("doc_id"), t.select("term_id"), f"{root}/clusters")
    assert S.read_cluster_output(spark, f"{root}/clusters/centroids").count() == 2


def test_telemetry_batch_and_stream(spark):
    root = _tmp()
    rec = {"name": "iss", "id": 25544, "latitude": 12.3456, "longitude": -45.6789,
           "altitude": 420.123, "velocity": 27600.555, "visibility": "daylight",
           "footprint": 4500.0, "timestamp": 1700000000, "daynum": 2460000.5,
           "solar_lat": -20.1, "solar_lon": 100.2, "units": "kilometers"}
    for i in range(3):
        _write(f"{root}/landing/r{i}.json", json.dumps({**rec, "timestamp": rec["timestamp"] + i}))
    df = normalize_telemetry(read_telemetry(spark, f"{root}/landing"))
    assert not set(TELEMETRY_DROPPED) & set(df.columns)
    r = df.orderBy("timestamp").first()
    assert (r["latitude"], r["longitude"], r["velocity"]) == (12.35, -45.68, 27600.56)
    SJ.telemetry_ingest(spark, f"{root}/landing", f"{root}/ck", f"{root}/out", files_per_trigger=1)
    assert spark.read.parquet(f"{root}/out").count() == 3


def test_explode_positions(spark):
    df = spark.createDataFrame(
        [(1, [(1.0, 2.0), (3.0, 4.0)])],
        "id int, positions array<struct<satlatitude:double,satlongitude:double>>")
    rows = [tuple(r) for r in explode_positions(df, keep=["id"]).orderBy("pos").collect()]
    assert rows == [(1, 0, 1.0, 2.0), (1, 1, 3.0, 4.0)]


def test_dictionary_ids_are_rows_of_many_files(spark):
    from sparkiln.plans import roundtrips
    root = _tmp()
    terms = [f"t{i:04d}" for i in range(500)] + [" blank ", "two\nlines"]
    spark.createDataFrame([(t,) for t in terms] + [(None,)], "p_type string").write.parquet(
        f"{root}/part.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = roundtrips.QUERIES["dictionary_ids"](spark, root)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(got.inputFiles()) > 1
    assert sorted(map(tuple, got.collect())) == [(i + 1, t) for i, t in enumerate(sorted(terms))]
