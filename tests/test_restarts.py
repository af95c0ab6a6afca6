"""Sources and sinks that are read in splits, broken off and continued."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from sparkiln.operators import geo as GEO
from sparkiln.operators import kmeans as KM
from sparkiln.operators import windows as W
from sparkiln.session import planned_with
from sparkiln.sinks.files import RoundReport
from sparkiln.sources import files as SRC
from sparkiln.streaming import jobs as SJ


def _tmp():
    return tempfile.mkdtemp(prefix="sparkiln-test-")


def test_line_numbers_of_a_file_in_many_splits(spark):
    root = _tmp()
    lines = [f"term {i} " + "x" * (i % 37) for i in range(3000)]
    lines[5] = lines[2999] = ""  # blank lines are entries
    lines[7] = " spaced\r"
    with open(f"{root}/terms.txt", "w", newline="") as f:
        f.write("\n".join(lines) + "\n")
    with planned_with(spark, {"spark.sql.files.maxPartitionBytes": "4096",
                              "spark.sql.files.openCostInBytes": "0"}):
        assert spark.read.text(f"{root}/terms.txt").rdd.getNumPartitions() > 5
        rows = sorted(tuple(r) for r in SRC.read_dictionary(spark, f"{root}/terms.txt").collect())
    assert rows == [(i + 1, line.rstrip("\r").strip(" ")) for i, line in enumerate(lines)]
    with open(f"{root}/u.txt", "w") as f:
        f.write("last")  # a second file goes on, without a final newline
    assert SRC.read_dictionary(spark, root).where("id = 3001").first()["term"] == "last"


def _vectors(spark):
    rows = [(d, t, 1.0 + (d * t) % 7) for d in range(60) for t in range(d % 5, 40, 3 + d % 4)]
    return spark.createDataFrame(rows, "doc_id long, term_id int, tfidf double")


def test_report_goes_on_from_the_last_reported_round(spark, monkeypatch):
    tri = _vectors(spark)
    settings = dict(k=3, tol=-1.0, seed=4)  # no early end
    whole, parts = _tmp(), _tmp()
    KM.report_clusters(tri, whole, max_iter=5, **settings)
    assert RoundReport(spark, f"{parts}/none").last_round() == 0

    write = RoundReport.write_loss

    def fails(self, iteration, loss):
        if iteration == 3:
            raise OSError("killed")
        write(self, iteration, loss)

    monkeypatch.setattr(RoundReport, "write_loss", fails)
    with pytest.raises(OSError):
        KM.report_clusters(tri, parts, max_iter=5, **settings)
    monkeypatch.setattr(RoundReport, "write_loss", write)
    report = RoundReport(spark, parts)
    assert report.last_round() == 2
    KM.report_clusters(tri, parts, max_iter=5, **settings)
    other = RoundReport(spark, whole)
    for a, b in ((report.losses(), other.losses()), (report.top_terms(), other.top_terms())):
        def plain(df):
            return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                          for r in df.collect())
        assert plain(a) == plain(b) and a.count() > 0


def test_stream_of_tracks_numbers_on_and_doubles_nothing(spark, monkeypatch):
    base = _tmp()
    t0 = dt.datetime(2024, 1, 1)
    rows = [(None if i % 11 == 0 else i % 3, t0 + dt.timedelta(minutes=i), i) for i in range(90)]
    events = spark.createDataFrame(rows, "user long, ts timestamp_ntz, event long")
    write, tries = SJ.write_partitioned, []

    def fails_once(df, path, cols, *more):
        if path.endswith("_totals") and len(tries) == 0 and df.first()["batch_id"] == 1:
            tries.append(path)
            raise OSError("killed")  # the positions are out, the totals are not
        write(df, path, cols, *more)

    monkeypatch.setattr(SJ, "write_partitioned", fails_once)

    def run():
        stream = SJ.table_stream(spark, f"{base}/in", events.schema)
        SJ.tracks_stream(stream, f"{base}/ckpt", f"{base}/out", "user", "ts", ["event"])

    for part in range(3):
        events.where(F.floor(F.col("event") / 30) == part).write.mode("append").parquet(f"{base}/in")
        if part == 1:
            with pytest.raises(Exception, match="killed"):
                run()
        run()
    assert tries
    got = SJ.read_tracks(spark, f"{base}/out", events.schema, "user", "ts", ["event"])
    want = GEO.tracks(events, "user", "ts", ["event"])
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_trend_deltas_of_a_killed_batch_are_not_published(spark, monkeypatch):
    base = _tmp()
    t0 = dt.datetime(2024, 1, 1, 23)
    minutes = [1] * 3 + [11] * 8 + [21] * 5 + [45] * 7 + [61] * 20  # past midnight
    files = [minutes, [2] * 6 + [12] * 9 + [300] * 9, [22] * 40 + [46] * 5]  # late rows too
    frames = [spark.createDataFrame([(t0 + dt.timedelta(minutes=m), f"h{m % 2}") for m in part],
                                    "ts timestamp_ntz, headquarter string") for part in files]

    def counts(df):
        return W.windowed_counts(df, "ts", "10 minutes", keys=["headquarter"])

    def rows(df):
        return sorted(map(str, df.select("headquarter", "window_start", "count", "prev_count",
                                         "timestamp", "trend").collect()))

    def batch(n):
        df = frames[0]
        for f in frames[1:n]:
            df = df.unionByName(f)
        return rows(W.trending(W.flatten_window(counts(df)), min_count=5))

    stream = counts(SJ.table_stream(spark, f"{base}/in", frames[0].schema))

    def run():
        SJ.trend_deltas(stream, f"{base}/ckpt", f"{base}/out", min_count=5)

    def published():
        return rows(SJ.read_trends(spark, f"{base}/out", stream.schema))

    write = SJ.write_partitioned
    for n, frame in enumerate(frames, start=1):
        frame.coalesce(1).write.mode("append").parquet(f"{base}/in")
        if n == 2:
            for broken in ("/trends", "/alerts", "/windows"):
                def fails(df, path, cols, *more, broken=broken):
                    if path.endswith(broken):
                        raise OSError("killed")
                    write(df, path, cols, *more)
                monkeypatch.setattr(SJ, "write_partitioned", fails)
                with pytest.raises(Exception, match="killed"):
                    run()
                assert published() == batch(1)
            monkeypatch.setattr(SJ, "write_partitioned", write)
        run()
        assert published() == batch(n)
    assert len({tuple(batch(n)) for n in (1, 2, 3)}) == 3
    alerts = spark.read.text(f"{base}/out/alerts")
    assert alerts.where("value LIKE '%has doubled from%'").count() > 0


def test_a_report_that_ended_by_its_rules_is_left_alone(spark, tmp_path):
    """A run that converged within its rounds is not taken up again with more of them."""
    rows = [(d, t, 1.0) for d in range(12) for t in ((1, 2) if d % 2 else (3, 4))]
    tri = spark.createDataFrame(rows, "doc_id long, term_id int, tfidf double")
    path = str(tmp_path / "report")
    settings = dict(k=2, tol=1e-5, seed=3)
    KM.report_clusters(tri, path, max_iter=8, **settings)
    report = RoundReport(spark, path)
    last = report.last_round()
    assert 0 < last < 8 and report.ended(last)
    KM.report_clusters(tri, path, max_iter=20, **settings)
    assert report.last_round() == last and report.losses().count() == last
