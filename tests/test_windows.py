import datetime as dt

from sparkiln.operators import windows as W


def _counts(spark, rows):
    return spark.createDataFrame(
        [("goldman", dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=10 * i), c)
         for i, c in rows], "headquarter string, window_start timestamp_ntz, count long")


def test_trend_cases(spark):
    # (0 -> 10 trends), (5 -> 10 trends), (6 -> 13 does not), (gap then 10 trends), (0 -> 9 does not)
    rows = [(0, 10), (1, 5), (2, 10), (3, 7), (4, 13), (6, 10), (10, 9)]
    out = W.trending(_counts(spark, rows), width_s=600, min_count=10, ratio=2).collect()
    got = sorted((r["count"], r["prev_count"]) for r in out)
    assert got == [(10, 0), (10, 0), (10, 5)]


def test_trend_text_and_alert(spark):
    out = W.trending(_counts(spark, [(7, 12)]), width_s=600, min_count=10, ratio=2)
    r = out.first()
    assert r["timestamp"] == 70 * 60 * 1000
    assert r["trend"] == "(goldman,(12,4200000,0))"
    alert = W.trend_alerts(out).first()["alert"]
    assert alert == "The number of arrivals to Goldman Sachs has doubled from 0 to 12 at 4200000!"


def test_hourly_label(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 3, 59),), (dt.datetime(2024, 1, 2, 3, 1),)],
                               "ts timestamp_ntz")
    rows = W.hourly_counts(df, "ts").collect()
    assert {(r["day"].day, r["hour_label"], r["count"]) for r in rows} == \
        {(1, 4 * 3600000, 1), (2, 4 * 3600000, 1)}
