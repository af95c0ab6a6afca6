import datetime as dt

from pyspark.sql import functions as F

from sparkiln.functions.time import date_from_parts, format_day_month_year
from sparkiln.operators import timeline as TL


def _events(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 9)), (2, dt.datetime(2024, 1, 1, 17)),
            (3, dt.datetime(2024, 1, 4, 8)), (4, dt.datetime(2024, 3, 2, 12)), (5, None)]
    return spark.createDataFrame(rows, "id long, ts timestamp_ntz")


def test_gap_filled_days(spark):
    got = [(r["date"].day, r["count"]) for r in
           TL.daily_counts_filled(_events(spark).where(F.month("ts") == 1), "ts")
           .orderBy("date").collect()]
    assert got == [(1, 2), (2, 0), (3, 0), (4, 1)]
    nz = TL.nonzero_days(TL.daily_counts_filled(_events(spark).where(F.month("ts") == 1), "ts"))
    assert nz.count() == 2


def test_first_per_key_and_group_count(spark):
    df = TL.with_group_count(_events(spark).where(F.col("ts").isNotNull())
                             .withColumn("d", F.to_date("ts")), "d", out="n")
    first = {r["d"].day: (r["id"], r["n"]) for r in
             TL.first_per_key(df, "d", [F.desc("n"), F.asc("id")]).collect()}
    assert first == {1: (1, 2), 4: (3, 1), 2: (4, 1)}


def test_monthly_running_total_and_year_reindex(spark):
    rows = [(r["month"].month, r["new_rows"], r["total_rows"]) for r in
            TL.monthly_increments(_events(spark), "ts").orderBy("month").collect()]
    assert rows == [(1, 3, 3), (3, 1, 4)]  # February has no rows and is skipped
    sales = spark.createDataFrame([(2001, 10.0), (2001, 20.0), (2004, 7.0)], "y int, v double")
    got = [(r["year"], r["mean_value"]) for r in
           TL.yearly_mean_reindexed(sales, "y", "v").orderBy("year").collect()]
    assert got == [(2001, 15.0), (2002, None), (2003, None), (2004, 7.0)]


def test_date_parts_and_format(spark):
    df = spark.createDataFrame([(2024, 2, 29), (2023, 2, 29), (2024, 13, 1)], "y int, m int, d int")
    got = [r[0] for r in df.select(date_from_parts(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert got == [dt.date(2024, 2, 29), None, None]  # bad parts give NULL, not an error
    ts = spark.createDataFrame([(dt.datetime(2024, 3, 5, 1),)], "ts timestamp_ntz")
    assert ts.select(format_day_month_year(F.col("ts"))).first()[0] == "05/03/2024"


def test_parameterised_sql(spark):
    _events(spark).createOrReplaceTempView("tl_events")
    got = sorted(r["id"] for r in TL.events_in_month(spark, "tl_events", "ts", 2024, (1, 2)).collect())
    assert got == [1, 2, 3]
