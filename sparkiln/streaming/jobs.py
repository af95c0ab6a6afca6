"""Structured Streaming jobs (ST1-ST10, SNK2-SNK6).

The reference's three trip jobs keep their ``(input, checkpoint, output)``
shape.  Aggregations are the same operators as in batch; the previous-window
lookup of the trend job needs a RANGE frame, so it runs inside
``foreachBatch`` on the complete-mode state.  Jobs run with
``trigger(availableNow=True)``: they drain what is in the source, respecting
``maxFilesPerTrigger``, and stop; offsets and state live in the checkpoint
folder, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sparkiln.functions.time import hour_end_label
from sparkiln.operators import windows as W
from sparkiln.operators.geo import tracks
from sparkiln.plans.params import TAXI_REGIONS
from sparkiln.session import materialize
from sparkiln.sinks.files import append_writer, label_writer, replace_writer, write_partitioned
from sparkiln.sources.trips import read_trips_stream, unify_trips


def run_available(stream: DataFrame, writer: Callable, checkpoint: str, mode: str,
                  name: str | None = None) -> StreamingQuery:
    """Drain the source into a ``foreachBatch`` writer and wait for the end."""
    w = (stream.writeStream.outputMode(mode).foreachBatch(writer)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    return q


def table_stream(spark: SparkSession, path: str, schema: StructType,
                 files_per_trigger: int = 100) -> DataFrame:
    """A parquet table (folder, or single file) read as a file stream."""
    # a pattern that matches this very name, be it a file or a folder, wherever it is stored
    path = path.rstrip("/")
    src = f"{path[:-1]}[{path[-1]}]"
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(src))


# ------------------------------------------------------------ batch shaping

def hourly_rows(batch: DataFrame) -> DataFrame:
    """Window counts -> (window_start, window_end, day, hour_label, count, print)."""
    flat = W.flatten_window(batch)
    return flat.select("window_start", "window_end",
                       F.to_date("window_start").alias("day"),
                       hour_end_label(F.col("window_start")).alias("hour_label"),
                       "count", F.col("count").cast("string").alias("print"))


def region_rows(batch: DataFrame, key: str = "headquarter") -> DataFrame:
    """Region window counts -> rows with the reference's "(hq,count)" text."""
    flat = W.flatten_window(batch)
    return flat.select("window_start", "window_end", key,
                       F.to_date("window_start").alias("day"),
                       hour_end_label(F.col("window_start")).alias("hour_label"), "count",
                       F.format_string("(%s,%d)", F.col(key), F.col("count")).alias("print"))


# ------------------------------------------------------------ reference jobs

def event_count(spark: SparkSession, input_path: str, checkpoint_path: str, output_path: str,
                files_per_trigger: int = 100, fmt: str = "text") -> StreamingQuery:
    """ST1 (EventCount): drop-offs per hour, update mode, one folder per
    (day, hour label) holding the count."""
    trips = unify_trips(read_trips_stream(spark, input_path, files_per_trigger))
    counts = W.windowed_counts(trips, "dropoff", "1 hour")
    writer = label_writer(output_path, hourly_rows, ["day", "hour_label"], fmt, text_col="print")
    return run_available(counts, writer, checkpoint_path, "update", "EventCount")


def region_event_count(spark: SparkSession, input_path: str, checkpoint_path: str,
                       output_path: str, files_per_trigger: int = 100, regions=TAXI_REGIONS,
                       fmt: str = "text") -> StreamingQuery:
    """ST3 (RegionEventCount): drop-offs per (headquarter, hour), complete
    mode, "(hq,count)" lines per (day, hour label) folder."""
    trips = unify_trips(read_trips_stream(spark, input_path, files_per_trigger))
    counts = W.region_counts(trips, regions, "Dropoff_longitude", "Dropoff_latitude", "dropoff",
                             width="1 hour")
    writer = label_writer(output_path, region_rows, ["day", "hour_label"], fmt, text_col="print")
    return run_available(counts, writer, checkpoint_path, "complete", "RegionEventCount")


def trending_arrivals(spark: SparkSession, input_path: str, checkpoint_path: str,
                      output_path: str, files_per_trigger: int = 100, regions=TAXI_REGIONS,
                      width: str = "10 minutes", width_s: int = 600, min_count: int = 10,
                      ratio: float = 2, fmt: str = "text") -> StreamingQuery:
    """ST4 (TrendingArrivals): 10-minute region counts in complete mode; in
    each micro-batch, windows with count >= 10 and >= 2x the previous window
    are written to one folder per (day, ms-of-day) label (SNK4), and an alert
    line per trend goes to ``<output>_alerts`` (SNK6): the state is complete, so
    the alert table is replaced too and a replayed batch changes nothing."""
    trips = unify_trips(read_trips_stream(spark, input_path, files_per_trigger))
    counts = W.region_counts(trips, regions, "Dropoff_longitude", "Dropoff_latitude", "dropoff",
                             width=width)

    alerts_path = output_path.rstrip("/") + "_alerts"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        trends = W.trending(W.flatten_window(batch), width_s=width_s, min_count=min_count,
                            ratio=ratio).withColumn("day", F.to_date("window_start")).persist()
        # complete mode: the batch is the whole state, so the trend table is
        # replaced as a whole (one partitioned write, no per-row jobs)
        out = trends.select("trend", "day", "timestamp") if fmt == "text" else trends
        out.write.mode("overwrite").partitionBy("day", "timestamp").format(fmt).save(output_path)
        W.trend_alerts(trends).select("alert").write.mode("overwrite").text(alerts_path)
        trends.unpersist()

    return run_available(counts, write_batch, checkpoint_path, "complete", "TrendingArrivals")


def count_by_type_stream(spark: SparkSession, input_path: str, checkpoint_path: str,
                         output_path: str, files_per_trigger: int = 100) -> StreamingQuery:
    """ST5 (StreamDemo): running count per trip type, complete mode; records of
    unknown types are no trips."""
    trips = unify_trips(read_trips_stream(spark, input_path, files_per_trigger))
    counts = W.count_by_type(trips.select(F.col("Type").alias("type")), "type")
    return run_available(counts, replace_writer(output_path, lambda b: b), checkpoint_path,
                         "complete", "CountByType")


def to_console(stream: DataFrame, mode: str = "complete", truncate: bool = False):
    """SNK5: console sink (demos); jobs use table sinks."""
    return (stream.writeStream.outputMode(mode).format("console")
            .option("truncate", truncate).start())


def telemetry_ingest(spark: SparkSession, landing: str, checkpoint_path: str, output_path: str,
                     files_per_trigger: int = 100) -> StreamingQuery:
    """ST10: JSON telemetry records dropped in a landing folder, normalised
    (SRC8) and appended to a table, partitioned by micro-batch."""
    from sparkiln.sources.telemetry import normalize_telemetry, read_telemetry
    stream = read_telemetry(spark, landing, stream=True)
    return run_available(stream, append_writer(output_path, normalize_telemetry),
                         checkpoint_path, "append", "TelemetryIngest")


def _latest_totals(spark: SparkSession, path: str, key_type: str, key: str, before: int
                   ) -> DataFrame:
    """Rows per object up to the last batch before ``before`` (none for the first)."""
    schema = f"{key} {key_type}, _total long, batch_id long"
    if before == 0:
        return spark.createDataFrame([], schema).drop("batch_id")
    all_ = spark.read.schema(schema).parquet(path).where(F.col("batch_id") < before)
    last = all_.agg(F.max("batch_id")).first()[0]
    return all_.where(F.col("batch_id") == (-1 if last is None else last)).drop("batch_id")


def tracks_stream(stream: DataFrame, checkpoint_path: str, output_path: str, key: str, ts: str,
                  cols: Sequence[str], tie: str | None = None, out: str = "seq") -> StreamingQuery:
    """AGG25 as a stream: each object's positions, numbered on across micro-batches.

    A batch's positions are ranked per object in time order (``tracks``, so a hot
    object is spread over tasks) and the number of positions that the object had before is
    added.  That number is the job's state: one row per object, written under
    ``<output>_totals`` in a folder per batch, made from the folder of the batch before.
    Both tables are written by batch, so a batch that is killed and run again
    replaces its own folders and doubles nothing.  Positions that arrive in a later batch
    come later in the track, whatever their time.
    """
    totals_path = output_path.rstrip("/") + "_totals"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _latest_totals(spark, totals_path, batch.schema[key].dataType.simpleString(), key,
                                batch_id).select(F.col(key).alias("_key"), "_total")
        ranked = tracks(batch, key, ts, cols, tie, out)
        same = F.col(key).eqNullSafe(F.col("_key"))
        rows = ranked.join(before, same, "left").select(
            key, (F.col(out) + F.coalesce("_total", F.lit(0))).alias(out), ts, *cols,
            F.lit(batch_id).cast("long").alias("batch_id"))
        write_partitioned(rows, output_path, ["batch_id"])
        added = ranked.groupBy(key).agg(F.count(F.lit(1)).alias("_added"))
        totals = before.withColumn("_had", F.lit(True)).join(added, same, "full").select(
            F.when(F.col("_had"), F.col("_key")).otherwise(F.col(key)).alias(key),
            (F.coalesce("_total", F.lit(0)) + F.coalesce("_added", F.lit(0))).alias("_total"),
            F.lit(batch_id).cast("long").alias("batch_id"))
        write_partitioned(totals, totals_path, ["batch_id"])

    return run_available(stream, write_batch, checkpoint_path, "append", "Tracks")


def read_tracks(spark: SparkSession, path: str, schema: StructType, key: str, ts: str,
                cols: Sequence[str], out: str = "seq") -> DataFrame:
    """The table of ``tracks_stream``: key, seq, ts, cols."""
    fields = [schema[key], StructField(out, LongType()), *[schema[c] for c in (ts, *cols)]]
    return spark.read.schema(StructType([*fields, StructField("batch_id", LongType())])).parquet(
        path).drop("batch_id")


_WINDOW = "window_start"


def trend_deltas(counts: DataFrame, checkpoint_path: str, output_path: str,
                 key: str = "headquarter", width_s: int = 600, min_count: int = 10,
                 ratio: float = 2) -> StreamingQuery:
    """ST4/SNK4/SNK6 without rewriting the state: trends of windowed counts in update mode.

    A micro-batch holds the windows whose count changed.  Their counts are added to a log
    (``counts``, by day and batch); only these windows and their successors are judged
    anew, from the latest counts of those windows and the ones before them.  Their trends go
    to label folders (``trends/batch_id=/day=/timestamp=``), one alert line each to
    ``alerts``, and last, as the pointer that publishes the batch, the list of judged
    windows to ``windows``.  ``read_trends`` takes every window from the last batch that
    judged it, so a batch that is killed half-way is not seen until it has run again,
    which replaces its own folders, and a window whose trend is over loses it.
    """
    root = output_path.rstrip("/")
    step = F.expr(f"INTERVAL {int(width_s)} SECONDS")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        number = F.lit(batch_id).cast("long").alias("batch_id")
        touched = materialize(W.flatten_window(batch).select(
            key, _WINDOW, F.col("count").cast("long").alias("count"),
            F.to_date(_WINDOW).alias("day"), number), "touched")
        ends = touched.agg(F.min(F.col(_WINDOW) - step).alias("lo"),
                           F.max(F.col(_WINDOW) + step).alias("hi")).first()
        if ends["lo"] is None:
            return
        write_partitioned(touched, f"{root}/counts", ["day", "batch_id"])
        judged = materialize(touched.select(_WINDOW).unionByName(
            touched.select((F.col(_WINDOW) + step).alias(_WINDOW))).distinct(), "judged")
        needed = judged.unionByName(judged.select((F.col(_WINDOW) - step).alias(_WINDOW))).distinct()
        log = spark.read.schema(touched.schema).parquet(f"{root}/counts").where(
            (F.col("batch_id") <= batch_id)
            & F.col("day").between(F.lit(ends["lo"].date()), F.lit(ends["hi"].date())))
        latest = log.join(needed, _WINDOW, "left_semi").groupBy(key, _WINDOW).agg(
            F.max(F.struct("batch_id", "count"))["count"].alias("count"))
        trends = materialize(W.trending(latest, key, _WINDOW, width_s, min_count, ratio)
                             .join(judged, _WINDOW, "left_semi"), "trends")
        write_partitioned(trends.withColumn("day", F.to_date(_WINDOW)).withColumn("batch_id", number),
                          f"{root}/trends", ["batch_id", "day", "timestamp"])
        write_partitioned(W.trend_alerts(trends, key).withColumn("batch_id", number),
                          f"{root}/alerts", ["batch_id"], "text", "alert")
        write_partitioned(judged.withColumn("batch_id", number), f"{root}/windows", ["batch_id"])

    return run_available(counts, write_batch, checkpoint_path, "update", "TrendDeltas")


def read_trends(spark: SparkSession, path: str, counts: StructType, key: str = "headquarter"
                ) -> DataFrame:
    """The published trends of ``trend_deltas`` (``counts``: schema of its input): key,
    window_start, count, prev_count, timestamp, trend."""
    root, start = path.rstrip("/"), counts["window"].dataType["start"].dataType
    window, batch = StructField(_WINDOW, start), StructField("batch_id", LongType())
    last = (spark.read.schema(StructType([window, batch])).parquet(f"{root}/windows")
            .groupBy(_WINDOW).agg(F.max("batch_id").alias("batch_id")))
    rows = spark.read.schema(StructType([
        counts[key], window, StructField("count", LongType()), StructField("prev_count", LongType()),
        StructField("trend", StringType()), batch, StructField("timestamp", LongType())
    ])).parquet(f"{root}/trends")
    return rows.join(last, [_WINDOW, "batch_id"]).select(
        key, _WINDOW, "count", "prev_count", "timestamp", "trend")
