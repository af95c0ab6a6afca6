"""Registered queries that reach sources, sinks and rules by a round trip: a
given table is written with a sink into the shared folder, read back with the
matching source, and compared with SQL over the table itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkiln.functions.labels import MAKE_LABELS, normalize_label
from sparkiln.functions.time import parse_timestamp
from sparkiln.operators import geo as GEO
from sparkiln.operators import kmeans as KM
from sparkiln.operators import stats as ST
from sparkiln.operators import timeline as TL
from sparkiln.operators import windows as W
from sparkiln.plans import catalog as CAT
from sparkiln.plans import params as P
from sparkiln.plans.oracle import _KMC, kmeans_2d_sql
from sparkiln.session import scratch_path
from sparkiln.sinks import files as SINK
from sparkiln.sources import files as SRC
from sparkiln.sources import trips as TRIPS
from sparkiln.sources.tables import load_table
from sparkiln.streaming import jobs as JOBS

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str):
    def deco(fn):
        QUERIES[name] = fn
        ORACLE[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- trips

def _raw_trips(spark, sf_dir):
    """events as raw trip records: two known types and others, 22 text fields."""
    ev = load_table(spark, sf_dir, "events")
    text = {"_c1": F.col("user_id") % 3, "_c2": F.col("ts"), "_c3": F.col("ts"),
            "_c8": F.col("event_id") % 7, "_c9": F.col("event_id") % 5,
            "_c10": F.col("event_id") % 9, "_c11": F.col("event_id") % 11}
    kind = (F.when(F.col("event_id") % 3 == 0, "yellow")
            .when(F.col("event_id") % 3 == 1, "green").otherwise("other"))
    cols = [kind.alias("_c0")]
    cols += [text[f"_c{i}"].cast("string").alias(f"_c{i}") if f"_c{i}" in text
             else F.lit("x" if i == 4 else str(i)).alias(f"_c{i}") for i in range(1, 22)]
    return ev.select(*cols)


_TRIPS_SQL = """
SELECT CASE event_id % 3 WHEN 0 THEN 'yellow' ELSE 'green' END AS "Type",
       CAST(user_id % 3 AS INTEGER) AS "VendorID", ts AS dropoff,
       CAST(CASE event_id % 3 WHEN 0 THEN event_id % 9 ELSE event_id % 7 END AS DOUBLE) AS lon,
       CAST(CASE event_id % 3 WHEN 0 THEN event_id % 11 ELSE event_id % 5 END AS DOUBLE) AS lat,
       CAST(CASE event_id % 3 WHEN 1 THEN 21 END AS INTEGER) AS "Trip_type",
       CAST(CASE event_id % 3 WHEN 0 THEN event_id % 7 ELSE 5 END AS DOUBLE) AS "Rate_codeID"
FROM events WHERE event_id % 3 < 2"""


@query("unify_trips", _TRIPS_SQL)
def q_unify_trips(spark, sf_dir):
    path = scratch_path(spark, "trips")
    _raw_trips(spark, sf_dir).write.csv(path)
    trips = TRIPS.unify_trips(TRIPS.read_trips(spark, path))
    return trips.select("Type", "VendorID", F.col("dropoff").cast("timestamp_ntz").alias("dropoff"),
                        F.col("Dropoff_longitude").cast("double").alias("lon"),
                        F.col("Dropoff_latitude").cast("double").alias("lat"),
                        "Trip_type", "Rate_codeID")


@query("stream_trips_by_type", f"""
SELECT "Type" AS type, count(*) AS "count" FROM ({_TRIPS_SQL}) GROUP BY 1""")
def q_stream_trips_by_type(spark, sf_dir):
    base = scratch_path(spark, "trips-by-type")
    _raw_trips(spark, sf_dir).repartition(6).write.csv(f"{base}/in")
    JOBS.count_by_type_stream(spark, f"{base}/in", f"{base}/checkpoint", f"{base}/out",
                              files_per_trigger=2)
    return spark.read.parquet(f"{base}/out")


@query("stream_hourly_csv", """
SELECT CAST(ts AS DATE) AS day, CAST((hour(ts) + 1) * 3600000 AS BIGINT) AS hour_label,
       CAST(count(*) AS BIGINT) AS "count"
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""")
def q_stream_hourly_csv(spark, sf_dir):
    """ST2: complete mode, csv label folders, several micro-batches."""
    base = scratch_path(spark, "hourly-csv")
    ev = load_table(spark, sf_dir, "events").select("ts")
    ev.repartition(4).write.parquet(f"{base}/in")
    stream = JOBS.table_stream(spark, f"{base}/in", ev.schema, files_per_trigger=2)
    counts = W.windowed_counts(stream, "ts", "1 hour")
    writer = SINK.label_writer(
        f"{base}/out", lambda b: JOBS.hourly_rows(b).select("count", "day", "hour_label"),
        ["day", "hour_label"], "csv")
    JOBS.run_available(counts, writer, f"{base}/checkpoint", "complete")
    return spark.read.schema("count long, day date, hour_label long").csv(f"{base}/out").select(
        "day", "hour_label", "count")


# ---------------------------------------------------------------- files

@query("key_value_lines", """
SELECT CAST(c_nationkey AS VARCHAR) || chr(9) || CAST(count(*) AS VARCHAR) AS line
FROM customer GROUP BY c_nationkey""")
def q_key_value_lines(spark, sf_dir):
    path = scratch_path(spark, "key-value")
    counts = load_table(spark, sf_dir, "customer").groupBy("c_nationkey").count()
    SINK.write_kv_text(counts, path, "c_nationkey", "count")
    return SRC.read_lines(spark, path).select(F.col("value").alias("line"))


@query("corpus_lines", """
SELECT 'lang=' || lang AS folder, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines
FROM documents WHERE text IS NOT NULL GROUP BY lang""")
def q_corpus_lines(spark, sf_dir):
    path = scratch_path(spark, "corpus")
    docs = load_table(spark, sf_dir, "documents").where("text IS NOT NULL")
    SINK.write_partitioned(docs.select("text", "lang"), path, ["lang"], "text", text_col="text")
    lines = SRC.read_corpus(spark, path)
    return lines.groupBy(F.split_part("doc_key", F.lit("."), F.lit(1)).alias("folder")).agg(
        F.count(F.lit(1)).alias("n_lines"))


@query("dictionary_ids", """
SELECT CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS id, p_type AS term
FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL)""")
def q_dictionary_ids(spark, sf_dir):
    path = scratch_path(spark, "dictionary")
    terms = SRC.dictionary_from_values(load_table(spark, sf_dir, "part"), "p_type")
    # one entry per line, in many files that follow each other; encoded, because a value may
    # hold what ends a line or is trimmed off it
    (terms.repartitionByRange("id").sortWithinPartitions("id").select(F.url_encode("term"))
     .write.text(path))
    return SRC.read_dictionary(spark, path).select("id", F.url_decode("term").alias("term"))


@query("point_lines", """
SELECT CAST(vec_id AS VARCHAR) AS id, CAST(embedding[1] AS DOUBLE) AS x,
       CAST(embedding[2] AS DOUBLE) AS y
FROM embeddings WHERE embedding[1] IS NOT NULL AND embedding[2] IS NOT NULL""")
def q_point_lines(spark, sf_dir):
    path = scratch_path(spark, "points")
    emb = load_table(spark, sf_dir, "embeddings")
    points = emb.select(F.col("vec_id").alias("id"),
                        F.element_at("embedding", 1).cast("double").alias("x"),
                        F.element_at("embedding", 2).cast("double").alias("y"))
    SINK.write_csv(points, path)  # its header line is no point
    return SRC.read_points(spark, path)


@query("triples", """
SELECT CAST(l_linenumber AS INTEGER) AS term_id, CAST(l_orderkey AS INTEGER) AS doc_id,
       CAST(l_extendedprice AS DOUBLE) AS value
FROM lineitem""")
def q_triples(spark, sf_dir):
    path = scratch_path(spark, "triples")
    li = load_table(spark, sf_dir, "lineitem")
    li.select("l_linenumber", "l_orderkey", F.col("l_extendedprice").cast("double")).write.option(
        "sep", "\t").csv(path)
    return SRC.read_triples(spark, path)


@query("csv_table", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice
FROM orders""")
def q_csv_table(spark, sf_dir):
    path = scratch_path(spark, "csv")
    o = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("double"))
    SINK.write_csv(o, path)
    return SRC.read_csv_table(spark, path, o.schema)


def _clusters(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings")
    points = emb.select(F.col("vec_id").alias("id"),
                        F.element_at("embedding", 1).cast("double").alias("x"),
                        F.element_at("embedding", 2).cast("double").alias("y"))
    return KM.kmeans_2d(points, k=P.KMEANS_2D_K, max_iter=P.KMEANS_2D_MAX_ITER,
                        tol=P.KMEANS_2D_TOL, seed=P.KMEANS_SEED)


def q_cluster_output(spark, sf_dir):
    """SNK7 + SRC11; its SQL is that of ``kmeans_2d_assign``."""
    path = scratch_path(spark, "clusters")
    result = _clusters(spark, sf_dir)
    SINK.write_clusters(result.assignments, result.centroids, path)
    return SRC.read_cluster_output(spark, f"{path}/assignments").select(
        F.col("id").alias("vec_id"), "cluster")


def q_cluster_report(spark, sf_dir):
    """SNK8: the cosine run's report, written round by round and read back: top terms
    with the loss of their round.  The run is broken off after three rounds and
    continued from what the sink holds."""
    path = scratch_path(spark, "report")
    triples = CAT._tfidf_packed(spark, sf_dir)
    settings = dict(k=P.KMEANS_COS_K, tol=P.KMEANS_COS_TOL, seed=P.KMEANS_SEED)
    KM.report_clusters(triples, path, max_iter=3, **settings)
    KM.report_clusters(triples, path, max_iter=P.KMEANS_COS_MAX_ITER, **settings)
    report = SINK.RoundReport(spark, path)
    return report.top_terms().join(report.losses(), "iteration").select(
        "iteration", "cluster", "rank", "term_id", F.round("value", 9).alias("value"),
        F.round("loss", 6).alias("loss"))


def q_kmeans_2d_emptied(spark, sf_dir):
    """CL7: with 25 clusters begun by chance some stay empty at once, and the loop stops
    there instead of going on to its last round."""
    result = KM.kmeans_2d(CAT._points_2d(spark, sf_dir), k=25, max_iter=P.KMEANS_2D_MAX_ITER,
                          tol=P.KMEANS_2D_TOL, seed=P.KMEANS_SEED)
    return result.history.select("iteration", "cluster", F.round("x", 9).alias("x"),
                                 F.round("y", 9).alias("y"), "size")


def q_stream_tracks(spark, sf_dir):
    """AGG25 as a stream: positions arrive in three stretches of time, each drained by a
    run of its own that goes on from the last one's state."""
    base = scratch_path(spark, "stream-tracks")
    events = load_table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id",
        (F.get_json_object("props", "$.k").try_cast("double") - 50).alias("lat"),
        (F.col("value") - 180).alias("lon"))
    ends = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    if ends["lo"] is None:
        return GEO.tracks(events, "user_id", "ts", ["event_id", "lat", "lon"], tie="event_id")
    step = (ends["hi"] - ends["lo"]) / 3
    cuts = [ends["lo"] + step, ends["lo"] + 2 * step]
    part = sum(((F.col("ts") > F.lit(c)).cast("int") for c in cuts), F.lit(0))
    for i in range(3):
        events.where(F.coalesce(part, F.lit(0)) == i).write.mode("append").parquet(f"{base}/landing")
        JOBS.tracks_stream(JOBS.table_stream(spark, f"{base}/landing", events.schema), f"{base}/checkpoint",
                         f"{base}/out", "user_id", "ts", ["event_id", "lat", "lon"], tie="event_id")
    return JOBS.read_tracks(spark, f"{base}/out", events.schema, "user_id", "ts",
                          ["event_id", "lat", "lon"])


# ---------------------------------------------------------------- rules and values

@query("thousands", """
SELECT o_orderstatus, format('{:,}', CAST(sum(o_custkey) AS BIGINT)) AS total
FROM orders GROUP BY o_orderstatus""")
def q_thousands(spark, sf_dir):
    """FN12: numbers with thousands separators."""
    return load_table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(
        F.format_number(F.sum("o_custkey"), 0).alias("total"))


@query("parse_timestamp", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL
       ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 1 HOUR * (o_orderkey % 24) END
       AS parsed
FROM orders""")
def q_parse_timestamp(spark, sf_dir):
    """FN17: bad text becomes NULL."""
    o = load_table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 7 == 0, F.lit("no time")).otherwise(F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "),
        F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":00:00")))
    return o.select("o_orderkey", parse_timestamp(text, "yyyy-MM-dd HH:mm:ss")
                    .cast("timestamp_ntz").alias("parsed"))


def q_numeric_correlation(spark, sf_dir):
    """PRJ14: the numeric columns but for keys feed the correlation matrix;
    its SQL is that of ``correlation_matrix``."""
    li = load_table(spark, sf_dir, "lineitem")
    keys = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    c = ST.correlation_matrix(li, ST.numeric_columns(li, exclude=keys))
    return c.select("a", "b", F.round("r", 6).alias("r"))


@query("union_aligned", """
SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier""")
def q_union_aligned(spark, sf_dir):
    """SET2: positional union after aligning the columns."""
    def named(table, p):
        return load_table(spark, sf_dir, table).select(
            F.col(f"{p}_acctbal").alias("balance"), F.col(f"{p}_name").alias("name"),
            F.col(f"{p}_nationkey").alias("nation"))
    return TRIPS.union_aligned(named("customer", "c"), named("supplier", "s"),
                               ["name", "nation", "balance"])


# labels as users typed them, by part: lower case, capitals, mapped, with the " Tk" suffix
_MAKES = ("bmw", "ford tk", "gmc", "vw", "mercedes-b", "Chevrolet Tk", "landrover", "GMC",
          "gmc truck", "alfa romeo")
_MAKE_SQL = "CASE p_partkey % 10 " + " ".join(
    f"WHEN {i} THEN '{m}'" for i, m in enumerate(_MAKES)) + " END"
_MAPPED_SQL = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in MAKE_LABELS.items())


@query("normalize_make", rf"""
WITH t AS (SELECT p_partkey, {_MAKE_SQL} AS make FROM part),
u AS (
  SELECT p_partkey, make, CASE WHEN regexp_matches(make, '[A-Z]') THEN make ELSE
         array_to_string(list_transform(range(1, length(make) + 1), lambda i:
           CASE WHEN i = 1 OR NOT regexp_matches(substr(make, i - 1, 1), '[A-Za-z]')
                THEN upper(substr(make, i, 1)) ELSE lower(substr(make, i, 1)) END), '') END AS t1
  FROM t)
SELECT p_partkey, make,
       regexp_replace(CASE t1 {_MAPPED_SQL} ELSE t1 END, ' Tk', ' Truck', 'g') AS label
FROM u""")
def q_normalize_make(spark, sf_dir):
    """FN7, FN9, FN10, FN25 with labels that reach every branch."""
    p = load_table(spark, sf_dir, "part")
    make = F.element_at(F.array(*[F.lit(m) for m in _MAKES]),
                        (F.col("p_partkey") % 10 + 1).cast("int"))
    return p.select("p_partkey", make.alias("make")).select(
        "p_partkey", "make", normalize_label(F.col("make")).alias("label"))


@query("yearly_mean_gap", """
WITH m AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, avg(o_totalprice) AS mean_value
  FROM orders WHERE year(o_orderdate) NOT IN (1994, 1996) GROUP BY 1),
y AS (SELECT CAST(unnest(generate_series(min(year), max(year))) AS INTEGER) AS year FROM m)
SELECT y.year, round(m.mean_value, 6) AS mean_value FROM y LEFT JOIN m USING (year)""")
def q_yearly_mean_gap(spark, sf_dir):
    """JN3 with years that have no rows."""
    out = TL.yearly_mean_reindexed(load_table(spark, sf_dir, "orders"), F.year("o_orderdate"),
                                   "o_totalprice",
                                   where=~F.year("o_orderdate").isin(1994, 1996))
    return out.select("year", F.round("mean_value", 6).alias("mean_value"))


@query("monthly_orders", """
SELECT month, new_rows,
       CAST(sum(new_rows) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS total_rows
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS new_rows
      FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1)""")
def q_monthly_orders(spark, sf_dir):
    """AGG26 over many months."""
    return TL.monthly_increments(load_table(spark, sf_dir, "orders"), "o_orderdate")


_LENGTHS = "(SELECT doc_id, lang, CAST(n_chars AS DOUBLE) AS v FROM documents WHERE lang IS NOT NULL)"


@query("box_outliers_length", f"""
WITH q AS (
  SELECT lang, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3
  FROM {_LENGTHS} WHERE v IS NOT NULL GROUP BY 1)
SELECT d.doc_id, d.lang, d.v FROM {_LENGTHS} d JOIN q USING (lang)
WHERE d.v < q.q1 - 1.5 * (q.q3 - q.q1) OR d.v > q.q3 + 1.5 * (q.q3 - q.q1)""")
def q_box_outliers_length(spark, sf_dir):
    """AGG21 with values outside the fences."""
    d = load_table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.col("n_chars").cast("double").alias("v"))
    return ST.box_outliers(d, "lang", "v", keep=["doc_id"])


@query("stats_with_gaps", """
WITH g AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS k,
                  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_totalprice AS DOUBLE) END AS v
           FROM orders)
SELECT k, count(v) AS n, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.5), 6) AS median
FROM g WHERE k IS NOT NULL GROUP BY k""")
def q_stats_with_gaps(spark, sf_dir):
    """AGG14, AGG21: NaN values and NULL keys are left out."""
    o = load_table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("k"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(float("nan")))
        .otherwise(F.col("o_totalprice").cast("double")).alias("v"))
    box = ST.box_stats(o, "k", "v").select("k", "n", F.round("median", 6).alias("median"))
    means = ST.group_means(o, ["k"], ["v"]).select("k", F.round("avg_v", 6).alias("mean"))
    return box.join(means, "k").select("k", "n", "mean", "median")


QUERIES |= {"cluster_output": q_cluster_output, "cluster_report": q_cluster_report,
            "numeric_correlation": q_numeric_correlation, "stream_tracks": q_stream_tracks,
            "kmeans_2d_emptied": q_kmeans_2d_emptied}
ORACLE["cluster_report"] = (f"SELECT t.*, l.loss FROM ({_KMC['top']}) t "
                            f"JOIN ({_KMC['loss']}) l USING (iteration)")
ORACLE["kmeans_2d_emptied"] = kmeans_2d_sql(25, P.KMEANS_2D_MAX_ITER, P.KMEANS_2D_TOL,
                                            P.KMEANS_SEED)["history"]
#: Queries whose SQL is that of another registered query.
SAME_SQL = {"cluster_output": "kmeans_2d_assign", "stream_tracks": "tracks",
            "numeric_correlation": "correlation_matrix"}
