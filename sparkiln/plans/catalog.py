"""Registered queries: each maps the driver tables onto one operator.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names and types match the oracle SQL in ``sparkiln.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkiln.operators import windows as W
from sparkiln.plans import params as P
from sparkiln.sources.files import register_view
from sparkiln.sources.tables import load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _events_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with the (x, y) plane used by the region operators."""
    ev = load_table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "ts",
        F.col("value").alias("x"),
        F.get_json_object("props", "$.k").try_cast("double").alias("y"),
    )


# ---------------------------------------------------------------- windows

@query("hourly_counts")
def q_hourly_counts(spark, sf_dir):
    return W.hourly_counts(load_table(spark, sf_dir, "events"), ts="ts", width="1 hour")


@query("count_by_type")
def q_count_by_type(spark, sf_dir):
    return W.count_by_type(load_table(spark, sf_dir, "events"), "event_type")


@query("in_polygon")
def q_in_polygon(spark, sf_dir):
    from sparkiln.functions.geo import in_polygon
    ev = _events_plane(spark, sf_dir)
    return ev.select(
        "event_id",
        *[in_polygon(F.col("x"), F.col("y"), poly).alias(f"in_{name}")
          for name, poly in P.EVENT_REGIONS],
    )


@query("label_region")
def q_label_region(spark, sf_dir):
    ev = _events_plane(spark, sf_dir)
    return W.label_region(ev, "x", "y", P.EVENT_REGIONS).select("event_id", "headquarter")


@query("region_counts")
def q_region_counts(spark, sf_dir):
    ev = _events_plane(spark, sf_dir)
    return W.flatten_window(W.region_counts(ev, P.EVENT_REGIONS, "x", "y", "ts", width="1 hour"))


@query("trending")
def q_trending(spark, sf_dir):
    ev = _events_plane(spark, sf_dir)
    counts = W.flatten_window(W.region_counts(ev, P.EVENT_REGIONS, "x", "y", "ts",
                                              width=P.TREND_WIDTH))
    return W.trending(counts, key="headquarter", start="window_start",
                      width_s=P.TREND_WIDTH_S, min_count=P.TREND_MIN_COUNT,
                      ratio=P.TREND_RATIO)


@query("trend_alerts")
def q_trend_alerts(spark, sf_dir):
    return W.trend_alerts(q_trending(spark, sf_dir))


# ---------------------------------------------------------------- text and TF-IDF

from sparkiln.operators import text as TX  # noqa: E402
from sparkiln.operators import tfidf as TI  # noqa: E402


def _cores(spark):
    """The driver's text tables are files of one row group, which one task reads:
    the text queries deal them over the cores by choice."""
    return spark.sparkContext.defaultParallelism


@query("word_count")
def q_word_count(spark, sf_dir):
    return TX.word_count(load_table(spark, sf_dir, "documents"), col="text",
                         partitions=_cores(spark))


@query("word_length_buckets")
def q_word_length_buckets(spark, sf_dir):
    # each document read as a text file: one reference map() call per line
    lines = TX.explode_lines(load_table(spark, sf_dir, "documents"), "text")
    return TX.word_length_buckets(lines, "value", strict=True, partitions=_cores(spark))


@query("clean_tokens")
def q_clean_tokens(spark, sf_dir):
    return TX.clean_tokens(load_table(spark, sf_dir, "documents"), "doc_id", "text",
                           partitions=_cores(spark))


def _triples(spark, sf_dir):
    """Document-term counts with data-derived dictionaries (see build_dictionaries)."""
    return TX.corpus_triples(load_table(spark, sf_dir, "documents"), "doc_id", "text",
                             min_df=P.MIN_DF, max_df_ratio=P.MAX_DF_RATIO,
                             partitions=_cores(spark))


def _triples_in_blocks(spark, sf_dir):
    """The triples by block of documents, and the number of blocks."""
    return TX.corpus_blocks(load_table(spark, sf_dir, "documents"), "doc_id", "text",
                            min_df=P.MIN_DF, max_df_ratio=P.MAX_DF_RATIO,
                            partitions=_cores(spark))


def _tfidf_written(spark, sf_dir, columns=("doc_id", "term_id", "tfidf")):
    """TF-IDF rows as a written table: computed once for all steps that read them."""
    triples, n = _triples_in_blocks(spark, sf_dir)
    with planned_with(spark, in_blocks(n)):
        return materialize(TI.tfidf(triples, block=TX.BLOCK).select(*columns), "tfidf")


def _tfidf_packed(spark, sf_dir):
    """TF-IDF vectors packed by tile, whole blocks of documents each, without an exchange."""
    triples, n = _triples_in_blocks(spark, sf_dir)
    tiles = tiles_of_blocks(n, sized_partitions(spark, triples.count(), KM.PACKED_ROWS))
    tile = tile_of(spark, "doc_id", n, tiles)
    with planned_with(spark, in_blocks(n)):
        rows = TI.tfidf(triples, block=TX.BLOCK).select(
            tile.alias("tile"), F.col("doc_id").alias("doc"), F.col("term_id").alias("term"),
            F.col("tfidf").alias("value"))
        return Packed(rows, (n, tiles))


def _r(c, digits=9):
    return F.round(F.col(c), digits).alias(c)


@query("doc_term_counts")
def q_doc_term_counts(spark, sf_dir):
    return _triples(spark, sf_dir)


@query("tf")
def q_tf(spark, sf_dir):
    tf = TI.term_frequency(_triples_in_blocks(spark, sf_dir)[0], block=TX.BLOCK)
    return tf.select("doc_id", "term_id", "count", _r("tf"))


@query("doc_total")
def q_doc_total(spark, sf_dir):
    return TI.doc_total(_triples(spark, sf_dir))


@query("tfidf")
def q_tfidf(spark, sf_dir):
    return _tfidf_written(spark, sf_dir, ["doc_id", "term_id", _r("tf"), _r("idf"), _r("tfidf")])


@query("unique_terms")
def q_unique_terms(spark, sf_dir):
    return TI.unique_terms(_triples(spark, sf_dir))


@query("doc_vectors")
def q_doc_vectors(spark, sf_dir):
    v = TI.doc_vectors(TI.tfidf(_triples(spark, sf_dir)))
    text = F.array_join(F.transform(
        "vector", lambda e: F.concat(e["term"].cast("string"), F.lit(":"),
                                     F.format_string("%.6e", e["value"]))), ",")
    return v.select("doc_id", "n_terms", _r("norm"), text.alias("vector_text"))


# ---------------------------------------------------------------- calendar

from sparkiln.operators import timeline as TL  # noqa: E402


@query("daily_counts_filled")
def q_daily_counts_filled(spark, sf_dir):
    return TL.daily_counts_filled(load_table(spark, sf_dir, "orders"), "o_orderdate")


@query("first_per_day")
def q_first_per_day(spark, sf_dir):
    o = load_table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"), "o_orderkey", "o_totalprice")
    o = TL.with_group_count(o.where(F.col("date").isNotNull()), "date", out="day_count")
    first = TL.first_per_key(o, "date", [F.desc("day_count"), F.asc("o_orderkey")])
    return first.select("date", "o_orderkey", "o_totalprice", "day_count")


@query("sql_year_month")
def q_sql_year_month(spark, sf_dir):
    register_view(load_table(spark, sf_dir, "orders"), "sparkiln_orders")
    return TL.events_in_month(spark, "sparkiln_orders", "o_orderdate", 1997, (1, 12))


@query("yearly_mean_reindexed")
def q_yearly_mean_reindexed(spark, sf_dir):
    o = load_table(spark, sf_dir, "orders")
    out = TL.yearly_mean_reindexed(
        o, F.year("o_orderdate"), "o_totalprice",
        where=(F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
    return out.select("year", _r("mean_value", 6))


@query("monthly_increments")
def q_monthly_increments(spark, sf_dir):
    return TL.monthly_increments(load_table(spark, sf_dir, "events"), "ts")


# ---------------------------------------------------------------- grouped statistics

from sparkiln.operators import stats as ST  # noqa: E402

LINEITEM_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("mean_by_year")
def q_mean_by_year(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    m = ST.group_means(li, [F.year("l_shipdate").alias("year")], ["l_extendedprice", "l_quantity"])
    return m.select("year", _r("avg_l_extendedprice", 6), _r("avg_l_quantity", 6))


@query("mean_by_year_key")
def q_mean_by_year_key(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    m = ST.group_means(li, [F.year("l_shipdate").alias("year"), "l_returnflag"],
                       ["l_extendedprice", "l_quantity"])
    return m.select("year", "l_returnflag", _r("avg_l_extendedprice", 6), _r("avg_l_quantity", 6))


@query("mean_by_status_year")
def q_mean_by_status_year(spark, sf_dir):
    o = load_table(spark, sf_dir, "orders")
    m = ST.group_means(o, ["o_orderstatus", F.year("o_orderdate").alias("year")], ["o_totalprice"])
    return m.select("o_orderstatus", "year", _r("avg_o_totalprice", 6))


@query("value_counts")
def q_value_counts(spark, sf_dir):
    return ST.value_counts(load_table(spark, sf_dir, "part"), "p_brand")


@query("top_n")
def q_top_n(spark, sf_dir):
    return ST.top_n(load_table(spark, sf_dir, "orders"), "o_custkey", 5)


@query("top_n_series")
def q_top_n_series(spark, sf_dir):
    o = load_table(spark, sf_dir, "orders")
    return ST.top_n_series(o, "o_custkey", F.year("o_orderdate"), n=5, at_year=1996)


@query("distinct_share")
def q_distinct_share(spark, sf_dir):
    d = ST.distinct_share(load_table(spark, sf_dir, "orders"), "o_orderstatus", "o_custkey")
    return d.select("o_orderstatus", "n_entities", _r("share"))


@query("distinct_values")
def q_distinct_values(spark, sf_dir):
    return ST.distinct_values(load_table(spark, sf_dir, "orders"), "o_orderpriority")


@query("correlation_matrix")
def q_correlation_matrix(spark, sf_dir):
    c = ST.correlation_matrix(load_table(spark, sf_dir, "lineitem"), LINEITEM_MEASURES)
    return c.select("a", "b", _r("r", 6))


@query("histogram")
def q_histogram(spark, sf_dir):
    h = ST.histogram(load_table(spark, sf_dir, "lineitem"), LINEITEM_MEASURES, bins=20)
    return h.select("column", "bin", _r("lo", 6), _r("hi", 6), "count")


@query("box_stats")
def q_box_stats(spark, sf_dir):
    b = ST.box_stats(load_table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")
    return b.select("o_orderpriority", "n", *[_r(c, 6) for c in
                    ("q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi")], "n_outliers")


@query("box_outliers")
def q_box_outliers(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    return ST.box_outliers(li, "l_returnflag", "l_extendedprice", keep=["l_orderkey", "l_linenumber"])


@query("melt_means")
def q_melt_means(spark, sf_dir):
    m = ST.melt_means(load_table(spark, sf_dir, "lineitem"), "l_returnflag", ["l_discount", "l_tax"])
    return m.select("l_returnflag", "variable", _r("mean_value", 6))


# ---------------------------------------------------------------- labels, projection, telemetry

from sparkiln.functions.labels import normalize_label  # noqa: E402
from sparkiln.operators import geo as GEO  # noqa: E402
from sparkiln.sources import telemetry as TM  # noqa: E402


def _event_points(spark, sf_dir):
    """events as a point table: lat = props.k - 50, lon = value - 180."""
    ev = _events_plane(spark, sf_dir)
    return ev.select("event_id", "ts", (F.col("y") - 50).alias("lat"),
                     (F.col("x") - 180).alias("lon"))


@query("normalize_label")
def q_normalize_label(spark, sf_dir):
    p = load_table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_name", normalize_label(F.col("p_name")).alias("label"))


@query("web_mercator")
def q_web_mercator(spark, sf_dir):
    pts = GEO.project_points(_event_points(spark, sf_dir), "lat", "lon")
    return pts.select("event_id", _r("x", 3), _r("y", 3))


@query("telemetry")
def q_telemetry(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events")
    parsed = ev.select("event_id", "ts", "event_type", "value",
                       F.from_json("props", "k INT").alias("j")).select(
        "event_id", "ts", "event_type", "value", F.col("j.k").alias("k"),
        (F.col("value") / 3).alias("velocity"))
    return TM.normalize_telemetry(parsed, drop=("event_type",), digits=2)


@query("positions")
def q_positions(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings")
    pairs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("embedding") / 2).cast("int") - 1),
        lambda i: F.struct(F.element_at("embedding", 2 * i + 1).cast("double").alias("satlatitude"),
                           F.element_at("embedding", 2 * i + 2).cast("double").alias("satlongitude")))
    nested = emb.select("vec_id", pairs.alias("positions"))
    return TM.explode_positions(nested, "positions", keep=["vec_id"])


@query("tracks")
def q_tracks(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id",
        (F.get_json_object("props", "$.k").try_cast("double") - 50).alias("lat"),
        (F.col("value") - 180).alias("lon"))
    return GEO.tracks(ev, "user_id", "ts", ["event_id", "lat", "lon"], tie="event_id")


# ---------------------------------------------------------------- clustering

from sparkiln.operators import kmeans as KM  # noqa: E402
from sparkiln.operators.packed import Packed  # noqa: E402
from sparkiln.session import (in_blocks, materialize, planned_with,  # noqa: E402
                              sized_partitions, tile_of, tiles_of_blocks)

def _points_2d(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("id"),
                      F.element_at("embedding", 1).cast("double").alias("x"),
                      F.element_at("embedding", 2).cast("double").alias("y"))


def _kmeans_2d(spark, sf_dir):
    return KM.kmeans_2d(
        _points_2d(spark, sf_dir), k=P.KMEANS_2D_K, max_iter=P.KMEANS_2D_MAX_ITER,
        tol=P.KMEANS_2D_TOL, seed=P.KMEANS_SEED)


@query("kmeans_2d_centroids")
def q_kmeans_2d_centroids(spark, sf_dir):
    r = _kmeans_2d(spark, sf_dir)
    return r.centroids.select("cluster", _r("x"), _r("y"), "size")


@query("kmeans_2d_assign")
def q_kmeans_2d_assign(spark, sf_dir):
    r = _kmeans_2d(spark, sf_dir)
    return r.assignments.select(F.col("id").alias("vec_id"), "cluster")


@query("kmeans_2d_history")
def q_kmeans_2d_history(spark, sf_dir):
    r = _kmeans_2d(spark, sf_dir)
    return r.history.select("iteration", "cluster", _r("x"), _r("y"), "size")


def _kmeans_cosine(vectors, with_loss=False):
    return KM.kmeans_cosine(vectors, k=P.KMEANS_COS_K, max_iter=P.KMEANS_COS_MAX_ITER,
                            tol=P.KMEANS_COS_TOL, seed=P.KMEANS_SEED, with_loss=with_loss)


@query("kmeans_cosine_assign")
def q_kmeans_cosine_assign(spark, sf_dir):
    return _kmeans_cosine(_tfidf_packed(spark, sf_dir)).round_assignments


@query("kmeans_cosine_centroids")
def q_kmeans_cosine_centroids(spark, sf_dir):
    return _kmeans_cosine(_tfidf_packed(spark, sf_dir)).round_centroids.select(
        "iteration", "cluster", "term_id", _r("value"))


@query("kmeans_loss")
def q_kmeans_loss(spark, sf_dir):
    return _kmeans_cosine(_tfidf_packed(spark, sf_dir), with_loss=True).losses.select(
        "iteration", _r("loss", 6))


@query("centroid_shift")
def q_centroid_shift(spark, sf_dir):
    return _kmeans_cosine(_tfidf_packed(spark, sf_dir)).history.select("iteration", "cluster", "size",
                                                        _r("shift"))


@query("top_terms")
def q_top_terms(spark, sf_dir):
    c = _kmeans_cosine(_tfidf_packed(spark, sf_dir)).round_centroids
    return KM.top_terms(c, 10, by=("iteration", "cluster")).select(
        "iteration", "cluster", "rank", "term_id", _r("value"))


@query("cosine_distance")
def q_cosine_distance(spark, sf_dir):
    t = _tfidf_packed(spark, sf_dir)
    d = KM.doc_centroid_distances(t, _kmeans_cosine(t).centroids, P.KMEANS_COS_K)
    return d.select("doc_id", "cluster", _r("distance"))


# ---------------------------------------------------------------- streams
#
# The events table read as a file stream and drained with availableNow; the
# sink is a table under the shared checkpoint folder, read back as the result.

from sparkiln.session import scratch_path  # noqa: E402
from sparkiln.sinks.files import label_writer, replace_writer  # noqa: E402
from sparkiln.sources.tables import table_path  # noqa: E402
from sparkiln.streaming import jobs as SJ  # noqa: E402


def _events_stream(spark, sf_dir):
    schema = load_table(spark, sf_dir, "events").schema
    return SJ.table_stream(spark, table_path(sf_dir, "events"), schema, files_per_trigger=4)


def _plane(stream):
    return stream.select("event_id", "ts", F.col("value").alias("x"),
                         F.get_json_object("props", "$.k").try_cast("double").alias("y"))


@query("stream_hourly_counts")
def q_stream_hourly_counts(spark, sf_dir):
    base = scratch_path(spark, "stream-hourly")
    counts = W.windowed_counts(_events_stream(spark, sf_dir).select("ts"), "ts", "1 hour")
    writer = label_writer(f"{base}/out", lambda b: SJ.hourly_rows(b).drop("print"),
                          ["day", "hour_label"], "parquet")
    SJ.run_available(counts, writer, f"{base}/checkpoint", "update")
    out = spark.read.parquet(f"{base}/out")
    return out.select("window_start", "window_end", F.col("day").cast("date"),
                      F.col("hour_label").cast("long"), F.col("count").cast("long"))


@query("stream_region_counts")
def q_stream_region_counts(spark, sf_dir):
    base = scratch_path(spark, "stream-region")
    counts = W.region_counts(_plane(_events_stream(spark, sf_dir)), P.EVENT_REGIONS, "x", "y",
                             "ts", width="1 hour")
    SJ.run_available(counts, replace_writer(f"{base}/out", W.flatten_window),
                     f"{base}/checkpoint", "complete")
    return spark.read.parquet(f"{base}/out").select("window_start", "window_end", "headquarter",
                                                    "count")


@query("stream_trending")
def q_stream_trending(spark, sf_dir):
    base = scratch_path(spark, "stream-trending")
    counts = W.region_counts(_plane(_events_stream(spark, sf_dir)), P.EVENT_REGIONS, "x", "y",
                             "ts", width=P.TREND_WIDTH)

    SJ.trend_deltas(counts, f"{base}/checkpoint", f"{base}/out", width_s=P.TREND_WIDTH_S,
                    min_count=P.TREND_MIN_COUNT, ratio=P.TREND_RATIO)
    return SJ.read_trends(spark, f"{base}/out", counts.schema)


@query("stream_count_by_type")
def q_stream_count_by_type(spark, sf_dir):
    base = scratch_path(spark, "stream-type")
    counts = W.count_by_type(_events_stream(spark, sf_dir), "event_type")
    SJ.run_available(counts, replace_writer(f"{base}/out", lambda b: b), f"{base}/checkpoint",
                     "complete")
    return spark.read.parquet(f"{base}/out")


# ---------------------------------------------------------------- models

from sparkiln.operators import models as ML  # noqa: E402

ML_SEED = 42
MESH_STEP, MESH_MARGIN = 0.02, 1.0


def _lineitem_xy(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    base = li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                     F.col("l_extendedprice").alias("x"), F.col("l_quantity").alias("y"))
    return ML.hash_split(base, "id", 0.75, ML_SEED)


def _embedding_xy(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings")
    base = emb.select(F.col("vec_id").alias("id"),
                      F.element_at("embedding", 1).cast("double").alias("x"),
                      F.element_at("embedding", 2).cast("double").alias("y"), "label")
    return ML.hash_split(base, "id", 0.75, ML_SEED)


@query("train_split")
def q_train_split(spark, sf_dir):
    return _embedding_xy(spark, sf_dir).select(F.col("id").alias("vec_id"), "split")


@query("linear_fit")
def q_linear_fit(spark, sf_dir):
    d = _lineitem_xy(spark, sf_dir)
    slope, intercept = ML.linear_fit(d.where(F.col("split") == "train"), "x", "y")
    grid = ML.linspace_grid(d, "x", 100)
    return ML.linear_predict(grid, "x", slope, intercept).select("i", _r("x", 6), _r("y_pred", 6))


@query("tree_predict")
def q_tree_predict(spark, sf_dir):
    d = _lineitem_xy(spark, sf_dir)
    grid = ML.linspace_grid(d, "x", 100)
    pred = ML.tree_fit_predict(d.where(F.col("split") == "train"), grid, ["x"], "y")
    return pred.select("i", _r("x", 6), _r("y_pred", 6))


@query("knn_regress")
def q_knn_regress(spark, sf_dir):
    d = _lineitem_xy(spark, sf_dir)
    grid = ML.linspace_grid(d, "x", 100)
    pred = ML.knn_regress(d.where(F.col("split") == "train"), grid.withColumnRenamed("i", "qid"),
                          ["x"], "y", k=5)
    return grid.join(pred, grid["i"] == pred["qid"], "inner").select(
        "i", _r("x", 6), _r("y_pred", 6))


def _mesh(spark, sf_dir):
    return ML.mesh_grid(_embedding_xy(spark, sf_dir), ["x", "y"], MESH_STEP, MESH_MARGIN)


@query("scoring_grid")
def q_scoring_grid(spark, sf_dir):
    return _mesh(spark, sf_dir).select("qid", _r("g0"), _r("g1"))


def _knn_classify(spark, sf_dir):
    d = _embedding_xy(spark, sf_dir)
    mesh = _mesh(spark, sf_dir)
    res = ML.knn_classify(d.where(F.col("split") == "train"), mesh, ["x", "y"], "label", k=15,
                          query_features=["g0", "g1"])
    return mesh.join(res, "qid", "inner")


@query("knn_classify")
def q_knn_classify(spark, sf_dir):
    return _knn_classify(spark, sf_dir).select("qid", _r("g0"), _r("g1"), "pred", _r("p_max"))


@query("class_confidence")
def q_class_confidence(spark, sf_dir):
    return _knn_classify(spark, sf_dir).select("qid", _r("confidence"))


@query("kmeans_parallel_seed")
def q_kmeans_parallel_seed(spark, sf_dir):
    return KM.seed_parallel(_tfidf_written(spark, sf_dir), P.KMEANS_COS_K, seed=P.KMEANS_SEED)


@query("kmeans_parallel_loss")
def q_kmeans_parallel_loss(spark, sf_dir):
    t = _tfidf_packed(spark, sf_dir)
    seeds = KM.seed_parallel(t, P.KMEANS_COS_K, seed=P.KMEANS_SEED)
    r = KM.kmeans_cosine(t, k=P.KMEANS_COS_K, max_iter=P.KMEANS_COS_MAX_ITER,
                         tol=P.KMEANS_COS_TOL, init=KM.seeds_to_centroids(t, seeds))
    return r.losses.select("iteration", _r("loss", 6))


# ---------------------------------------------------------------- more calendar and stream queries

from sparkiln.functions.time import date_from_parts, format_day_month_year  # noqa: E402
from sparkiln.sinks.files import append_writer  # noqa: E402


@query("daily_counts_nonzero")
def q_daily_counts_nonzero(spark, sf_dir):
    return TL.nonzero_days(TL.daily_counts_filled(load_table(spark, sf_dir, "orders"),
                                                  "o_orderdate"))


@query("year_range")
def q_year_range(spark, sf_dir):
    o = load_table(spark, sf_dir, "orders")
    return TL.select_between(o, F.year("o_orderdate"), 1996, 1998).select(
        "o_orderkey", "o_orderdate", "o_totalprice")


@query("date_format")
def q_date_format(spark, sf_dir):
    o = load_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    return o.select("o_orderkey",
                    date_from_parts(F.year(d), F.month(d), F.dayofmonth(d)).alias("date"),
                    format_day_month_year(d).alias("date_text"))


@query("stream_telemetry")
def q_stream_telemetry(spark, sf_dir):
    base = scratch_path(spark, "stream-telemetry")
    stream = _events_stream(spark, sf_dir)
    parsed = stream.select("event_id", "ts", "event_type", "value",
                           F.from_json("props", "k INT").alias("j")).select(
        "event_id", "ts", "event_type", "value", F.col("j.k").alias("k"),
        (F.col("value") / 3).alias("velocity"))
    SJ.run_available(parsed, append_writer(
        f"{base}/out", lambda b: TM.normalize_telemetry(b, drop=("event_type",), digits=2)),
        f"{base}/checkpoint", "append")
    return spark.read.parquet(f"{base}/out").drop("batch_id")


@query("label_region_table")
def q_label_region_table(spark, sf_dir):
    ev = _events_plane(spark, sf_dir)
    regions = GEO.region_table(spark, P.EVENT_REGIONS)
    out = GEO.label_region_table(ev, "x", "y", regions, cell=10.0, out="headquarter")
    return out.select("event_id", "headquarter")


@query("stream_monthly_increments")
def q_stream_monthly_increments(spark, sf_dir):
    """ST9: monthly counts maintained by a stream (complete mode); the running
    total is a window over the monthly result table once the stream drains."""
    from pyspark.sql import Window
    base = scratch_path(spark, "stream-monthly")
    stream = _events_stream(spark, sf_dir)
    monthly = stream.groupBy(F.trunc(F.col("ts").cast("date"), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("new_rows"))
    SJ.run_available(monthly, replace_writer(f"{base}/out", lambda b: b), f"{base}/checkpoint",
                     "complete")
    out = spark.read.parquet(f"{base}/out").where(F.col("month").isNotNull())
    w = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return out.withColumn("total_rows", F.sum("new_rows").over(w))


@query("row_count")
def q_row_count(spark, sf_dir):
    """AGG27: number of rows (here: of lineitem) as a one-row table."""
    return load_table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))
