"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement is written independently of the Spark plan from the operator's
definition; the driver runs both at sf0.01 and compares rows, schema and
values.  Column names and types are aligned with the Spark side (counts are
BIGINT, doubles rounded where the two engines may differ in the last bits).
"""

from __future__ import annotations

from sparkiln.plans import params as P

ORACLE: dict[str, str] = {}


def _d(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def sql_in_polygon(x: str, y: str, poly) -> str:
    """Ray casting written out edge by edge in SQL."""
    terms = []
    for (x1, y1), (x2, y2) in zip(poly, [*poly[1:], poly[0]]):
        x1, y1, x2, y2 = float(x1), float(y1), float(x2), float(y2)
        if y1 == y2:
            continue
        cond = (f"{y} > {_d(min(y1, y2))} AND {y} <= {_d(max(y1, y2))} "
                f"AND {x} <= {_d(max(x1, x2))}")
        if x1 != x2:
            cond += (f" AND {x} <= ({y} - {_d(y1)}) * {_d(x2 - x1)} / {_d(y2 - y1)}"
                     f" + {_d(x1)}")
        terms.append(f"(CASE WHEN {cond} THEN 1 ELSE 0 END)")
    return f"coalesce((({' + '.join(terms)}) % 2) = 1, false)"


def sql_region_label(x: str, y: str, regions) -> str:
    whens = " ".join(f"WHEN {sql_in_polygon(x, y, poly)} THEN '{name}'" for name, poly in regions)
    return f"CASE {whens} END"


EVENTS_PLANE = """
  SELECT event_id, ts, value AS x,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y
  FROM events
"""

ORACLE["hourly_counts"] = """
SELECT date_trunc('hour', ts) AS window_start,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       CAST(ts AS DATE) AS day,
       CAST((hour(ts) + 1) * 3600000 AS BIGINT) AS hour_label,
       count(*) AS "count"
FROM events WHERE ts IS NOT NULL
GROUP BY ALL
"""

ORACLE["count_by_type"] = """
SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type
"""

ORACLE["in_polygon"] = f"""
SELECT event_id,
       {', '.join(f'{sql_in_polygon("x", "y", poly)} AS in_{name}' for name, poly in P.EVENT_REGIONS)}
FROM ({EVENTS_PLANE}) e
"""

ORACLE["label_region"] = f"""
SELECT event_id, headquarter FROM (
  SELECT event_id, {sql_region_label('x', 'y', P.EVENT_REGIONS)} AS headquarter
  FROM ({EVENTS_PLANE}) e
) WHERE headquarter IS NOT NULL
"""

_REGION_HOURLY = f"""
  SELECT headquarter, date_trunc('hour', ts) AS window_start,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS "count"
  FROM (SELECT ts, {sql_region_label('x', 'y', P.EVENT_REGIONS)} AS headquarter
        FROM ({EVENTS_PLANE}) e) l
  WHERE headquarter IS NOT NULL AND ts IS NOT NULL
  GROUP BY ALL
"""

ORACLE["region_counts"] = f"SELECT window_start, window_end, headquarter, \"count\" FROM ({_REGION_HOURLY})"

_TRENDING = f"""
  WITH c AS ({_REGION_HOURLY}),
  j AS (
    SELECT c.headquarter, c.window_start, c."count",
           CAST(coalesce(p."count", 0) AS BIGINT) AS prev_count
    FROM c LEFT JOIN c p
      ON p.headquarter = c.headquarter
     AND p.window_start = c.window_start - INTERVAL {P.TREND_WIDTH_S} SECOND
  )
  SELECT headquarter, window_start, "count", prev_count,
         CAST((hour(window_start) * 60 + minute(window_start)) * 60000 AS BIGINT) AS "timestamp"
  FROM j
  WHERE "count" >= {P.TREND_MIN_COUNT} AND "count" >= {P.TREND_RATIO} * prev_count
"""

ORACLE["trending"] = f"""
SELECT headquarter, window_start, "count", prev_count, "timestamp",
       '(' || headquarter || ',(' || "count" || ',' || "timestamp" || ',' || prev_count || '))' AS trend
FROM ({_TRENDING})
"""

ORACLE["trend_alerts"] = f"""
SELECT headquarter, "timestamp",
       'The number of arrivals to ' ||
       CASE headquarter WHEN 'goldman' THEN 'Goldman Sachs' WHEN 'citigroup' THEN 'Citigroup'
            ELSE headquarter END ||
       ' has doubled from ' || prev_count || ' to ' || "count" || ' at ' || "timestamp" || '!' AS alert
FROM ({_TRENDING})
"""

# ---------------------------------------------------------------- text and TF-IDF

ORACLE["word_count"] = r"""
SELECT word, count(*) AS "count"
FROM (SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
"""

# Java split("\\s+") per line: '' -> [''], white space only -> [], else split of the
# right-trimmed line (a leading empty token survives).
_LINES = r"""
  SELECT unnest(string_split_regex(regexp_replace(text, '\n\z', ''), '\n')) AS line
  FROM documents
"""
ORACLE["word_length_buckets"] = rf"""
WITH lines AS ({_LINES}),
toks AS (
  SELECT unnest(CASE
      WHEN line = '' THEN ['']
      WHEN regexp_replace(line, '[ \t\n\x0B\f\r]+\z', '') = '' THEN []::VARCHAR[]
      ELSE string_split_regex(regexp_replace(line, '[ \t\n\x0B\f\r]+\z', ''), '[ \t\n\x0B\f\r]+')
    END) AS token
  FROM lines
)
SELECT CASE WHEN length(token) = 1 THEN 'Tiny'
            WHEN length(token) BETWEEN 2 AND 4 THEN 'Small'
            WHEN length(token) BETWEEN 5 AND 9 THEN 'Medium'
            ELSE 'Big' END AS bucket,
       count(*) AS "count"
FROM toks GROUP BY 1
"""

_TOKENS = r"""
  SELECT doc_id, token FROM (
    SELECT doc_id, regexp_replace(raw, '[^a-zA-Z0-9£]', '', 'g') AS token
    FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \t\n\r\f]+')) AS raw
          FROM documents)
    WHERE raw <> ''
  ) WHERE token <> ''
"""
ORACLE["clean_tokens"] = f"SELECT doc_id, token FROM ({_TOKENS})"

_TRIPLES = f"""
  WITH toks AS ({_TOKENS}),
  n AS (SELECT count(DISTINCT doc_id) AS n FROM toks),
  dfs AS (SELECT token, count(DISTINCT doc_id) AS df FROM toks GROUP BY token),
  stop AS (SELECT token FROM dfs, n WHERE df > 0.5 * n.n),
  vocab AS (
    SELECT CAST(row_number() OVER (ORDER BY token) AS INTEGER) AS term_id, token AS term
    FROM dfs, n WHERE df >= 2 AND df <= 0.5 * n.n
  ),
  counts AS (SELECT doc_id, token, count(*) AS "count" FROM toks GROUP BY ALL)
  SELECT v.term_id, c.doc_id, c."count"
  FROM counts c JOIN vocab v ON c.token = v.term
  WHERE c.token NOT IN (SELECT token FROM stop)
"""
ORACLE["doc_term_counts"] = _TRIPLES

_TFIDF = f"""
  WITH t AS ({_TRIPLES}),
  n AS (SELECT count(DISTINCT doc_id) AS n FROM t),
  tf AS (
    SELECT doc_id, term_id, "count",
           "count" / CAST(sum("count") OVER (PARTITION BY doc_id) AS DOUBLE) AS tf
    FROM t
  ),
  dfs AS (SELECT term_id, count(*) AS df FROM t GROUP BY term_id)
  SELECT tf.doc_id, tf.term_id, tf."count", tf.tf,
         ln(CAST(n.n AS DOUBLE) / dfs.df) AS idf,
         tf.tf * ln(CAST(n.n AS DOUBLE) / dfs.df) AS tfidf
  FROM tf JOIN dfs USING (term_id), n
"""

ORACLE["tf"] = f"SELECT doc_id, term_id, \"count\", round(tf, 9) AS tf FROM ({_TFIDF})"
ORACLE["doc_total"] = f"SELECT count(DISTINCT doc_id) AS total_docs FROM ({_TRIPLES})"
ORACLE["tfidf"] = f"""
SELECT doc_id, term_id, round(tf, 9) AS tf, round(idf, 9) AS idf, round(tfidf, 9) AS tfidf
FROM ({_TFIDF})
"""
ORACLE["unique_terms"] = f"SELECT DISTINCT term_id FROM ({_TRIPLES})"
ORACLE["doc_vectors"] = f"""
SELECT doc_id, count(*) AS n_terms, round(sqrt(sum(tfidf * tfidf)), 9) AS norm,
       string_agg(term_id || ':' || printf('%.6e', tfidf), ',' ORDER BY term_id) AS vector_text
FROM ({_TFIDF}) GROUP BY doc_id
"""

# ---------------------------------------------------------------- calendar

ORACLE["daily_counts_filled"] = """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS cnt
           FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1),
s AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
      FROM d)
SELECT s.date, CAST(coalesce(d.cnt, 0) AS BIGINT) AS "count" FROM s LEFT JOIN d USING (date)
"""

ORACLE["first_per_day"] = """
SELECT date, o_orderkey, o_totalprice, day_count FROM (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey, o_totalprice,
         count(*) OVER (PARTITION BY CAST(o_orderdate AS DATE)) AS day_count,
         row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS rn
  FROM orders WHERE o_orderdate IS NOT NULL
) WHERE rn = 1
"""

ORACLE["sql_year_month"] = """
SELECT * FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) BETWEEN 1 AND 12
"""

ORACLE["yearly_mean_reindexed"] = """
WITH m AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, avg(o_totalprice) AS mean_value
  FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' GROUP BY 1
),
y AS (SELECT CAST(unnest(generate_series(min(year), max(year))) AS INTEGER) AS year FROM m)
SELECT y.year, round(m.mean_value, 6) AS mean_value FROM y LEFT JOIN m USING (year)
"""

ORACLE["monthly_increments"] = """
SELECT month, new_rows,
       CAST(sum(new_rows) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS total_rows
FROM (SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS new_rows
      FROM events WHERE ts IS NOT NULL GROUP BY 1)
"""

# ---------------------------------------------------------------- grouped statistics

ORACLE["mean_by_year"] = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
       round(avg(l_extendedprice), 6) AS avg_l_extendedprice,
       round(avg(l_quantity), 6) AS avg_l_quantity
FROM lineitem GROUP BY 1
"""

ORACLE["mean_by_year_key"] = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag,
       round(avg(l_extendedprice), 6) AS avg_l_extendedprice,
       round(avg(l_quantity), 6) AS avg_l_quantity
FROM lineitem GROUP BY 1, 2
"""

ORACLE["mean_by_status_year"] = """
SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year,
       round(avg(o_totalprice), 6) AS avg_o_totalprice
FROM orders GROUP BY 1, 2
"""

ORACLE["value_counts"] = """
SELECT p_brand, count(*) AS "count" FROM part WHERE p_brand IS NOT NULL GROUP BY 1
"""

_TOP5 = """
  SELECT o_custkey, count(*) AS "count" FROM orders WHERE o_custkey IS NOT NULL
  GROUP BY 1 ORDER BY "count" DESC, o_custkey LIMIT 5
"""
ORACLE["top_n"] = _TOP5

ORACLE["top_n_series"] = """
WITH top AS (
  SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND year(o_orderdate) = 1996
  GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 5
)
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS quantity
FROM orders WHERE o_custkey IN (SELECT o_custkey FROM top) GROUP BY 1, 2
"""

ORACLE["distinct_share"] = """
SELECT o_orderstatus, n_entities, round(n_entities / sum(n_entities) OVER (), 9) AS share
FROM (SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_entities
      FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1)
"""

ORACLE["distinct_values"] = "SELECT DISTINCT o_orderpriority FROM orders"

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return (f"CASE WHEN stddev_pop({a}) FILTER (WHERE {both}) * stddev_pop({b}) FILTER (WHERE {both}) = 0"
            f" THEN NULL ELSE covar_pop({a}, {b}) / (stddev_pop({a}) FILTER (WHERE {both})"
            f" * stddev_pop({b}) FILTER (WHERE {both})) END")


ORACLE["correlation_matrix"] = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round({_corr_sql(a, b)}, 6) AS r FROM lineitem"
    for a in _MEASURES for b in _MEASURES)

ORACLE["histogram"] = f"""
WITH vals AS (
  UNPIVOT (SELECT {', '.join(_MEASURES)} FROM lineitem)
  ON {', '.join(_MEASURES)} INTO NAME "column" VALUE v
),
b0 AS (SELECT "column", CAST(min(v) AS DOUBLE) AS mn0, CAST(max(v) AS DOUBLE) AS mx0
       FROM vals GROUP BY 1),
b AS (SELECT "column",
             CASE WHEN mx0 = mn0 THEN mn0 - 0.5 ELSE mn0 END AS mn,
             CASE WHEN mx0 = mn0 THEN mx0 + 0.5 ELSE mx0 END AS mx
      FROM b0),
bs AS (SELECT *, (mx - mn) / 20 AS step, 20 / (mx - mn) AS norm FROM b),
a0 AS (
  SELECT v."column", v.v, bs.mn, bs.mx, bs.step,
         least(greatest(floor((v.v - bs.mn) * bs.norm), 0), 19)::BIGINT AS b0
  FROM vals v JOIN bs USING ("column")
  WHERE v.v >= bs.mn AND v.v <= bs.mx
),
a1 AS (SELECT *, CASE WHEN v < (CASE WHEN b0 = 20 THEN mx ELSE b0 * step + mn END)
                      THEN b0 - 1 ELSE b0 END AS b1 FROM a0),
a2 AS (SELECT "column", CASE WHEN b1 < 19 AND
                              v >= (CASE WHEN b1 + 1 = 20 THEN mx ELSE (b1 + 1) * step + mn END)
                              THEN b1 + 1 ELSE b1 END AS bin FROM a1),
counts AS (SELECT "column", bin, count(*) AS cnt FROM a2 GROUP BY 1, 2),
spine AS (SELECT bs."column", r.k AS bin,
                 r.k * bs.step + bs.mn AS lo,
                 CASE WHEN r.k + 1 = 20 THEN bs.mx ELSE (r.k + 1) * bs.step + bs.mn END AS hi
          FROM bs, range(20) r(k))
SELECT spine."column", CAST(spine.bin AS INTEGER) AS bin, round(lo, 6) AS lo, round(hi, 6) AS hi,
       CAST(coalesce(cnt, 0) AS BIGINT) AS "count"
FROM spine LEFT JOIN counts USING ("column", bin)
"""

_BOX = """
  WITH q AS (
    SELECT o_orderpriority, count(*) AS n,
           quantile_cont(o_totalprice, 0.25) AS q1,
           quantile_cont(o_totalprice, 0.5) AS median,
           quantile_cont(o_totalprice, 0.75) AS q3
    FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1
  ),
  f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
  SELECT f.o_orderpriority, f.n, f.q1, f.median, f.q3, f.q3 - f.q1 AS iqr,
         min(o.o_totalprice) FILTER (WHERE o.o_totalprice BETWEEN f.lo AND f.hi) AS whisker_lo,
         max(o.o_totalprice) FILTER (WHERE o.o_totalprice BETWEEN f.lo AND f.hi) AS whisker_hi,
         count(*) FILTER (WHERE NOT (o.o_totalprice BETWEEN f.lo AND f.hi)) AS n_outliers
  FROM f JOIN orders o ON o.o_orderpriority = f.o_orderpriority AND o.o_totalprice IS NOT NULL
  GROUP BY ALL
"""
ORACLE["box_stats"] = f"""
SELECT o_orderpriority, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr, round(whisker_lo, 6) AS whisker_lo, round(whisker_hi, 6) AS whisker_hi,
       n_outliers
FROM ({_BOX})
"""

ORACLE["box_outliers"] = """
WITH q AS (
  SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
         quantile_cont(l_extendedprice, 0.75) AS q3
  FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1
)
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_extendedprice
FROM lineitem l JOIN q USING (l_returnflag)
WHERE l.l_extendedprice < q.q1 - 1.5 * (q.q3 - q.q1) OR l.l_extendedprice > q.q3 + 1.5 * (q.q3 - q.q1)
"""

ORACLE["melt_means"] = """
SELECT l_returnflag, variable, round(avg(value), 6) AS mean_value
FROM (UNPIVOT (SELECT l_returnflag, l_discount, l_tax FROM lineitem)
      ON l_discount, l_tax INTO NAME variable VALUE value)
GROUP BY 1, 2
"""

# ---------------------------------------------------------------- labels, projection, telemetry

_TITLE = r"""array_to_string(list_transform(range(1, length({s}) + 1), lambda i:
    CASE WHEN i = 1 OR NOT regexp_matches(substr({s}, i - 1, 1), '[\p{{Lu}}\p{{Ll}}\p{{Lt}}]')
         THEN upper(substr({s}, i, 1)) ELSE lower(substr({s}, i, 1)) END), '')"""

ORACLE["normalize_label"] = f"""
WITH t AS (
  SELECT p_partkey, p_name,
         CASE WHEN regexp_matches(p_name, '[A-Z]') THEN p_name ELSE {_TITLE.format(s='p_name')} END AS t1
  FROM part
)
SELECT p_partkey, p_name,
       regexp_replace(CASE t1 WHEN 'Bmw' THEN 'BMW' WHEN 'Ford Tk' THEN 'Ford Truck'
                      WHEN 'Gmc' THEN 'GMC' WHEN 'Gmc Truck' THEN 'GMC Truck'
                      WHEN 'Landrover' THEN 'Land Rover' WHEN 'Mercedes-B' THEN 'Mercedes-Benz'
                      WHEN 'Mercedes' THEN 'Mercedes-Benz' WHEN 'Vw' THEN 'Volkswagen'
                      ELSE t1 END, ' Tk', ' Truck', 'g') AS label
FROM t
"""

ORACLE["web_mercator"] = f"""
SELECT event_id, round(6378137.0 * radians(x - 180), 3) AS x,
       round(6378137.0 * ln(tan(pi() / 4 + radians(y - 50) / 2)), 3) AS y
FROM ({EVENTS_PLANE})
"""

ORACLE["telemetry"] = """
SELECT event_id, ts, round(value, 2) AS value,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       round(value / 3, 2) AS velocity
FROM events
"""

ORACLE["positions"] = """
SELECT vec_id, CAST(i AS INTEGER) AS pos,
       CAST(embedding[2 * i + 1] AS DOUBLE) AS satlatitude,
       CAST(embedding[2 * i + 2] AS DOUBLE) AS satlongitude
FROM (SELECT vec_id, embedding, unnest(range(CAST(floor(len(embedding) / 2) AS BIGINT))) AS i
      FROM embeddings)
"""

ORACLE["tracks"] = """
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq,
       ts, event_id,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) - 50 AS lat, value - 180 AS lon
FROM events
"""

# ---------------------------------------------------------------- clustering
#
# Lloyd's loop unrolled into a chain of materialised CTEs.  Every step carries
# a ``done`` flag: once a stop rule fires (empty cluster, small shift, last
# round) later steps copy the state unchanged, so the chain's last state is
# the loop's result.

from sparkiln.functions.hashing import sql_unit_draw  # noqa: E402


def _first_min_sql(dists: list[str]) -> str:
    m = f"least({', '.join(dists)})"
    whens = " ".join(f"WHEN {d} = {m} THEN {j}" for j, d in enumerate(dists, start=1))
    return f"CASE {whens} ELSE 1 END"


def kmeans_2d_sql(k: int, max_iter: int, tol: float, seed: int) -> dict[str, str]:
    ctes = [
        """pts AS MATERIALIZED (
          SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y
          FROM embeddings WHERE embedding[1] IS NOT NULL AND embedding[2] IS NOT NULL)""",
        f"""g0 AS MATERIALIZED (
          SELECT p.id, p.x, p.y,
                 CASE WHEN r.rn <= {k} THEN {k} - r.rn + 1
                      ELSE CAST(floor({sql_unit_draw('p.id', seed)} * {k}) AS BIGINT) + 1 END AS c
          FROM pts p JOIN (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM pts) r USING (id))""",
        """s0 AS MATERIALIZED (
          SELECT list(struct_pack(c := c, x := x, y := y, n := n) ORDER BY c) AS cents,
                 list(struct_pack(c := c, x := x, y := y, n := n) ORDER BY c) AS used,
                 false AS done, 0 AS last_it
          FROM (SELECT c, avg(x) AS x, avg(y) AS y, count(*) AS n FROM g0 GROUP BY c))""",
    ]
    hist = []
    for i in range(1, max_iter + 1):
        prev = f"s{i - 1}"
        dists = [f"sqrt((p.x - {prev}.cents[{j}].x) * (p.x - {prev}.cents[{j}].x)"
                 f" + (p.y - {prev}.cents[{j}].y) * (p.y - {prev}.cents[{j}].y))"
                 for j in range(1, k + 1)]
        ctes.append(f"""a{i} AS MATERIALIZED (
          SELECT p.id, p.x, p.y, {_first_min_sql(dists)} AS c FROM pts p, {prev})""")
        ctes.append(f"""n{i} AS MATERIALIZED (
          SELECT list(struct_pack(c := c, x := x, y := y, n := n) ORDER BY c) AS cents
          FROM (SELECT c, avg(x) AS x, avg(y) AS y, count(*) AS n FROM a{i} GROUP BY c))""")
        shift = "greatest(" + ", ".join(
            f"sqrt(({prev}.cents[{j}].x - n{i}.cents[{j}].x) * ({prev}.cents[{j}].x - n{i}.cents[{j}].x)"
            f" + ({prev}.cents[{j}].y - n{i}.cents[{j}].y) * ({prev}.cents[{j}].y - n{i}.cents[{j}].y))"
            for j in range(1, k + 1)) + ", 5e-324)"
        ctes.append(f"""{'s' + str(i)} AS MATERIALIZED (
          SELECT CASE WHEN {prev}.done THEN {prev}.cents ELSE n{i}.cents END AS cents,
                 CASE WHEN {prev}.done THEN {prev}.used ELSE {prev}.cents END AS used,
                 {prev}.done OR len(n{i}.cents) <> {k} OR {shift} < {tol!r} OR {i} = {max_iter} AS done,
                 CASE WHEN {prev}.done THEN {prev}.last_it ELSE {i} END AS last_it
          FROM {prev}, n{i})""")
        hist.append(f"SELECT {i} AS iteration, unnest(n{i}.cents) AS e FROM n{i}, s{i - 1} "
                    f"WHERE NOT s{i - 1}.done")
    last = f"s{max_iter}"
    head = "WITH " + ",\n".join(ctes)
    final_dists = [f"sqrt((p.x - {last}.used[{j}].x) * (p.x - {last}.used[{j}].x)"
                   f" + (p.y - {last}.used[{j}].y) * (p.y - {last}.used[{j}].y))"
                   for j in range(1, k + 1)]
    return {
        "centroids": f"""{head}
SELECT CAST(e.c AS INTEGER) AS cluster, round(e.x, 9) AS x, round(e.y, 9) AS y, e.n AS size
FROM (SELECT unnest(cents) AS e FROM {last})""",
        "assign": f"""{head}
SELECT p.id AS vec_id, CAST({_first_min_sql(final_dists)} AS INTEGER) AS cluster FROM pts p, {last}""",
        "history": f"""{head}
SELECT CAST(iteration AS INTEGER) AS iteration, CAST(e.c AS INTEGER) AS cluster,
       round(e.x, 9) AS x, round(e.y, 9) AS y, e.n AS size
FROM ({' UNION ALL '.join(hist)})""",
    }


_KM2 = kmeans_2d_sql(P.KMEANS_2D_K, P.KMEANS_2D_MAX_ITER, P.KMEANS_2D_TOL, P.KMEANS_SEED)
ORACLE["kmeans_2d_centroids"] = _KM2["centroids"]
ORACLE["kmeans_2d_assign"] = _KM2["assign"]
ORACLE["kmeans_2d_history"] = _KM2["history"]


_INF = "CAST('inf' AS DOUBLE)"
_VECTORS = [
    f"vec AS MATERIALIZED (SELECT doc_id AS doc, term_id AS term, tfidf AS value "
    f"FROM ({_TFIDF}) WHERE tfidf IS NOT NULL)",
    "dn AS MATERIALIZED (SELECT doc, sqrt(sum(value * value)) AS norm FROM vec GROUP BY doc)",
]


def kmeans_cosine_sql(k: int, max_iter: int, tol: float, seed: int,
                      start: list[str] | None = None) -> dict[str, str]:
    """``start``: CTEs that end with the first centroids c0 (cluster, term, value);
    a random partition otherwise."""
    inf = _INF
    ctes = [*_VECTORS, *(start or [
        f"""g0 AS MATERIALIZED (
          SELECT doc, CASE WHEN rn <= {k} THEN {k} - rn + 1
                           ELSE CAST(floor({sql_unit_draw('doc', seed)} * {k}) AS BIGINT) + 1 END AS cluster
          FROM (SELECT doc, row_number() OVER (ORDER BY doc) AS rn FROM (SELECT DISTINCT doc FROM vec)))""",
        """c0 AS MATERIALIZED (SELECT g.cluster, v.term, avg(v.value) AS value
          FROM vec v JOIN g0 g USING (doc) GROUP BY ALL)""",
    ]), "s0 AS MATERIALIZED (SELECT false AS done, 0 AS last_it)"]
    hist, losses = [], []
    for i in range(1, max_iter + 1):
        p = i - 1
        ctes += [
            f"cn{p} AS MATERIALIZED (SELECT cluster, sqrt(sum(value * value)) AS norm FROM c{p} GROUP BY cluster)",
            f"""dist{i} AS MATERIALIZED (
              SELECT d.doc, kk.j AS cluster,
                     CASE WHEN d.norm = 0 OR coalesce(cn.norm, 0) = 0 THEN {inf}
                          ELSE 1 - coalesce(x.dot, 0) / (d.norm * cn.norm) END AS dist
              FROM dn d CROSS JOIN range(1, {k + 1}) kk(j)
              LEFT JOIN cn{p} cn ON cn.cluster = kk.j
              LEFT JOIN (SELECT v.doc, c.cluster, sum(v.value * c.value) AS dot
                         FROM vec v JOIN c{p} c USING (term) GROUP BY ALL) x
                     ON x.doc = d.doc AND x.cluster = kk.j)""",
            f"""a{i} AS MATERIALIZED (SELECT doc, cluster FROM (
              SELECT doc, cluster, row_number() OVER (PARTITION BY doc ORDER BY dist, cluster) AS rn
              FROM dist{i}) WHERE rn = 1)""",
            f"""n{i} AS MATERIALIZED (SELECT a.cluster, v.term, avg(v.value) AS value
              FROM vec v JOIN a{i} a USING (doc) GROUP BY ALL)""",
            f"nn{i} AS MATERIALIZED (SELECT cluster, sqrt(sum(value * value)) AS norm FROM n{i} GROUP BY cluster)",
            f"""sh{i} AS MATERIALIZED (
              SELECT nn.cluster,
                     CASE WHEN coalesce(o.norm, 0) = 0 OR nn.norm = 0 THEN {inf}
                          ELSE 1 - coalesce(x.dot, 0) / (o.norm * nn.norm) END AS shift
              FROM nn{i} nn LEFT JOIN cn{p} o USING (cluster)
              LEFT JOIN (SELECT a.cluster, sum(a.value * b.value) AS dot
                         FROM c{p} a JOIN n{i} b USING (cluster, term) GROUP BY 1) x USING (cluster))""",
            f"""loss{i} AS MATERIALIZED (
              SELECT sum(sqrt(greatest(0, nn.norm * nn.norm + q.part))) AS loss FROM (
                SELECT v.doc, a.cluster, sum(v.value * v.value - 2 * v.value * coalesce(c.value, 0)) AS part
                FROM vec v JOIN a{i} a USING (doc)
                LEFT JOIN n{i} c ON c.cluster = a.cluster AND c.term = v.term GROUP BY ALL) q
              JOIN nn{i} nn USING (cluster))""",
            f"""s{i} AS MATERIALIZED (
              SELECT s{p}.done OR (SELECT count(*) FROM nn{i}) <> {k}
                     OR (SELECT max(shift) FROM sh{i}) <= {tol!r} OR {i} = {max_iter} AS done,
                     CASE WHEN s{p}.done THEN s{p}.last_it ELSE {i} END AS last_it
              FROM s{p})""",
            f"""c{i} AS MATERIALIZED (
              SELECT * FROM c{p} WHERE (SELECT done FROM s{p})
              UNION ALL SELECT * FROM n{i} WHERE NOT (SELECT done FROM s{p}))""",
        ]
        hist.append(f"""SELECT {i} AS iteration, z.cluster, z.size,
              CASE WHEN (SELECT count(*) FROM nn{i}) <> {k} THEN NULL ELSE sh.shift END AS shift
            FROM (SELECT cluster, count(*) AS size FROM a{i} GROUP BY cluster) z
            LEFT JOIN sh{i} sh USING (cluster) WHERE NOT (SELECT done FROM s{p})""")
        losses.append(f"SELECT {i} AS iteration, loss FROM loss{i} WHERE NOT (SELECT done FROM s{p})")
    last = max_iter
    all_assign, all_cents = (" UNION ALL ".join(
        f"SELECT {i} AS iteration, * FROM {t}{i} WHERE NOT (SELECT done FROM s{i - 1})"
        for i in range(1, max_iter + 1)) for t in "an")
    head = "WITH " + ",\n".join(ctes)
    return {
        "assign": f"""{head}
SELECT CAST(iteration AS INTEGER) AS iteration, doc AS doc_id, CAST(cluster AS INTEGER) AS cluster
FROM ({all_assign})""",
        "centroids": f"""{head}
SELECT CAST(iteration AS INTEGER) AS iteration, CAST(cluster AS INTEGER) AS cluster,
       term AS term_id, round(value, 9) AS value FROM ({all_cents})""",
        "loss": f"""{head}
SELECT CAST(iteration AS INTEGER) AS iteration, round(loss, 6) AS loss FROM ({' UNION ALL '.join(losses)})""",
        "shift": f"""{head}
SELECT CAST(iteration AS INTEGER) AS iteration, CAST(cluster AS INTEGER) AS cluster, size,
       round(shift, 9) AS shift FROM ({' UNION ALL '.join(hist)})""",
        "top": f"""{head}
SELECT CAST(iteration AS INTEGER) AS iteration, CAST(cluster AS INTEGER) AS cluster,
       CAST(rank AS INTEGER) AS rank, term AS term_id, round(value, 9) AS value FROM (
  SELECT iteration, cluster, term, value, row_number() OVER (
           PARTITION BY iteration, cluster ORDER BY value DESC, term) AS rank FROM ({all_cents}))
WHERE rank <= 10""",
        "distance": f"""{head},
cnf AS MATERIALIZED (SELECT cluster, sqrt(sum(value * value)) AS norm FROM c{last} GROUP BY cluster)
SELECT d.doc AS doc_id, CAST(kk.j AS INTEGER) AS cluster,
       round(CASE WHEN d.norm = 0 OR coalesce(cn.norm, 0) = 0 THEN {inf}
                  ELSE 1 - coalesce(x.dot, 0) / (d.norm * cn.norm) END, 9) AS distance
FROM dn d CROSS JOIN range(1, {k + 1}) kk(j)
LEFT JOIN cnf cn ON cn.cluster = kk.j
LEFT JOIN (SELECT v.doc, c.cluster, sum(v.value * c.value) AS dot
           FROM vec v JOIN c{last} c USING (term) GROUP BY ALL) x
       ON x.doc = d.doc AND x.cluster = kk.j""",
    }


_KMC = kmeans_cosine_sql(P.KMEANS_COS_K, P.KMEANS_COS_MAX_ITER, P.KMEANS_COS_TOL, P.KMEANS_SEED)
ORACLE["kmeans_cosine_assign"] = _KMC["assign"]
ORACLE["kmeans_cosine_centroids"] = _KMC["centroids"]
ORACLE["kmeans_loss"] = _KMC["loss"]
ORACLE["centroid_shift"] = _KMC["shift"]
ORACLE["top_terms"] = _KMC["top"]
ORACLE["cosine_distance"] = _KMC["distance"]


def seed_parallel_sql(k: int, seed: int, rounds: int = 16) -> list[str]:
    """k-means|| as CTEs, the last one seeds(cluster, doc); up to ``rounds`` rounds
    (a potential of e^16), each of which does nothing once the loop would have ended."""
    l = 4 * k

    def nearest(picks: str, name: str) -> str:
        # best new candidate of every document: (dist, ci), the lower ci on ties
        return f"""{name} AS MATERIALIZED (
          SELECT doc, dist, ci FROM (
            SELECT d.doc, p.ci,
                   CASE WHEN d.norm = 0 OR p.norm = 0 THEN {_INF}
                        ELSE 1 - coalesce(x.dot, 0) / (d.norm * p.norm) END AS dist
            FROM dn d CROSS JOIN {picks} p
            LEFT JOIN (SELECT v.doc, q.ci, sum(v.value * c.value) AS dot
                       FROM {picks} q JOIN vec c ON c.doc = q.doc JOIN vec v ON v.term = c.term
                       GROUP BY ALL) x ON x.doc = d.doc AND x.ci = p.ci)
          QUALIFY row_number() OVER (PARTITION BY doc ORDER BY dist, ci) = 1)"""

    ctes = [
        f"""k0 AS MATERIALIZED (SELECT 0 AS ci, doc, norm FROM dn
            ORDER BY {sql_unit_draw('doc', seed)}, doc LIMIT 1)""",
        nearest("k0", "psi0"),
        f"""p0 AS MATERIALIZED (SELECT coalesce(sum(CASE WHEN dist < {_INF} THEN dist END), 0) AS p
            FROM psi0)""",
        "loops AS MATERIALIZED (SELECT CASE WHEN p > 1 THEN ceil(ln(p)) ELSE 0 END AS n FROM p0)",
    ]
    for r in range(1, rounds + 1):
        o = r - 1
        ctes += [
            f"""add{r} AS MATERIALIZED (
              SELECT (SELECT count(*) FROM k{o}) + row_number() OVER (ORDER BY doc) - 1 AS ci, doc, norm
              FROM psi{o} JOIN dn USING (doc), p{o}, loops
              WHERE {r} <= loops.n AND p{o}.p > 0 AND dist < {_INF}
                    AND {sql_unit_draw('doc', seed * 1000 + r)} <= {float(l)} * dist / p{o}.p
                    AND doc NOT IN (SELECT doc FROM k{o}))""",
            f"k{r} AS MATERIALIZED (SELECT * FROM k{o} UNION ALL SELECT * FROM add{r})",
            nearest(f"add{r}", f"fresh{r}"),
            f"""psi{r} AS MATERIALIZED (
              SELECT o.doc, CASE WHEN f.dist < o.dist THEN f.dist ELSE o.dist END AS dist,
                     CASE WHEN f.dist < o.dist THEN f.ci ELSE o.ci END AS ci
              FROM psi{o} o LEFT JOIN fresh{r} f USING (doc))""",
            f"""p{r} AS MATERIALIZED (
              SELECT coalesce(sum(CASE WHEN dist < {_INF} THEN dist END), 0) AS p FROM psi{r})""",
        ]
    return [*ctes, f"""seeds AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY extra, key DESC, doc) AS cluster, doc FROM (
        SELECT 0 AS extra, k.doc, pow({sql_unit_draw('k.doc', seed + 7)}, 1.0::DOUBLE / w.w) AS key
        FROM (SELECT ci, count(*) AS w FROM psi{rounds} GROUP BY ci) w JOIN k{rounds} k USING (ci)
        UNION ALL
        SELECT 1 AS extra, doc, -{sql_unit_draw('doc', seed)} AS key FROM dn
        WHERE doc NOT IN (SELECT k.doc FROM psi{rounds} JOIN k{rounds} k USING (ci)))
      QUALIFY row_number() OVER (ORDER BY extra, key DESC, doc) <= {k})"""]


_SEEDS = seed_parallel_sql(P.KMEANS_COS_K, P.KMEANS_SEED)
ORACLE["kmeans_parallel_seed"] = (
    "WITH " + ",\n".join([*_VECTORS, *_SEEDS])
    + "\nSELECT CAST(cluster AS INTEGER) AS cluster, CAST(doc AS BIGINT) AS doc_id FROM seeds")
ORACLE["kmeans_parallel_loss"] = kmeans_cosine_sql(
    P.KMEANS_COS_K, P.KMEANS_COS_MAX_ITER, P.KMEANS_COS_TOL, P.KMEANS_SEED,
    [*_SEEDS, "c0 AS MATERIALIZED (SELECT s.cluster, v.term, v.value FROM seeds s JOIN vec v USING (doc))"]
)["loss"]

# ---------------------------------------------------------------- streams (final state = batch)

ORACLE["stream_hourly_counts"] = ORACLE["hourly_counts"]
ORACLE["stream_region_counts"] = ORACLE["region_counts"]
ORACLE["stream_trending"] = ORACLE["trending"]
ORACLE["stream_count_by_type"] = ORACLE["count_by_type"]

# ---------------------------------------------------------------- models

_ML_SEED = 42
MESH_STEP, MESH_MARGIN = 0.02, 1.0
_LI_XY = f"""
  SELECT id, x, y, CASE WHEN {sql_unit_draw('id', _ML_SEED)} < 0.75 THEN 'train' ELSE 'test' END AS split
  FROM (SELECT l_orderkey * 8 + l_linenumber AS id, l_extendedprice AS x, l_quantity AS y FROM lineitem)
"""
_EMB_XY = f"""
  SELECT id, x, y, label,
         CASE WHEN {sql_unit_draw('id', _ML_SEED)} < 0.75 THEN 'train' ELSE 'test' END AS split
  FROM (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
               label FROM embeddings)
"""
_GRID = f"""
  SELECT CAST(i AS INTEGER) AS i,
         CASE WHEN i = 99 THEN hi ELSE i * ((hi - lo) / 99) + lo END AS x
  FROM (SELECT CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) AS DOUBLE) AS hi FROM ({_LI_XY})),
       range(100) r(i)
"""

ORACLE["train_split"] = f"SELECT id AS vec_id, split FROM ({_EMB_XY})"

ORACLE["linear_fit"] = f"""
WITH f AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept
           FROM ({_LI_XY}) WHERE split = 'train')
SELECT g.i, round(g.x, 6) AS x, round(f.intercept + f.slope * g.x, 6) AS y_pred
FROM ({_GRID}) g, f
"""

# A tree grown until its leaves are even cuts half-way between neighbouring values, so
# with one feature it predicts the mean label of the training value on its side.
ORACLE["tree_predict"] = f"""
WITH vals AS (SELECT x, avg(y) AS y_pred,
                     coalesce((lag(x) OVER (ORDER BY x) + x) / 2, -CAST('inf' AS DOUBLE)) AS lo
              FROM ({_LI_XY}) WHERE split = 'train' GROUP BY x)
SELECT g.i, round(g.x, 6) AS x, round(v.y_pred, 6) AS y_pred
FROM ({_GRID}) g ASOF JOIN vals v ON g.x > v.lo
"""

ORACLE["knn_regress"] = f"""
WITH g AS ({_GRID}), t AS (SELECT * FROM ({_LI_XY}) WHERE split = 'train' AND x IS NOT NULL),
nb AS (
  SELECT g.i, t.y, row_number() OVER (PARTITION BY g.i ORDER BY sqrt((t.x - g.x) * (t.x - g.x)), t.id) AS rk
  FROM g, t
)
SELECT g.i, round(g.x, 6) AS x, round(avg(nb.y), 6) AS y_pred
FROM g JOIN nb ON nb.i = g.i AND nb.rk <= 5 GROUP BY g.i, g.x
"""

_MESH = f"""
  WITH b AS (SELECT min(x) - CAST({MESH_MARGIN!r} AS DOUBLE) AS lo0, max(x) + CAST({MESH_MARGIN!r} AS DOUBLE) AS hi0,
                    min(y) - CAST({MESH_MARGIN!r} AS DOUBLE) AS lo1, max(y) + CAST({MESH_MARGIN!r} AS DOUBLE) AS hi1
             FROM ({_EMB_XY})),
  n AS (SELECT lo0, lo1, CAST(ceil((hi0 - lo0) / CAST({MESH_STEP!r} AS DOUBLE)) AS BIGINT) AS n0,
               CAST(ceil((hi1 - lo1) / CAST({MESH_STEP!r} AS DOUBLE)) AS BIGINT) AS n1 FROM b)
  SELECT j * n0 + i AS qid, i * CAST({MESH_STEP!r} AS DOUBLE) + lo0 AS g0,
         j * CAST({MESH_STEP!r} AS DOUBLE) + lo1 AS g1
  FROM n, range(n.n0) a(i), range(n.n1) c(j)
"""


ORACLE["scoring_grid"] = f"SELECT qid, round(g0, 9) AS g0, round(g1, 9) AS g1 FROM ({_MESH})"

_KNN_CLS = f"""
  WITH m AS ({_MESH}),
  t AS (SELECT * FROM ({_EMB_XY}) WHERE split = 'train' AND x IS NOT NULL AND y IS NOT NULL),
  nb AS (
    SELECT qid, label, dist FROM (
      SELECT m.qid, t.label, sqrt((t.x - m.g0) * (t.x - m.g0) + (t.y - m.g1) * (t.y - m.g1)) AS dist,
             row_number() OVER (PARTITION BY m.qid
                                ORDER BY sqrt((t.x - m.g0) * (t.x - m.g0) + (t.y - m.g1) * (t.y - m.g1)), t.id) AS rk
      FROM m, t) WHERE rk <= 15
  ),
  w AS (
    SELECT qid, label,
           CASE WHEN max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY qid) = 1
                THEN CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / dist END AS w
    FROM nb
  ),
  pc AS (SELECT qid, label, sum(w) AS w FROM w GROUP BY ALL),
  pr AS (SELECT qid, label, w / sum(w) OVER (PARTITION BY qid) AS p FROM pc),
  rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY p DESC, label) AS r FROM pr)
  SELECT m.qid, m.g0, m.g1, max(CASE WHEN rk.r = 1 THEN rk.label END) AS pred, max(rk.p) AS p_max,
         2 * max(rk.p) - sum(rk.p) AS confidence
  FROM m JOIN rk USING (qid) GROUP BY m.qid, m.g0, m.g1
"""
ORACLE["knn_classify"] = f"""
SELECT qid, round(g0, 9) AS g0, round(g1, 9) AS g1, pred, round(p_max, 9) AS p_max FROM ({_KNN_CLS})
"""
ORACLE["class_confidence"] = f"SELECT qid, round(confidence, 9) AS confidence FROM ({_KNN_CLS})"

# ---------------------------------------------------------------- more calendar and stream queries

ORACLE["daily_counts_nonzero"] = """
SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS "count"
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1
"""
ORACLE["year_range"] = """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE year(o_orderdate) BETWEEN 1996 AND 1998
"""
ORACLE["date_format"] = """
SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), day(o_orderdate)) AS date,
       strftime(o_orderdate, '%d/%m/%Y') AS date_text
FROM orders
"""
ORACLE["stream_telemetry"] = ORACLE["telemetry"]
ORACLE["label_region_table"] = ORACLE["label_region"]
ORACLE["stream_monthly_increments"] = ORACLE["monthly_increments"]
ORACLE["row_count"] = "SELECT count(*) AS n_rows FROM lineitem"
