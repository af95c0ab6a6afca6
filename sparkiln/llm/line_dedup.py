"""Operator 1: removal of repeated three-line windows.

Every run of three consecutive lines is hashed (128 bits; spaces, tabs and
carriage returns at the ends of a line do not count).  A window found more
than once anywhere is repeated; its first occurrence, by doc_id and position,
stays and each later one covers its three lines.  Covered lines are removed,
overlapping windows merged, also where such a line belongs to the first
occurrence of another window.

Plan: windows are counted with a partial aggregate (a window that a third of
all documents share is one row per task), the repeated ones are joined back to
the windows (a shuffle join that Spark splits on hot keys), and the covered
positions, bounded by a document's own lines, meet their text once.

Defined cases: windows of three blank lines are not windows; texts with fewer
than three lines are left alone, NULL stays NULL; rows equal in doc_id and
text count as one document and get the same result; a NULL doc_id sorts before
all others; a text that loses all lines becomes empty; an empty table gives an
empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkiln.llm.columns import bound, line_array, positions
from sparkiln.llm.tables import load_table, materialize, row_key

WINDOW = 3


def line_windows(docs: DataFrame) -> DataFrame:
    """One row per window: h1, h2 (its hash), doc_id, key, pos."""
    lines = F.transform(line_array(F.col("text")), lambda x: F.trim(x, F.lit(" \t\r")))

    def hashes(x):
        def one(i):
            parts = [F.get(x, i + j) for j in range(WINDOW)]
            # the second half of the hash starts from another prefix
            return F.when(F.concat(*parts) != "", F.struct(
                F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("2nd"), *parts).alias("h2")))
        return F.transform(positions(F.size(x) - (WINDOW - 1)), one)

    return (docs.select("doc_id", row_key("doc_id", "text").alias("key"),
                        F.posexplode(bound(lines, hashes)).alias("pos", "h"))
            .where(F.col("h").isNotNull())
            .select(F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2"), "doc_id", "key", "pos"))


def covered_lines(docs: DataFrame) -> DataFrame:
    """doc_id, key and the starts of the windows to remove, per document that
    has any."""
    windows = line_windows(docs)
    place = F.struct("doc_id", "key", "pos")
    # written on its own: a join right on the aggregate could not be split at a hot window
    first = materialize(windows.groupBy("h1", "h2")
                        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                        .where(F.col("n") > 1).select("h1", "h2", "first"), "repeated")
    later = windows.join(first, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "key").agg(F.collect_set("pos").alias("starts"))


def dedup_lines(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_lines, n_removed, text (of the lines that stay) and the
    columns of ``carry`` as they are."""
    covered = covered_lines(docs).select(
        F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), "starts")
    rows = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *carry).alias("_carry"),
                       row_key("doc_id", "text").alias("key"))
    joined = rows.join(covered, F.col("doc_id").eqNullSafe(F.col("_doc"))
                       & (F.col("key") == F.col("_key")), "left")
    gone = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (WINDOW - 1))))
    kept = joined.select(
        "doc_id", "text", "_carry", line_array(F.col("text")).alias("lines"),
        F.when(F.col("starts").isNotNull(), gone).alias("gone"))
    text = bound(F.col("lines"), lambda x: F.array_join(F.transform(
        F.array_except(positions(F.size(x)), F.col("gone")), lambda i: F.get(x, i)), "\n"))
    return kept.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.array_distinct("gone")), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(text).alias("text"),
        *[F.col("_carry")[c].alias(c) for c in carry])


def op1_line_dedup(spark, sf_dir) -> DataFrame:
    return dedup_lines(load_table(spark, sf_dir, "documents"))


#: Test tables have no repeated doc_id, so the row number stands for the row key.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS rid, doc_id, text,
         string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents),
l AS (
  SELECT rid, i, ls[i] AS line, trim(ls[i], ' ' || chr(9) || chr(13)) AS t
  FROM (SELECT rid, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
w AS (
  SELECT rid, i, t AS a, lead(t, 1) OVER o AS b, lead(t, 2) OVER o AS c
  FROM l WINDOW o AS (PARTITION BY rid ORDER BY i)),
later AS (
  SELECT rid, i FROM (
    SELECT rid, i, row_number() OVER (PARTITION BY a, b, c ORDER BY rid, i) AS k
    FROM w WHERE c IS NOT NULL AND a || b || c <> '')
  WHERE k > 1),
gone AS (SELECT DISTINCT rid, i + o AS i FROM later, range(3) r(o)),
kept AS (
  SELECT rid, string_agg(line, chr(10) ORDER BY i) AS text FROM l ANTI JOIN gone USING (rid, i)
  GROUP BY rid),
n AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(ls) END::BIGINT AS n_lines,
       coalesce(n.n, 0)::BIGINT AS n_removed,
       CASE WHEN n.n IS NULL THEN d.text ELSE coalesce(kept.text, '') END AS text
FROM d LEFT JOIN n USING (rid) LEFT JOIN kept USING (rid)"""

QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLE = {"op1_line_dedup": ORACLE_SQL}
