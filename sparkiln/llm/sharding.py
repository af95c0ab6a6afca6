"""Operator 2: rendezvous hashing of record keys over weighted shards.

Every (key, shard) pair has a pseudo-random draw u in (0, 1] from the MD5 of
key and shard name; the shard with the largest ``-weight / ln(u)`` owns the
key (weighted rendezvous hashing).  The owner depends on the key and the shard
list alone: adding a shard moves to it exactly the keys it now wins, and
nothing moves between old shards.  All of it is built-in Column expressions
(no shuffle, no state).

``number_slots`` gives every row a gapless place in its shard without a
per-shard sort in one task: equal records are counted first (so thousands of
repeats of a row are one row of the shuffle), places are numbered inside
(shard, hash prefix) cells, and the cells' sizes, a table of at most shards x
``CELLS`` rows, turn them into places in the shard.  The copies of a record are
then dealt out in runs of at most ``RUN`` places, so many tasks write them.

Defined cases: NULL keys share one owner, that of the text ``\\0``; empty and
NULL texts have size 1; equal
rows get different slots; an empty table gives an empty result; extra columns
are never read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkiln.llm.tables import load_table, text_crc32

#: Hash-prefix cells per shard when slots are numbered (three hex digits).
CELLS = 4096
#: Copies of one record that a task writes in one go.
RUN = 1000
_SPAN = float(1 << 52)


def draw(key: Column, shard: str) -> Column:
    """Uniform draw in (0, 1) for a key and a shard: 52 bits of an MD5."""
    named = F.concat(F.coalesce(key.cast("string"), F.lit("\\0")), F.lit(f"/{shard}"))
    bits = F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(_SPAN)


def rendezvous(key: Column, shards: Sequence[str], weights: Sequence[float] | None = None
               ) -> Column:
    """Index of the shard that owns ``key``.  Ties (equal scores) go to the
    lower index; a weight of 0 never wins unless all are 0."""
    weights = list(weights) if weights is not None else [1.0] * len(shards)
    if not shards or len(weights) != len(shards) or min(weights) < 0:
        raise ValueError("one weight of 0 or more for each of at least one shard")
    # equal weights order as the draws themselves, so the logarithm is left out
    equal = len(set(weights)) == 1
    scores = [draw(key, s) if equal else F.lit(float(w)) / -F.log(draw(key, s))
              for s, w in zip(shards, weights)]
    entries = [F.struct(s.alias("score"), F.lit(-i).alias("minus"))
               for i, s in enumerate(scores)]
    best = entries[0] if len(entries) == 1 else F.greatest(*entries)
    return -best["minus"]


def assign_shards(df: DataFrame, key: str, shards: Sequence[str],
                  weights: Sequence[float] | None = None, out: str = "shard") -> DataFrame:
    """``df`` with the owning shard's index as ``out`` (replaced if present)."""
    return df.withColumn(out, rendezvous(F.col(key), shards, weights).cast("int"))


def number_slots(df: DataFrame, shard: str, record: Sequence[str], out: str = "slot") -> DataFrame:
    """Rows (``record`` columns and ``shard``) with places 0, 1, ... in each
    shard, in order of the MD5 of the record, then of its columns."""
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("\\0")) for c in record])
    order = F.md5(text.cast("binary"))
    cols = [shard, *record]
    rows = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
            .withColumn("_order", order)
            .withColumn("_cell", F.substring("_order", 1, 3)))
    inside = Window.partitionBy(shard, "_cell").orderBy("_order", *record)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
    cells = rows.groupBy(shard, "_cell").agg(F.sum("_copies").alias("_n"))
    along = Window.partitionBy(shard).orderBy("_cell").rowsBetween(
        Window.unboundedPreceding, -1)
    cells = cells.select(F.col(shard).alias("_s"), F.col("_cell").alias("_c"),
                         F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_base"))
    joined = placed.join(cells, (F.col(shard) == F.col("_s")) & (F.col("_cell") == F.col("_c")))
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1,
                               F.lit(RUN).cast("long"))).alias("_run")
    # a count of its own: runs are small rows, so by their size they would be put together again
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = joined.select(*cols, "_copies", (F.col("_base") + F.col("_before")).alias("_place"),
                         run).repartition(parts, *cols, "_run")
    copy = F.explode(F.sequence(
        "_run", F.least(F.col("_run") + RUN, F.col("_copies")) - 1)).alias("_copy")
    return runs.select(*cols, "_place", copy).select(
        *cols, (F.col("_place") + F.col("_copy")).alias(out))


def shard_names(n: int) -> list[str]:
    return [f"shard-{i}" for i in range(n)]


def shard_documents(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       text_crc32(F.col("text")).alias("text_crc32"))
    rows = assign_shards(rows, "doc_id", shard_names(n_shards))
    slots = number_slots(rows, "shard", ["doc_id", "size", "text_crc32"])
    grown = rendezvous(F.col("doc_id"), shard_names(n_shards + 1)).cast("int")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                        "slot", grown.alias("grown_shard"))


def op2_rendezvous_shards(spark, sf_dir) -> DataFrame:
    return shard_documents(load_table(spark, sf_dir, "documents"))


def _draw_sql(shard: str) -> str:
    return f"md5(coalesce(doc_id::varchar, '\\0') || '/{shard}')[1:13]"


def _owner_sql(n: int) -> str:
    # equal-length lower-case hex strings order as the numbers they write
    best = reduce(lambda a, b: f"greatest({a}, {b})", [_draw_sql(s) for s in shard_names(n)])
    return "CASE " + " ".join(f"WHEN {_draw_sql(s)} = {best} THEN {i}"
                              for i, s in enumerate(shard_names(n))) + " END"


#: CRC-32 is not a DuckDB function: its 256-entry table and the byte loop are
#: written out as list folds.
_CRC_SQL = """
crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)::BIGINT[]), lambda a, b:
             CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END) AS v
    FROM range(256) r(i))),
bytes AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS pairs
  FROM documents),
crc AS (
  SELECT doc_id, size, xor(4294967295::BIGINT, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(pairs, lambda x: ('0x' || x)::BIGINT)),
           lambda a, b: xor(a >> 8, t[1 + xor(a & 255, b)]))) AS text_crc32
  FROM bytes, crc_table)"""

ORACLE_SQL = f"""
WITH {_CRC_SQL},
owned AS (SELECT doc_id, size, text_crc32, {_owner_sql(8)} AS shard,
                 {_owner_sql(9)} AS grown_shard,
                 md5(coalesce(doc_id::varchar, '\\0') || ':' || size::varchar || ':'
                     || text_crc32::varchar) AS ord
          FROM crc)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY ord, doc_id, size, text_crc32) - 1)::BIGINT
         AS slot,
       grown_shard::INTEGER AS grown_shard
FROM owned"""

QUERIES = {"op2_rendezvous_shards": op2_rendezvous_shards}
ORACLE = {"op2_rendezvous_shards": ORACLE_SQL}
