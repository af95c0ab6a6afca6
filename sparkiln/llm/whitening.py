"""Operator 13: PCA whitening of embeddings by Spark MLlib BlockMatrix.

1. *Rows*: vectors without NULL or non-finite entries, each entry c read as the
   integer floor(256 c).  They are written once, numbered as written, and the
   numbers lay them into blocks of ``ROWS`` rows (``COLUMNS`` columns).
2. *Fit list*: every distinct vector once, at the smallest number that has it
   (an aggregate, combined before the shuffle, so a vector that a third of
   all rows share costs a row per task).  Its integer sums S are exact.
3. *Scatter*: the centred fit rows x - S/n as a BlockMatrix A; transpose(A) A is
   multiplied with the middle dimension split, so the blocks of rows go to many
   tasks and only partial scatter matrices (dimension x dimension) meet in one.
4. *Local eigh* of the covariance on the driver: its size is the dimension
   squared, whatever the number of rows.
5. *Projection*: the centred rows, all of them, times the whitening matrix
   (eigenvectors over the roots of their eigenvalues), again block by block.
6. The covariance of the whitened fit rows is measured, not assumed.

Defined cases: rows whose vector is NULL or holds NULL, NaN or infinite entries
are left out; a shorter vector counts as 0 in the dimensions it lacks; an empty vector
is 0 everywhere; repeated rows, and rows with the same or no vec_id, each get
their result; directions without variance (rank deficits, one distinct
vector only) are no components, so fewer than ``components`` may come back and
a table of one distinct vector gives no rows; vectors of any length are cut into
column blocks; a deviation beyond 64 bits is NULL; of equal eigenvalues the
order is that of ``eigh``; an empty table gives an empty result; columns other
than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sparkiln.functions.literals import literal_rows
from sparkiln.llm.tables import load_table, materialize

SCALE = 256
COMPONENTS = 4
ROWS = 2048  # rows of a block
COLUMNS = 1024  # columns of a block
BLOCKS_AT_ONCE = 4  # blocks of rows that one task multiplies

_POSITION = (1 << 33) - 1  # monotonically_increasing_id: task number above the row's place
_BLOCKS = StructType([
    StructField("at", StructType([StructField("i", LongType()), StructField("j", LongType())])),
    StructField("block", MatrixUDT())])
OUTPUT = ("vec_id long, component int, n long, deviation long, whitened double, "
          "explained double, identity_error double")


def integer_vectors(df: DataFrame, id: str, vector: str) -> DataFrame:
    """vec_id, x: the rows with a whole vector, entries as integers."""
    kept = df.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(
        F.col("v").isNotNull() & F.forall(
            "v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    return kept.select("vec_id", F.transform(
        "v", lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double"))).alias("x"))


def padded(column: pa.Array, d: int) -> np.ndarray:
    """Rows of a list<int64> column as an array of ``d`` columns."""
    first = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy()
    size = np.diff(first)
    if (size == d).all():
        return flat[first[0]:first[-1]].reshape(-1, d)
    out = np.zeros((len(size), d), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(first[0], first[-1]) - first[row]] = flat[first[0]:first[-1]]
    return out


def column_sums(fit: DataFrame, d: int) -> list[int]:
    """Exact sums of every dimension: tasks add the halves of the integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = padded(batch.column("x"), d)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            high += (x >> 32).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(d)), pa.array(low), pa.array(high)], names=["k", "low", "high"])

    parts = fit.select("x").mapInArrow(run, "k long, low long, high long")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high")]
    out = [0] * d
    for r in parts.groupBy("k").agg(*wide).collect():
        out[r["k"]] = int(r["low"]) + (int(r["high"]) << 32)
    return out


def centred(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """x - S/n: the whole part is taken off as an integer, so nothing is lost."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def deviations(x: np.ndarray, sums: list[int], n: int) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, exactly; None beyond 64 bits."""
    d = x.shape[1]
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if d * reach * reach < 1 << 63:
        away = n * x - np.array(sums, np.int64)
        return (away * away).sum(axis=1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return [v if v < 1 << 63 else None for v in exact]


def block_matrix(rows: DataFrame, per_task: int, tasks: int, d: int, sums: list[int], n: int
                 ) -> BlockMatrix:
    """The centred rows (at, x) as a BlockMatrix; places without a row are zero."""
    def block(i: int, place: list[np.ndarray], part: list[np.ndarray]) -> pa.RecordBatch:
        full = np.zeros((ROWS, d))
        full[np.concatenate(place)] = centred(np.concatenate(part), sums, n)
        cut = [np.ascontiguousarray(full[:, lo:lo + COLUMNS]) for lo in range(0, d, COLUMNS)]
        bounds = np.concatenate([[0], np.cumsum([c.size for c in cut])]).astype(np.int32)
        m = len(cut)
        none = pa.nulls(m, pa.list_(pa.int32()))
        matrix = pa.StructArray.from_arrays(
            [pa.array([1] * m, pa.int8()), pa.array([ROWS] * m, pa.int32()),
             pa.array([c.shape[1] for c in cut], pa.int32()), none, none,
             pa.ListArray.from_arrays(bounds, np.concatenate([c.ravel() for c in cut])),
             pa.array([True] * m)],
            names=["type", "numRows", "numCols", "colPtrs", "rowIndices", "values", "isTransposed"])
        at = pa.StructArray.from_arrays([pa.array([i] * m), pa.array(range(m), pa.int64())],
                                        names=["i", "j"])
        return pa.RecordBatch.from_arrays([at, matrix], names=["at", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place, part = None, [], []
        for batch in batches:
            of = batch.column("i").to_numpy()
            x, row = padded(batch.column("x"), d), batch.column("row").to_numpy()
            edges = np.flatnonzero(np.diff(of, prepend=-1)) if len(of) else []
            for lo, hi in zip(edges, [*edges[1:], len(of)]):
                if held is not None and of[lo] != held:
                    yield block(held, place, part)
                    place, part = [], []
                held = int(of[lo])
                place.append(row[lo:hi])
                part.append(x[lo:hi])
        if held is not None:
            yield block(held, place, part)

    task, at = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit(_POSITION))
    placed = rows.select((task * per_task + F.floor(at / ROWS)).alias("i"),
                         (at % ROWS).alias("row"), "x")
    blocks = placed.repartition("i").sortWithinPartitions("i").mapInArrow(run, _BLOCKS)
    made = BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, ROWS, min(COLUMNS, d),
                                     tasks * per_task * ROWS, d), ROWS, min(COLUMNS, d))
    return made.persist(StorageLevel.MEMORY_AND_DISK)


def scatter(a: BlockMatrix, blocks: int) -> np.ndarray:
    """transpose(A) A, its middle dimension dealt to many tasks."""
    splits = max(1, -(-blocks // BLOCKS_AT_ONCE))
    left = a.transpose()
    product = left._java_matrix_wrapper.call("multiply", a._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, a.colsPerBlock).toLocalMatrix().toArray()


def whitening_matrix(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors over the roots of their eigenvalues, and those eigenvalues, falling."""
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    order = np.argsort(-values, kind="stable")
    least = values.max(initial=0.0) * len(v) * np.finfo(float).eps
    order = [i for i in order[:components] if values[i] > least]
    return vectors[:, order] / np.sqrt(values[order]), values[order]


def release(a: BlockMatrix) -> None:
    a._java_matrix_wrapper.call("blocks").unpersist(False)


def projected(sc: SparkContext, a: BlockMatrix, w: np.ndarray, per_task: int) -> DataFrame:
    """(at, w): every place of the blocks of ``a`` times the whitening matrix."""
    d, k = w.shape
    step = a.colsPerBlock
    parts = [((lo // step, 0), DenseMatrix(min(step, d - lo), k, w[lo:lo + step].ravel("F")))
             for lo in range(0, d, step)]
    product = a.multiply(BlockMatrix(sc.parallelize(parts, 1), step, k))
    blocks = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
    names = blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, m in zip(batch.column(names[0]).to_pylist(), batch.column(names[1])):
                values = np.asarray(m["values"].values)
                shape = (m["numRows"].as_py(), m["numCols"].as_py())
                rows = (values.reshape(shape) if m["isTransposed"].as_py()
                        else values.reshape(shape[::-1]).T)
                i = list(at.values())[0]
                place = (i // per_task << 33) + i % per_task * ROWS + np.arange(len(rows))
                bounds = np.arange(len(rows) + 1, dtype=np.int32) * k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place), pa.ListArray.from_arrays(
                        bounds, np.ascontiguousarray(rows).ravel())], names=["at", "w"])

    return blocks.mapInArrow(run, "at long, w array<double>")


def whiten(df: DataFrame, id: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per
    whole vector and component."""
    spark = df.sparkSession
    # numbered as written, so the numbers are fixed
    rows = materialize(integer_vectors(df, id, vector).withColumn(
        "at", F.monotonically_increasing_id()), "vectors")
    # smallest number of every distinct vector
    fit = materialize(rows.groupBy("x").agg(F.min("at").alias("at")), "fit")
    task, at = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit(_POSITION))
    size = rows.agg(F.max(task).alias("tasks"), F.max(at).alias("rows"),
                    F.max(F.size("x")).alias("d")).first()
    n = fit.count()
    d = size["d"] or 0
    if n < 2 or d == 0:
        return literal_rows(spark, [], OUTPUT)
    tasks, per_task = size["tasks"] + 1, size["rows"] // ROWS + 1
    sums = column_sums(fit, d)

    a = block_matrix(fit, per_task, tasks, d, sums, n)
    v = scatter(a, tasks * per_task) / n
    matrix, values = whitening_matrix(v, components)
    release(a)
    if not len(values):
        return literal_rows(spark, [], OUTPUT)
    every = block_matrix(rows, per_task, tasks, d, sums, n)
    points = materialize(projected(spark.sparkContext, every, matrix, per_task), "projected")
    release(every)

    k = len(values)
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    entry = [F.get("w", F.lit(i)) for i in range(k)]
    measured = points.join(fit.select("at"), "at").agg(*[
        F.covar_pop(entry[i], entry[j]).alias(f"c{i}_{j}") for i, j in cells]).first()
    error = max(abs(measured[f"c{i}_{j}"] - (i == j)) for i, j in cells)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("at"), batch.column("vec_id"),
                 pa.array(deviations(padded(batch.column("x"), d), sums, n), pa.int64())],
                names=["at", "vec_id", "deviation"])

    measures = rows.mapInArrow(measure, "at long, vec_id long, deviation long")
    share = F.array(*[F.lit(float(e)) for e in values / np.trace(v)])
    return (measures.join(points, "at")
            .select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened"))
            .select("vec_id", (F.col("k") + 1).cast("int").alias("component"),
                    F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(share, F.col("k")).alias("explained"),
                    F.lit(float(error)).alias("identity_error")))


def op13_block_whitening(spark, sf_dir) -> DataFrame:
    return whiten(load_table(spark, sf_dir, "embeddings"))


QUERIES = {"op13_block_whitening": op13_block_whitening}
ORACLE: dict[str, str] = {}
