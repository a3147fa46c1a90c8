"""Whitening of embeddings with distributed block matrices.

Entries are taken as whole numbers ``floor(scale * c) + shift``, so that sums and deviations are exact.  The fit list is each distinct vector once.
Its rows, centred and numbered, become an MLlib ``IndexedRowMatrix`` and from that a ``BlockMatrix`` of row blocks; its transpose
times itself is the scatter, whose eigenvectors are found on the driver (one number for each pair of dimensions, whatever the number of
rows), and a further block multiplication by the whitening matrix projects all rows.  Rows get from DataFrame to matrix and back inside the JVM.
The rows' dimension of a product is split over many tasks, which add up what they have before it is sent on.

Defined results: rows whose vector is NULL or empty, or holds a NULL or a value that is not finite, give no rows, nor do vectors of another length
than the most frequent one (the longer of two equally frequent).  Repeated rows each give theirs.  Entries are held at 2**52 in either direction
before they are shifted.  A component without variance has ``whitened`` 0.0 and is left out of ``identity_error``.  ``deviation`` is NULL where
it passes 64 bits.  A table without usable rows gives none.
"""

from __future__ import annotations

from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.llm.tables import usable, usual_length, written

RESULT = "n long, deviation long, component int, whitened double, explained double, identity_error double"
LIMIT = float(1 << 52)
NONE = 1e-13  # share of the largest eigenvalue below which a component counts as without variance


def whole_numbers(vector: Column, scale: int, shift: int) -> Column:
    def whole(entry: Column) -> Column:
        return F.floor(F.greatest(F.least(entry.cast("double") * scale, F.lit(LIMIT)), F.lit(-LIMIT))) + F.lit(shift).cast("long")

    return F.transform(vector, whole)


def _numbered(rows: DataFrame) -> DataFrame:
    """``index`` from 0 without gaps, from the place of a row in its partition and the sizes of the partitions before it."""
    placed = written(rows.withColumn("_place", F.monotonically_increasing_id()))
    task = F.shiftright("_place", 33)
    sizes = sorted((r["task"], r["size"]) for r in placed.groupBy(task.alias("task")).agg(F.count("*").alias("size")).collect())
    starts, total = [], 0
    for number, size in sizes:
        starts.append((number, total))
        total += size
    offsets = rows.sparkSession.createDataFrame(starts, "task long, start long")
    numbered = placed.withColumn("_task", task).join(offsets, F.col("_task") == F.col("task"))
    return numbered.withColumn("index", F.col("start") + F.col("_place").bitwiseAND((1 << 33) - 1)).drop("_place", "_task", "task", "start")


def _centred(fit: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """``index, key, centred, deviation``; whole numbers as long as they are exact."""

    def step(batches):
        import numpy as np
        import pyarrow as pa

        total, width = np.array(sums, dtype=object), len(sums)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            bound = 2 * n * max(float(np.abs(x).max()), float(abs(total).max()) / n) if len(x) else 0
            exact = bound < 2.0**62
            moved = n * x - total.astype(np.int64) if exact else n * x.astype(object) - total
            if exact and bound * bound * width < 2.0**62:
                deviation = (moved * moved).sum(axis=1).tolist()
            else:
                deviation = [sum(int(v) ** 2 for v in row) for row in moved]
            centred = (moved / n).astype(float)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("index"),
                    batch.column("key"),
                    pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, centred.size + 1, width), pa.int32()), pa.array(centred.ravel())),
                ],
                ["index", "key", "deviation", "centred"],
            )

    return fit.select("index", "key", "x").mapInArrow(step, "index long, key string, deviation long, centred array<double>")


def _multiplied(left: BlockMatrix, right: BlockMatrix, per_block: tuple[int, int], splits: int) -> BlockMatrix:
    """The product with its middle dimension split over ``splits`` tasks, an argument that the Python class does not pass on."""
    product = left._java_matrix_wrapper._java_model.multiply(right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, *per_block)


def _scatter(blocks: BlockMatrix, width: int, splits: int):
    return _multiplied(blocks.transpose(), blocks, (width, width), splits).toLocalMatrix().toArray()


def whitened(
    vectors: DataFrame,
    ids: str = "vec_id",
    vector: str = "embedding",
    components: int = 16,
    scale: int = 64,
    shift: int = 1_000_000,
    rows_per_block: int = 2048,
) -> DataFrame:
    """``ids, n, deviation, component, whitened, explained, identity_error``: up to ``components`` rows for each usable row."""
    import numpy as np

    spark = vectors.sparkSession
    rows = usable(vectors.select(F.col(ids).alias("_id"), F.col(vector).alias("_vector")), "_vector")
    width = usual_length(rows, "_vector")
    rows = rows.where(F.size("_vector") == width).select("_id", whole_numbers(F.col("_vector"), scale, shift).alias("x"))
    key = F.sha2(F.concat_ws(",", F.col("x").cast("array<string>")), 256).alias("key")
    fit = _numbered(rows.select("x").distinct().select("x", key)) if width else None
    sums = [r["s"] for r in fit.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()] if width else []
    if not sums:
        return spark.createDataFrame([], f"{ids} {rows.schema['_id'].dataType.simpleString()}, {RESULT}")
    n = fit.count()

    centred = written(_centred(fit, n, sums))
    indexed = MLUtils.convertVectorColumnsFromML(centred.select("index", array_to_vector("centred").alias("row")), "row")
    blocks = IndexedRowMatrix(indexed, n, width).toBlockMatrix(rows_per_block, width)
    splits = max(1, min(-(-n // rows_per_block), spark.sparkContext.defaultParallelism * 4))
    covariance = _scatter(blocks, width, splits) / n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    values, axes = values[::-1].clip(min=0), axes[:, ::-1]
    trace, taken = float(np.trace(covariance)), min(components, width)
    varied = [i for i in range(taken) if values[i] > NONE * values[0] > 0]
    matrix = np.zeros((width, taken))
    matrix[:, varied] = axes[:, varied] / np.sqrt(values[varied])

    weights = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(width, taken, matrix.ravel(order="F")))], 1), width, taken)
    projected = _multiplied(blocks, weights, (rows_per_block, taken), 1)
    if varied:
        gram = _scatter(projected, taken, splits)[np.ix_(varied, varied)] / n
        error = float(np.abs(gram - np.eye(len(varied))).max())
    else:
        error = 0.0
    found = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    found = written(found.select("index", vector_to_array("vector").alias("row")))

    shares = F.array(*[F.lit(float(v / trace) if trace > 0 else 0.0) for v in values[:taken]])
    by_key = centred.select("index", "key", "deviation").join(found, "index").select("key", "deviation", "row")
    return (
        rows.select("_id", key)
        .join(by_key, "key")
        .select("_id", "deviation", F.posexplode("row").alias("place", "whitened"))
        .select(
            F.col("_id").alias(ids), F.lit(n).cast("long").alias("n"), "deviation", (F.col("place") + 1).cast("int").alias("component"), "whitened",
            shares[F.col("place")].alias("explained"), F.lit(error).alias("identity_error"),
        )
    )
