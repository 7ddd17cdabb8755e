"""Whitening of embeddings with distributed block matrices.

A vector becomes whole numbers ``x = floor(64 c) + 1000000`` (64 c beyond 2**52 in size counts as that). Rows get a gapless
index, are centred and dealt as blocks of an MLlib ``BlockMatrix``; its transpose times itself is the scatter matrix (dimensions
squared, the only matrix the driver sees).
A local eigen-decomposition of the covariance gives the whitening matrix, and a second block product projects every row.
Left alone, the scatter product would deal all row blocks to the one task that owns the single result block: the middle dimension is
therefore split, so that many tasks multiply blocks and only their small products are added up.

Rows with a null vector, or one with null or non-finite entries, are dropped. The dimension is the most frequent
length of the others (the larger one on a tie); vectors of other lengths and empty ones are dropped too. Repeated rows and null ids
count and are returned like any other. Components without variance (below 1e-12 of the largest eigenvalue) have no
whitened value and are left out; an empty table gives no rows. ``deviation`` is exact, and null where a long cannot hold it.
Other columns are ignored.
"""
import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Window
from pyspark.sql import functions as F

from postlens.scratch import settle

ROWS_PER_BLOCK, BLOCKS_PER_TASK = 1024, 4
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
LARGEST = 2.0 ** 52
LEAST_SHARE = 1e-12


def whole_numbers(table, vector="embedding", key="vec_id"):
    """``(key, x)`` of the usable rows."""
    usable = table.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))))
    length = usable.groupBy(F.size(vector).alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    x = F.transform(vector, lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-LARGEST)), F.lit(LARGEST))) + SHIFT)
    return usable.where(F.size(vector) == (length["length"] if length else 0)).select(F.col(key).alias("key"), x.alias("x"))


def indexed(rows):
    """``rows`` with a gapless ``idx`` from 0, without a sort: a running count over the tasks that wrote them."""
    dealt = settle(rows.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()), "dealt")
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = settle(counts.select("_part", before.alias("_start")), "starts")
    place = F.col("_start") + F.col("_id").bitwiseAND((1 << 33) - 1)
    return dealt.join(starts, "_part").select(place.alias("idx"), *rows.columns)


def blocks(rows, height, width, values):
    """Block matrix of ``(idx, array of double)`` rows, cut into blocks of ``height`` rows."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(F.col("idx").alias("index"), array_to_vector(values).alias("vector")), "vector")
    return IndexedRowMatrix(vectors).toBlockMatrix(height, width)


def product(left, right, splits=1):
    """``left @ right``; ``splits`` tasks share the middle dimension of each result block."""
    made = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, left.rowsPerBlock, right.colsPerBlock)


def gram(matrix, n):
    """Transpose times matrix, a small local array."""
    return product(matrix.transpose(), matrix, max(1, n // (ROWS_PER_BLOCK * BLOCKS_PER_TASK))).toLocalMatrix().toArray()


def rows_of(matrix):
    """``(idx, values)`` of a block matrix as a DataFrame."""
    found = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return found.select(F.col("index").alias("idx"), vector_to_array("vector").alias("values"))


def whiten(table, components=COMPONENTS, vector="embedding", key="vec_id"):
    """One row per usable vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    spark = table.sparkSession
    rows = settle(indexed(whole_numbers(table, vector, key)), "vectors")
    n = rows.count()
    # One row per dimension reaches the driver.
    sums = rows.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s"))
    total = [int(r["s"]) for r in sums.orderBy("j").collect()]
    width = len(total)
    columns = (key, "component", "n", "deviation", "whitened", "explained", "identity_error")
    schema = table.select(key).withColumns({c: F.lit(0).cast(t) for c, t in zip(
        columns[1:], ("int", "long", "long", "double", "double", "double"), strict=True)}).schema
    if not n:
        return spark.createDataFrame([], schema)
    if max(map(abs, total)) < 1 << 63:
        off = F.zip_with("x", F.array(*[F.lit(s).cast("long") for s in total]), lambda x, s: F.try_subtract(
            F.try_multiply(x, F.lit(n).cast("long")), s))
        deviation = F.aggregate(off, F.lit(0).cast("long"), lambda acc, v: F.try_add(acc, F.try_multiply(v, v)))
    else:
        deviation = F.lit(None).cast("long")
    means = F.array(*[F.lit(s / n) for s in total])
    centred = blocks(rows, ROWS_PER_BLOCK, width, F.zip_with("x", means, lambda x, mean: x - mean))
    covariance = gram(centred, n) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    used = int(np.sum(values[:components] > LEAST_SHARE * max(values[0], 0)))
    if not used:
        return spark.createDataFrame([], schema)
    weights = vectors[:, :used] / np.sqrt(values[:used])
    matrix = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(weights)], "idx long, w array<double>")
    projected = settle(rows_of(product(centred, blocks(matrix, width, used, "w"))), "whitened")
    # Columns of centred rows have the mean 0 but for rounding, so these products are the covariance of the whitened rows.
    error = float(np.abs(gram(blocks(projected, ROWS_PER_BLOCK, used, "values"), n) / n - np.eye(used)).max())
    shares = F.array(*[F.lit(float(v / np.trace(covariance))) for v in values[:used]])
    out = rows.select("idx", "key", deviation.alias("deviation")).join(projected, "idx")
    out = out.select("key", "deviation", F.posexplode("values").alias("place", "whitened"))
    return out.select(F.col("key").alias(key), (F.col("place") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(shares, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"))
