"""Shards cut from a Hilbert curve over quantised metadata.

Each dimension is quantised to ``bits`` bits: a measure by its logarithm, a category by its place in the cumulated row
counts of the ordered categories. Rows are ordered by curve index, then text checksum, id and hash, and the order is cut
into runs of equal bytes. A file of a run covers a small box of every dimension, so filters on any of them skip files.
Law ``bytes``: a shard's bytes differ from the mean by at most one document. Null categories come last; null measures
count as 0, null texts as no bytes; repeated rows lie next to each other. An empty table gives no rows.
"""
from pyspark.sql import functions as F

from postlens.llm.common import fresh, let, running, whole_text
from postlens.scratch import forget, settle

BITS = 8


def by_log(column, bits=BITS):
    """0 up to 2**32, in equal steps of the logarithm."""
    steps = (1 << bits) - 1
    value = F.greatest(F.coalesce(F.col(column).cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.least(F.lit(steps), F.floor(F.log2(value + 1) * (steps / 32))).cast("int")


def by_share(df, column, bits=BITS):
    """``(category, quantum)``: the share of rows in earlier categories."""
    counts = running(df.groupBy(column).agg(F.count("*").alias("n")), [F.col(column).asc_nulls_last()], ["n"])
    total = df.count()
    return counts.select(F.col(column).alias(f"_{column}"),
                         F.floor(F.col("n_before") * (1 << bits) / F.lit(max(total, 1))).cast("int").alias(f"{column}_q"))


def hilbert(dims, bits=BITS):
    """Index on the Hilbert curve of the given integer columns (Skilling's transform, 2004)."""
    n = len(dims)

    def at(x, i):
        return F.get(x, F.lit(i) if isinstance(i, int) else i)

    def exchange(x, i, low):
        swap = let(F.get(x, F.lit(0)).bitwiseXOR(F.get(x, i)).bitwiseAND(low), lambda t: F.transform(
            x, lambda v, j: F.when((j == 0) | (j == i), v.bitwiseXOR(t)).otherwise(v)))
        invert = F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
        return F.when(F.get(x, i).bitwiseAND(low + 1) != 0, invert).otherwise(swap)

    lows = F.array(*[F.lit((1 << b) - 1) for b in range(bits - 1, 0, -1)])
    axes = F.array(*[F.lit(i) for i in range(n)])
    turned = F.aggregate(lows, F.array(*dims), lambda x, low: F.aggregate(axes, x, lambda y, i: exchange(y, i, low)))

    def gray(x):
        steps = [at(x, 0)]
        for i in range(1, n):
            steps.append(at(x, i).bitwiseXOR(steps[-1]))
        return F.array(*steps)

    def level(x):
        last = at(x, n - 1)
        t = F.aggregate(lows, F.lit(0), lambda acc, low: F.when(
            last.bitwiseAND(low + 1) != 0, acc.bitwiseXOR(low)).otherwise(acc))
        return let(t, lambda v: F.transform(x, lambda a: a.bitwiseXOR(v)))

    def interleave(x):
        return sum((F.shiftleft(F.shiftright(at(x, i), b).bitwiseAND(1).cast("long"), b * n + n - 1 - i)
                    for b in range(bits) for i in range(n)), F.lit(0).cast("long"))

    return let(let(let(turned, gray), level), interleave)


def assign(docs, shards=16, categories=("source", "lang"), logs=("n_chars",), bits=BITS, carry=()):
    """One row per document: doc_id, size, text_crc32, curve, shard and slot (gapless inside a shard), and columns to ``carry``."""
    text = whole_text()
    slim = settle(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_hash"),
                              *categories, *logs, *carry), "slim")
    dims, placed = [], slim
    for c in categories:
        quanta = by_share(slim, c, bits)
        placed = placed.join(quanta, F.col(c).eqNullSafe(F.col(f"_{c}")), "left")
        dims.append(F.col(f"{c}_q"))
    dims += [by_log(c, bits) for c in logs]
    curve = placed.select("doc_id", "size", "text_crc32", "_hash", hilbert(dims, bits).alias("curve"), *carry)
    ordered = settle(running(curve, [F.col(c) for c in ("curve", "text_crc32", "_hash", "doc_id", "size")], ["size"]), "ordered")
    total = ordered.agg(F.sum("size").alias("x")).first()["x"] or 1
    middle = 2 * F.col("size_before") + F.col("size")
    cut = ordered.withColumn("shard", F.floor(middle * F.lit(shards).cast("long") / F.lit(2 * total)).cast("int"))
    first = cut.groupBy("shard").agg(F.min("row_before").alias("_first"))
    return cut.join(first, "shard").select("doc_id", "size", "text_crc32", "curve", "shard",
                                           (F.col("row_before") - F.col("_first")).alias("slot"), *carry)


def write_shards(docs, path, rows_per_file=100_000, **options):
    """Write every row of ``docs`` into one folder per shard; each file is a run of the curve.

    Rows get a number of their own first, by which they find their place again: null and repeated ids do not matter.
    Columns named like the results stay; the folders' column is then called ``_shard`` (or has more underscores).
    """
    number, name, slot = (fresh(docs, c) for c in ("_row", "shard", "_slot"))
    numbered = settle(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    places = assign(numbered, carry=(number,), **options).select(number, F.col("shard").alias(name), F.col("slot").alias(slot))
    out = numbered.join(places, number).drop(number).repartition(name, F.floor(F.col(slot) / rows_per_file))
    out.sortWithinPartitions(name, slot).drop(slot).write.partitionBy(name).parquet(path)
    forget(numbered)
