"""Helpers the corpus operators share."""
import sys

from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from postlens.scratch import settle

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shipped(module):
    """Send the functions of a module to the executors with their code, so that they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def let(value, body):
    """``body(value)`` with ``value`` evaluated once per row, also where lambdas use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(df, name):
    """A column name ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def whole_text(name="text"):
    return F.coalesce(F.col(name), F.lit(""))


def running(df, order, sums=()):
    """Every row with what precedes it in a total order: ``row_before`` and ``<name>_before`` for each sum.

    The rows are dealt into ranges and written down, so a range keeps its number if a task is repeated.
    Only one total per range is put in order in a single task; the rows are ordered inside their range.
    """
    spread = settle(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    start, inside = (Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1),
                     Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    zero = F.lit(0)
    totals = spread.groupBy("_range").agg(F.count("*").alias("_rows"), *[F.sum(s).alias(f"_{s}") for s in sums])
    starts = totals.select(
        "_range", F.coalesce(F.sum("_rows").over(start), zero).alias("_rows"),
        *[F.coalesce(F.sum(f"_{s}").over(start), zero).alias(f"_{s}") for s in sums])
    return spread.join(starts, "_range").select(
        *df.columns, (F.col("_rows") + F.count("*").over(inside)).alias("row_before"),
        *[(F.col(f"_{s}") + F.coalesce(F.sum(s).over(inside), zero)).alias(f"{s}_before") for s in sums])


def bounded_sample(rows, key, most, n):
    """At most ``most`` of ``n`` rows on the driver, those with the smallest hashes of the ``key`` columns.

    Only rows below a threshold that about a fifth more rows pass leave the executors, however many partitions there are.
    """
    hashed = rows.withColumn("_hash", F.xxhash64(*key))
    if n > most:
        hashed = hashed.where(F.col("_hash") < int((1.2 * most / n) * 2 ** 64) - 2 ** 63 if 1.2 * most < n else F.lit(True))
    found = hashed.limit(2 * most).collect()
    return sorted(found, key=lambda r: (r["_hash"], repr(r)))[:most]


def components(nodes, edges, node="id"):
    """Connected components: ``(node, component)`` with the smallest node of each component.

    ``edges`` has the columns ``a`` and ``b``. Rounds of star contraction (Kiveris et al., 2014): large stars hang
    every larger neighbour on the smallest one, small stars do the same with the smaller neighbours; the number
    of rounds grows with the logarithm of the component size. A round is written to the shared folder, so lineage
    stays short. Minima merge before each shuffle, so the hub of a star costs one row per task; they are written down
    too, as Spark divides the links of a hub among tasks only where both sides of a join come straight from a shuffle.
    """
    links = settle(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _fingerprint(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = settle(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = settle(large.where(F.col("a") != F.col("b")).distinct(), "links")
        least = settle(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                              F.col("m").alias("b"))
        links = settle(small.where(F.col("a") != F.col("b")).distinct(), "links")
        before, state = state, _fingerprint(links)
        if before == state:
            break
    found = links.select(F.col("a").alias(node), F.col("b").alias("component"))
    return nodes.select(node).join(found, node, "left").select(
        node, F.coalesce("component", node).alias("component"))


def _fingerprint(links):
    """Row count and an order-free digest of the links: one row on the driver."""
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                    F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["x"], row["s"]
