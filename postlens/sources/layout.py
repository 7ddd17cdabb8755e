"""A file layout that serves two access paths at once: rows along a Z-order curve.

Sample keys and times are cut into equal shares, the bits of both numbers interleaved, and rows put in that order. A row group then
covers a small box of both dimensions, so its statistics let either predicate skip it: about the square root of
the row groups is left for a narrow range of one of them.
"""
from pyspark.sql import functions as F

from postlens.scratch import settle

BITS = 8


def interleaved(numbers, bits=BITS):
    """Bits of several integer columns in turn, the highest first."""
    places = [(b, k) for b in range(bits) for k in range(len(numbers))]
    return sum((F.shiftleft(F.shiftright(numbers[k].cast("long"), b).bitwiseAND(1), b * len(numbers) + len(numbers) - 1 - k)
                for b, k in places), F.lit(0).cast("long"))


def time_cuts(posts, bits=BITS):
    """Per source, the times that cut its posts into about equal shares (a row of 2**bits - 1 numbers per source)."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    return posts.groupBy("source").agg(F.percentile_approx(F.unix_micros("created_ts"), shares, 10_000).alias("cuts"))


def share_of(value, cuts, bits=BITS):
    """Number of cuts not above the value, by halving: as many comparisons as bits."""
    def upper(step):
        return lambda low: F.when(value >= F.get(cuts, low + (step - 1)), low + step).otherwise(low)

    found = F.lit(0)
    for b in range(bits - 1, -1, -1):
        found = F.transform(F.array(found), upper(1 << b))[0]      # as a lambda's argument, each step is computed once
    return found


def z_ordered(posts, bits=BITS):
    """Posts dealt by range and sorted along the curve of (sample_key, created_ts) inside their source."""
    # Written down, the few cuts have a known size and are broadcast; joined by shuffle, all posts of a source would go to one task.
    cuts = settle(time_cuts(posts, bits), "cuts").select(F.col("source").alias("_source"), "cuts")
    key = F.floor(F.greatest(F.least(F.coalesce("sample_key", F.lit(0.0)), F.lit(1.0 - 1e-9)), F.lit(0.0)) * (1 << bits))
    time = F.coalesce(share_of(F.unix_micros("created_ts"), F.col("cuts"), bits), F.lit(0))
    placed = posts.join(cuts, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        *posts.columns, interleaved([key, time], bits).alias("_z"))
    return placed.repartitionByRange("source", "_z").sortWithinPartitions("source", "_z").drop("_z")
