"""Fractions, slices, first rows and byte budgets.

Budgets need a running total over a total order. It is computed without a global window: only the order
columns and the weight are range-partitioned, totals per range are added up, and the exact cut row is
looked for inside the one range where the budget runs out. The result is then a plain filter on the
order columns, which reaches the scan.
"""
from pyspark.sql import Window, functions as F

from postlens.functions.sizes import row_bytes
from postlens.scratch import settle

ROWS_IN_ORDER = 1_000_000     # rows a single task may put in order


def fraction_of(posts, fraction):
    """Repeatable sample: posts with ``sample_key`` below ``fraction``; posts without a key are out."""
    return posts.where(F.col("sample_key") < fraction)


def key_slice(posts, low, high):
    """Half-open slice of the sample key."""
    return posts.where((F.col("sample_key") >= low) & (F.col("sample_key") < high))


def ranges_with_totals(slim, order, weight, parts=None):
    """Settle ``slim`` in (``parts``) ranges of ``order`` and give each range the weight before it.

    Returns the settled table with a ``range`` column, and one row per range: ``range, rows, total, before``.
    """
    ranged = slim.repartitionByRange(*([parts] if parts else []), *order).withColumn("range", F.spark_partition_id())
    table = settle(ranged, "ranges")
    totals = table.groupBy("range").agg(F.count("*").alias("rows"), F.sum(weight).alias("total"))
    running = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    return table, totals.withColumn("before", F.coalesce(F.sum("total").over(running), F.lit(0)))


def rows_at(slim, order, weight, targets, parts=None):
    """For each target the row at which the running weight reaches it (left out if it never does).

    A range that holds a target but more than ``ROWS_IN_ORDER`` rows is divided into ranges again, so no task
    orders more than that, whatever the number of rows. All targets are looked up in one pass.
    """
    table, totals = ranges_with_totals(slim, order, weight, parts)
    homes = {}
    for r in totals.collect():     # one row per shuffle partition
        inside = [t for t in targets if r["before"] < t <= r["before"] + r["total"]]
        if inside:
            homes[r["range"]] = (r, inside)
    found, ready = {}, []
    for r, inside in homes.values():
        if r["rows"] <= ROWS_IN_ORDER:
            ready += [(r, t) for t in inside]
            continue
        part = table.where(F.col("range") == r["range"]).drop("range")
        ends = part.agg(F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high")).first()
        if ends["low"] == ends["high"]:
            raise ValueError(f"rows are not in a total order by {order}: add a unique column")
        deeper = rows_at(part, order, weight, [t - r["before"] for t in inside],
                         min(2 + 2 * r["rows"] // ROWS_IN_ORDER, 1000))
        found |= {t + r["before"]: row for t, row in deeper.items()}
    if ready:
        running = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        inside = table.where(F.col("range").isin([r["range"] for r, _ in ready])).withColumn("reached", F.sum(weight).over(running))
        wanted = F.lit(False)
        for r, t in ready:
            rest = t - r["before"]
            wanted = wanted | ((F.col("range") == r["range"]) & (F.col("reached") >= rest) & (F.col("reached") - F.col(weight) < rest))
        hits = inside.where(wanted).collect()     # at most one per target
        for r, t in ready:
            found[t] = next(h for h in hits if h["range"] == r["range"] and h["reached"] - h[weight] < t - r["before"] <= h["reached"])
    return found


def _cut(slim, order, weight, target):
    """Order values of the row at which the running weight reaches ``target``; None if it never does."""
    cut = rows_at(slim, order, weight, [target]).get(target)
    if cut is None:
        return None
    same = F.lit(True)
    for name in order:
        same = same & F.col(name).eqNullSafe(F.lit(cut[name]))
    if slim.where(same).limit(2).count() > 1:
        raise ValueError(f"rows are not in a total order by {order}: add a unique column")
    return [cut[name] for name in order]


def _up_to(order, values):
    """Lexicographic ``order <= values``, nulls first. The first column alone bounds the scan."""
    condition = F.lit(True)
    for name, value in reversed(list(zip(order, values))):
        column = F.col(name)
        if value is None:
            condition = column.isNull() & condition
        else:
            condition = column.isNull() | (column < value) | ((column == value) & condition)
    first = F.col(order[0])
    return (first.isNull() if values[0] is None else first.isNull() | (first <= values[0])) & condition


def _keep_while_below(df, order, weight, target):
    slim = df.select(*order, weight.alias("weight"))
    cut = _cut(slim, order, "weight", target)
    return df if cut is None else df.where(_up_to(order, cut))


def first_rows(df, n, order):
    """The first ``n`` rows by the unique ``order`` columns, nulls first, for any ``n``."""
    if n <= 0:
        return df.where(F.lit(False))
    return _keep_while_below(df, list(order), F.lit(1).cast("long"), n)


def byte_budget(df, target, order):
    """Rows in order until their estimated bytes reach ``target``; the row that crosses it is kept.

    ``order`` must be unique; nulls come first.
    """
    if target <= 0:
        return df.where(F.lit(False))
    return _keep_while_below(df, list(order), row_bytes(df.columns), target)


def priority_budget(df, target, group, priorities, order):
    """Byte budget shared by groups that are taken in the order of ``priorities``.

    Rows of other groups are left out; a listed group without rows takes nothing.
    """
    rank = F.coalesce(*[F.when(F.col(group) == value, F.lit(position)) for position, value in enumerate(priorities)])
    ranked = df.withColumn("priority", rank).where(F.col("priority").isNotNull())
    if target <= 0:
        return ranked.where(F.lit(False)).drop("priority")
    kept = _keep_while_below(ranked, ["priority", *order], row_bytes(df.columns), target)
    return kept.drop("priority")
