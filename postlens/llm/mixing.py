"""Mixing sources to target weights by hash-threshold histograms.

The size of a document is its number of words (runs of other characters than ASCII white space; null text: 0).
Sources in code-point order (null is a source of its own and comes last) weigh ``weights`` in turn and share
``share`` times all sizes; a source gets at most ``cap`` times its size and what is above goes to the others by
weight. Whole passes over a source are taken by all its documents; the rest by the documents whose hash lies
below a threshold. The threshold is read from sums per hash bucket, and only the bucket that holds the border is
divided again, so nothing is sorted. The hash covers id and text: repeated rows are taken together, and reruns agree
whatever the partitioning. The empty table and sources without words get targets of 0. Other columns are ignored.
"""
from pyspark.sql import Window
from pyspark.sql import functions as F

from postlens.llm.common import WORD, fresh, running
from postlens.scratch import settle

BITS, STEP = 60, 10


def word_count(text):
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def mark():
    """60 bits of a hash of id and text."""
    return F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 64 - BITS)


def targets(per_source, weights=(5, 2, 1), share=1.5, cap=2):
    """``(source, source_size, target)``: the level at which weight times level, cut at the caps, adds up to the budget.

    In the order of cap by weight the candidate level rises while sources are cut and falls afterwards: it is the maximum.
    """
    ranked = running(per_source, [F.col("source").asc_nulls_last()])
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = settle(ranked.select("source", "source_size", F.get(turn, F.col("row_before") % len(weights)).alias("weight"),
                                   (F.col("source_size") * float(cap)).alias("most")), "weights")
    sums = weighed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget, weight = share * (sums["size"] or 0), sums["weight"] or 0.0
    filled = running(weighed.withColumn("ratio", F.col("most") / F.col("weight")),
                     [F.col("ratio"), F.col("source").asc_nulls_first()], ["most", "weight"])
    level = filled.agg(F.max((budget - F.col("most_before")) / (weight - F.col("weight_before"))).alias("x")).first()["x"]
    return weighed.select("source", "source_size", F.least("most", F.col("weight") * (level or 0.0)).alias("target"))


def thresholds(slim, sources):
    """``(source, ..., passes, below)``: documents whose mark is under ``below`` are taken once more than ``passes``."""
    state = settle(sources.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(
        F.col("target") / F.col("source_size"))).otherwise(0)).withColumns({
            "need": F.col("target") - F.col("passes") * F.col("source_size"), "prefix": F.lit(0).cast("long"),
            "open": F.col("source_size") > 0}), "border")
    inside = slim.where(F.col("size") > 0)
    for left in range(BITS - STEP, -1, -STEP):
        border = state.where("open").select(F.col("source").alias("s"), "need", "prefix")
        same = F.shiftright("mark", left + STEP) == F.col("prefix") if left + STEP < BITS else F.lit(True)
        inside = inside.join(border, F.col("source").eqNullSafe(F.col("s")) & same).select("source", "size", "mark", "need")
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        buckets = inside.groupBy("source", F.shiftright("mark", left).alias("bucket")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"), F.first("need").alias("need"))
        cut = buckets.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).where(
            (F.col("before") <= F.col("need")) & (F.col("need") < F.col("before") + F.col("words"))).select(
            F.col("source").alias("s"), "bucket", "n", "words", (F.col("need") - F.col("before")).alias("rest"))
        # One document, or equal marks, in the border bucket: taken if that comes nearer to the target.
        done = (F.col("n") == 1) | F.lit(left == 0)
        more = F.when(done & (2 * F.col("rest") >= F.col("words")), 1).otherwise(0)
        final = F.shiftleft(F.coalesce(F.col("bucket") + more, F.lit(0)), left)
        state = settle(state.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "passes",
            F.when(F.col("open"), F.col("rest")).otherwise(F.col("need")).alias("need"),
            F.when(~F.col("open"), F.col("prefix")).when(done, final).otherwise(F.col("bucket")).alias("prefix"),
            (F.col("open") & F.coalesce(~done, F.lit(False))).alias("open")), "border")
        inside = inside.drop("need")
        if not state.where("open").limit(1).count():
            break
    return state.withColumn("below", F.coalesce("prefix", F.lit(0))).drop("need", "prefix", "open")


def mix(docs, weights=(5, 2, 1), share=1.5, cap=2):
    """One row per document: doc_id, source, size, source_size, target, copies (0 to cap), taken (words)."""
    slim = settle(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mark().alias("mark")), "sizes")
    per_source = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    found = thresholds(slim, targets(per_source, weights, share, cap)).withColumnRenamed("source", "s")
    copies = F.col("passes") + F.when(F.col("mark") < F.col("below"), 1).otherwise(0)
    return slim.join(found, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "doc_id", "source", "size", "source_size", "target", F.when(F.col("size") > 0, copies).otherwise(0).alias("copies"),
        F.col("mark"), "below", "passes").withColumn("taken", F.col("copies") * F.col("size"))


def draw(docs, weights=(5, 2, 1), share=1.5, cap=2):
    """The mix itself: each document with words as often as it is taken, with the columns of ``docs``."""
    size, key = fresh(docs, "size"), fresh(docs, "mark")
    wide = docs.select("*", word_count(F.col("text")).alias(size), mark().alias(key))
    slim = settle(wide.select("source", F.col(size).alias("size"), F.col(key).alias("mark")), "sizes")
    per_source = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    found = thresholds(slim, targets(per_source, weights, share, cap)).select(
        *[F.col(c).alias(fresh(docs, f"mix_{c}")) for c in ("source", "passes", "below")])
    source, passes, below = found.columns
    copies = F.col(passes) + F.when(F.col(key) < F.col(below), 1).otherwise(0)
    return wide.join(found, F.col("source").eqNullSafe(F.col(source))).where((F.col(size) > 0) & (copies > 0)).withColumn(
        key, F.explode(F.array_repeat(F.lit(0), copies.cast("int")))).select(*docs.columns)
