"""Burst detection: terms whose monthly share of a source's posts rises far above their own average.

Works on the aggregated term table and never builds a term-by-month matrix: months in which a term is
absent count as zero through closed formulas.
"""
from pyspark.sql import Window, functions as F

from postlens.constants import MIN_LIFT, PARTIAL_MONTH_SHARE, TEMPLATE_MONTH_SHARE
from postlens.scratch import settle

TREND_COLUMNS = ["token", "source", "total_mentions", "months_present", "peak_month", "peak_count", "peak_per_10k",
                 "avg_per_10k", "lift", "burst_z"]


def kept_months(totals, share=PARTIAL_MONTH_SHARE):
    """Months with at least ``share`` of their source's median volume, with the number of such months."""
    monthly = totals.groupBy("source", "month").agg(F.sum("n").alias("month_total"))
    of_source = Window.partitionBy("source")      # one row per month
    return (monthly.withColumn("typical", F.median("month_total").over(of_source))
            .where(F.col("month_total") >= share * F.col("typical")).drop("typical")
            .withColumn("months", F.count("*").over(of_source)))


def term_profiles(terms, months, min_total=200, min_months=4, peak_count_mode="max"):
    """One row per (source, term): volume, peak, mean share, lift and z-score over the kept months.

    ``peak_count_mode``: "max" reports the largest monthly count, "peak_month" the count in the month
    with the largest share; the two differ when the volume of the source changes.
    """
    if peak_count_mode not in ("max", "peak_month"):
        raise ValueError("peak_count_mode is 'max' or 'peak_month'")
    # One shuffle serves both groupings below; a term has at most one row per month, so none is hot.
    per_month = (terms.repartition("source", "token").groupBy("source", "token", "month").agg(F.sum("n").alias("n"))
                 .join(months, ["source", "month"])
                 .withColumn("share", F.col("n") / F.col("month_total") * 10000))
    # -share first, month second: the smallest struct is the highest share in its earliest month.
    peak = F.min(F.struct((-F.col("share")).alias("low"), "month", "n", "month_total"))
    sums = per_month.where(F.col("n") > 0).groupBy("source", "token").agg(
        F.sum("n").alias("total_mentions"), F.count("*").alias("months_present"), F.max("n").alias("max_count"),
        F.max("months").alias("months"), F.sum("share").alias("sum_share"), F.var_pop("share").alias("spread"),
        peak.alias("peak"))
    candidates = sums.where((F.col("total_mentions") >= min_total) & (F.col("months_present") >= min_months))

    k, m = F.col("months_present"), F.col("months")
    mean, top = F.col("sum_share") / m, -F.col("peak.low")
    present_mean = F.col("sum_share") / k
    # Squared distances to the mean: of the months present, and of the months in which the share is zero.
    squares = k * F.col("spread") + k * F.pow(present_mean - mean, 2) + (m - k) * mean * mean
    deviation = F.sqrt(F.try_divide(squares, m - 1))
    count = F.col("max_count") if peak_count_mode == "max" else F.col("peak.n")
    return candidates.select(
        "token", "source", "total_mentions", "months_present", F.col("peak.month").alias("peak_month"),
        count.alias("peak_count"), F.round(top, 2).alias("peak_per_10k"), F.round(mean, 2).alias("avg_per_10k"),
        F.round(top / mean, 2).alias("lift"),
        F.round(F.coalesce(F.try_divide(top - mean, deviation), F.lit(0.0)), 2).alias("burst_z"),
        F.col("peak.month_total").alias("peak_month_total"))


def bursting(profiles, min_peak_count=30, min_lift=MIN_LIFT):
    return profiles.where((F.col("lift") >= min_lift) & (F.col("peak_count") >= min_peak_count))


def template_groups(bursts, min_terms=8, tolerance=0.15):
    """(source, peak_month, peak_count) groups that look like one repeated post.

    A term is suspicious when at least ``min_terms`` other terms of its source peak in the same month with
    a count within ``tolerance`` of its own and that count is at least 1 % of the month's posts.

    Neighbours are counted from a histogram of peak counts: cumulative number of terms up to the upper
    bound less that below the lower bound. Counts are integers, so the bounds are exact, no pair of
    terms is ever formed, and a month holds no more rows than it has distinct counts.
    """
    place = ["source", "peak_month"]
    histogram = bursts.groupBy(*place, "peak_count").agg(
        F.count("*").alias("terms"), F.max("peak_month_total").alias("peak_month_total"))
    reach = F.floor(F.col("peak_count") * F.lit(float(tolerance))).cast("long")
    marks = histogram.select(*place, "peak_count", "peak_month_total", F.inline(F.array(
        F.struct(F.col("peak_count").alias("at"), F.col("terms").alias("adds"), F.lit(0).alias("sign")),
        F.struct((F.col("peak_count") + reach).alias("at"), F.lit(0).cast("long").alias("adds"), F.lit(1).alias("sign")),
        F.struct((F.col("peak_count") - reach - 1).alias("at"), F.lit(0).cast("long").alias("adds"),
                 F.lit(-1).alias("sign")))))
    up_to = Window.partitionBy(*place).orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    near = (marks.withColumn("cumulative", F.sum("adds").over(up_to))
            .groupBy(*place, "peak_count")
            .agg((F.sum(F.col("cumulative") * F.col("sign")) - 1).alias("neighbours"),
                 F.max("peak_month_total").alias("peak_month_total")))
    return near.where((F.col("neighbours") >= min_terms)
                      & (F.col("peak_count") >= TEMPLATE_MONTH_SHARE * F.col("peak_month_total")))


def drop_templates(bursts, min_terms=8, tolerance=0.15):
    """Bursts without those made of repeated template posts."""
    groups = template_groups(bursts, min_terms, tolerance).select("source", "peak_month", "peak_count")
    return bursts.join(groups, ["source", "peak_month", "peak_count"], "left_anti")


def top_terms(bursts, terms, top_n=40):
    """The strongest terms of each source; ``top_n`` is shared by all sources of the term table."""
    of_source = Window.partitionBy("source").orderBy(F.desc("burst_z"), "token")
    share = terms.agg(F.greatest(F.floor(F.lit(top_n) / F.greatest(F.count_distinct("source"), F.lit(1))),
                                 F.lit(1)).alias("n")).scalar()
    # The constant bound lets each task keep its own best rows only, before anything is shuffled.
    ranked = bursts.withColumn("rank", F.row_number().over(of_source)).where(F.col("rank") <= max(top_n, 1))
    return (ranked.where(F.col("rank") <= share).select(TREND_COLUMNS)
            .orderBy(F.desc("burst_z"), "source", "token"))


def detect_trends(terms, totals, top_n=40, min_total=200, min_months=4, min_peak_count=30, template_min_terms=8,
                  template_tolerance=0.15, peak_count_mode="max"):
    """Trending terms from the monthly term table (month, source, token, n) and monthly totals."""
    months = settle(kept_months(totals), "months")     # sources x months; broadcast by its measured size
    profiles = term_profiles(terms, months, min_total, min_months, peak_count_mode)
    # Settled: the template filter reads the surviving terms twice.
    bursts = settle(bursting(profiles, min_peak_count), "bursts")
    return top_terms(drop_templates(bursts, template_min_terms, template_tolerance), terms, top_n)


def trends_by_source(trends):
    return trends.groupBy("source").agg(F.count("*").alias("terms"))
