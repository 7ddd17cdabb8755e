"""Scaling measurements."""
from pyspark.sql import functions as F

from postlens.constants import LINEAR_BELOW, RUN_FRACTIONS, SUB_LINEAR_BELOW, WARM_UP_FRACTION
from postlens.plans.analytics import run_analytics


def scalability(posts, lexicon, results=None, fractions=RUN_FRACTIONS, warm_up=WARM_UP_FRACTION, **options):
    """Metrics of the analysis at growing fractions, after an unrecorded warm-up; the full run is stored."""
    if warm_up:
        run_analytics(posts, lexicon, warm_up, **options)
    return [run_analytics(posts, lexicon, f, results if f == 1.0 else None, **options)[0] for f in fractions]


def growth_verdict(metrics):
    """How run time grew from the smallest to the largest fraction of a metrics table."""
    ends = metrics.agg(F.min_by("total_seconds", "dataset_fraction").alias("small_seconds"),
                       F.max_by("total_seconds", "dataset_fraction").alias("full_seconds"))
    ratio = F.try_divide(F.col("full_seconds"), F.col("small_seconds"))
    return ends.withColumn("ratio", ratio).withColumn(
        "verdict", F.when(F.col("ratio") < SUB_LINEAR_BELOW, F.lit("sub-linear"))
        .when(F.col("ratio") < LINEAR_BELOW, F.lit("linear"))
        .when(F.col("ratio").isNotNull(), F.lit("super-linear")))
