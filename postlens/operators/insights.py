"""Tables behind charts and reports, computed from the result tables."""
from pyspark.sql import Window, functions as F

from postlens.constants import CLASSES


def sources_of(table):
    return table.select("source").distinct().orderBy("source")


def choose(table, sources=None, first_day=None, last_day=None):
    """Rows of some sources and an inclusive range of days; None keeps all."""
    if sources is not None:
        table = table.where(F.col("source").isin(list(sources)))
    if first_day is not None:
        table = table.where(F.col("day") >= F.lit(first_day))
    if last_day is not None:
        table = table.where(F.col("day") <= F.lit(last_day))
    return table


def rolling_daily(daily, size=7, mode="rows"):
    """Daily mean score smoothed over the last ``size`` rows of a source (or calendar days)."""
    if mode == "rows":
        frame = Window.partitionBy("source").orderBy("day").rowsBetween(-(size - 1), 0)
    elif mode == "days":
        frame = Window.partitionBy("source").orderBy(F.unix_date("day")).rangeBetween(-(size - 1), 0)
    else:
        raise ValueError("mode is 'rows' or 'days'")
    # Daily means have four digits: whole ten-thousandths keep the sliding sum exact.
    points = F.sum(F.round(F.col("avg_compound") * 10000).cast("long")).over(frame)
    return daily.select("day", "source", "avg_compound",
                        (points / F.count("avg_compound").over(frame) / 10000).alias("smoothed"))


def keyword_series(keywords, tokens, sources=None):
    """Monthly counts of some keywords, summed over the chosen sources."""
    rows = choose(keywords, sources).where(F.col("token").isin(list(tokens)))
    return rows.groupBy("month", "token").agg(F.sum("n").alias("n"))


def keyword_per10k(keywords, totals, tokens, sources=None):
    """Monthly counts per 10,000 posts of the chosen sources; null in a month without a total."""
    base = choose(totals, sources).groupBy("month").agg(F.sum("n").alias("posts"))
    series = keyword_series(keywords, tokens, sources)
    return series.join(base, "month", "left").select(
        "month", "token", (F.try_divide(F.col("n"), F.col("posts")) * 10000).alias("per_10k"))


def top_by_count(table, term, n=15, sources=None):
    """Most frequent keywords or hashtags over the chosen sources."""
    counts = choose(table, sources).groupBy(term).agg(F.sum("n").alias("n"))
    return counts.orderBy(F.desc("n"), term).limit(n)


def tokens_of(keywords):
    return keywords.select("token").distinct().orderBy("token")


def default_terms(trends, n=3):
    """Tokens of the first trend rows."""
    return ranked_trends(trends).limit(n).select("token")


def ranked_trends(trends):
    return trends.orderBy(F.desc("burst_z"), "source", "token")


def first_communities(communities, n=15):
    return communities.orderBy(F.desc("n"), "community").limit(n)


def trend_overview(trends, n=10):
    """The first trend rows with the month as text."""
    return ranked_trends(trends).limit(n).select("token", "source", "total_mentions",
                                  F.date_format("peak_month", "yyyy-MM").alias("peak_month"), "lift", "burst_z")


def confusion_pivot(confusion):
    """One row per label, one column per predicted class."""
    return confusion.groupBy("orig").pivot("sentiment", CLASSES).sum("count").fillna(0)
