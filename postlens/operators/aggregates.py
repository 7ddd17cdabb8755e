"""Result tables computed from scored posts.

Every table is a partial-then-final aggregation, so a hot month, source or token reaches the shuffle as
one row per task.
"""
from pyspark.sql import functions as F

from postlens.constants import CLASSES, MIN_HASHTAG_COUNT, MIN_HASHTAG_LENGTH, MIN_KEYWORD_COUNT, STOPWORDS
from postlens.functions.labels import label_class
from postlens.functions.text import distinct_hashtags, distinct_tokens, is_keyword
from postlens.scratch import settle

SCORED_COLUMNS = ["source", "sentiment", "day", "month", "compound", "community", "text_v", "text_clean",
                  "orig_sentiment", "orig_score"]


def analysis_columns(scored):
    """The columns the result tables need."""
    return scored.select(SCORED_COLUMNS)


def _rows(name="n"):
    return F.count("*").alias(name)


def _mean_compound():
    """Mean score, four digits. Scores have four digits, so they are added up as whole ten-thousandths: the
    sum is exact and the rounding of a half does not depend on the order in which tasks finish."""
    points = F.sum(F.round(F.col("compound") * 10000).cast("long"))
    return (F.round(points / F.count("compound")) / 10000).alias("avg_compound")


def sentiment_by_source(scored):
    return scored.groupBy("source", "sentiment").agg(_rows("count"))


def daily_sentiment(scored):
    return (scored.groupBy("day", "source")
            .agg(_rows(), _mean_compound(),
                 F.count_if(F.col("sentiment") == "positive").alias("n_pos"),
                 F.count_if(F.col("sentiment") == "negative").alias("n_neg"))
            .orderBy("source", "day"))


def monthly_totals(scored):
    return scored.groupBy("month", "source").agg(_rows())


def compound_hist(scored):
    """Posts per source and 0.1-wide score bin; the bin is named by its lower edge.

    The bin number is an integer, so edges such as -0.8 are exact and labels have one digit.
    """
    number = F.floor(F.round((F.col("compound") + 1) * 10, 9))
    return (scored.groupBy("source", number.alias("number")).agg(_rows("count"))
            .select("source", F.round(F.col("number") / 10 - 1, 1).alias("bin"), "count")
            .orderBy("source", "bin"))


def community_sentiment(scored, ordered=True):
    table = scored.where(F.col("community").isNotNull()).groupBy("community").agg(_rows(), _mean_compound())
    return table.orderBy(F.desc("n"), "community") if ordered else table


def _monthly_terms(scored, terms, name, keep, min_count):
    counts = (scored.select("month", "source", F.explode(terms).alias(name)).where(keep)
              .groupBy("month", "source", name).agg(_rows()))
    return counts.where(F.col("n") >= min_count)


def keyword_monthly(scored, min_count=MIN_KEYWORD_COUNT, stopwords=STOPWORDS):
    """Posts that contain a keyword, per month and source."""
    return _monthly_terms(scored, distinct_tokens(F.col("text_clean")), "token",
                          is_keyword(F.col("token"), stopwords), min_count)


def hashtag_monthly(scored, min_count=MIN_HASHTAG_COUNT):
    """Posts that carry a hashtag, per month and source."""
    return _monthly_terms(scored, distinct_hashtags(F.col("text_v")), "hashtag",
                          F.length("hashtag") >= MIN_HASHTAG_LENGTH, min_count)


def labelled(scored):
    """Posts whose data-set label belongs to one of the three classes, given as ``orig``."""
    return scored.withColumn("orig", label_class(F.col("orig_sentiment"))).where(F.col("orig").isNotNull())


def validation_confusion(scored):
    return labelled(scored).groupBy("orig", "sentiment").agg(_rows("count"))


def validation_corr(scored):
    """Pearson correlation of our score with the data set's; NaN without rows or without variation."""
    pairs = labelled(scored).where(F.col("orig_score").isNotNull())
    spread = F.sqrt(F.var_pop("compound") * F.var_pop("orig_score"))
    value = F.try_divide(F.covar_pop("compound", "orig_score"), spread)
    return pairs.agg(F.coalesce(value, F.lit(float("nan"))).alias("value")).select(
        F.lit("pearson_compound_vs_orig_score").alias("metric"), "value")


def label_counts(posts, label="orig_sentiment"):
    """Rows per label, most frequent first; posts without label included."""
    return posts.groupBy(label).agg(_rows("count")).orderBy(F.desc("count"), label)


def class_share(by_source):
    """Posts per source and the share of each class."""
    total = F.sum("count")
    return by_source.groupBy("source").agg(
        total.alias("posts"),
        *[F.try_divide(F.sum(F.when(F.col("sentiment") == c, F.col("count")).otherwise(F.lit(0))), total).alias(c)
          for c in CLASSES])


def source_contrast(shares, similar_below=1.0):
    """Sources with the highest and lowest positive share, and their distance in percentage points."""
    row = F.struct("source", "positive", "negative")
    ends = shares.agg(F.min_by(row, F.struct(-F.col("positive"), "source")).alias("high"),
                      F.min_by(row, F.struct("positive", "source")).alias("low"))
    gap = (F.col("high.positive") - F.col("low.positive")) * 100
    return ends.select(
        F.col("high.source").alias("highest"), F.col("low.source").alias("lowest"),
        F.col("high.positive").alias("highest_positive"), F.col("low.positive").alias("lowest_positive"),
        F.col("high.negative").alias("highest_negative"), F.col("low.negative").alias("lowest_negative"),
        gap.alias("gap_points"),
        F.when(gap < similar_below, F.lit("similar")).otherwise(F.lit("different")).alias("verdict"))


def covered_span(daily):
    return daily.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def kpis(daily):
    """Totals over (already filtered) days: posts, post-weighted mean score, positive and negative share."""
    posts = F.coalesce(F.sum("n"), F.lit(0))
    per_post = lambda value: F.coalesce(F.sum(value), F.lit(0.0)) / F.greatest(posts, F.lit(1))
    return daily.agg(posts.alias("posts"), per_post(F.col("avg_compound") * F.col("n")).alias("avg_compound"),
                     per_post(F.col("n_pos").cast("double")).alias("share_positive"),
                     per_post(F.col("n_neg").cast("double")).alias("share_negative"))


def label_check(confusion):
    """Whether the labels support a comparison (two classes or more) and what was predicted for them."""
    total = F.sum("count")
    return confusion.agg(
        F.count_distinct("orig").alias("label_classes"),
        F.coalesce(total, F.lit(0)).alias("n_labelled"),
        (F.count_distinct("orig") >= 2).alias("comparable"),
        *[(100 * F.try_divide(F.sum(F.when(F.col("sentiment") == c, F.col("count")).otherwise(F.lit(0))), total))
          .alias(f"predicted_{c}_pct") for c in CLASSES])


def daily_classes(scored):
    """Posts and summed ten-thousandths of score per source, day, class and score bin: four tables are roll-ups of it."""
    number = F.floor(F.round((F.col("compound") + 1) * 10, 9))
    points = F.sum(F.round(F.col("compound") * 10000).cast("long"))
    return scored.groupBy("source", "day", "month", "sentiment", number.alias("number")).agg(_rows(), points.alias("points"))


def rolled_up(classes):
    """The tables that follow from ``daily_classes``."""
    def n_of(value):
        return F.coalesce(F.sum(F.when(F.col("sentiment") == value, F.col("n"))), F.lit(0))

    n = F.sum("n")
    return {
        "sentiment_by_source": classes.groupBy("source", "sentiment").agg(n.alias("count")),
        "daily_sentiment": classes.groupBy("day", "source").agg(
            n.alias("n"), (F.round(F.sum("points") / n) / 10000).alias("avg_compound"),
            n_of("positive").alias("n_pos"), n_of("negative").alias("n_neg")),
        "monthly_totals": classes.groupBy("month", "source").agg(n.alias("n")),
        "compound_hist": classes.groupBy("source", "number").agg(n.alias("count")).select(
            "source", F.round(F.col("number") / 10 - 1, 1).alias("bin"), "count"),
    }


def result_tables(scored, min_keyword_count=MIN_KEYWORD_COUNT, min_hashtag_count=MIN_HASHTAG_COUNT):
    """All result tables by name, unordered. ``scored`` is read six times; give a settled table."""
    return {
        **rolled_up(settle(daily_classes(scored), "daily_classes")),
        "community_sentiment": community_sentiment(scored, ordered=False),
        "keyword_monthly": keyword_monthly(scored, min_keyword_count),
        "hashtag_monthly": hashtag_monthly(scored, min_hashtag_count),
        "validation_confusion": validation_confusion(scored),
        "validation_corr": validation_corr(scored),
    }


def in_order(name, table):
    """A result table in the order it is published in."""
    return {"daily_sentiment": lambda t: t.orderBy("source", "day"), "compound_hist": lambda t: t.orderBy("source", "bin"),
            "community_sentiment": lambda t: t.orderBy(F.desc("n"), "community"),
            "trend_terms": lambda t: t.orderBy(F.desc("burst_z"), "source", "token")}.get(name, lambda t: t)(table)
