"""Cleaning and exact duplicate removal."""
from pyspark.sql import functions as F

from postlens.functions.keys import duplicate_key
from postlens.functions.text import is_blank, is_long_enough, plain, visible

KEY = "dup_key"

# What scoring and the result tables need of a cleaned post.
ANALYSED = ["post_id", "source", "created_ts", "community", "orig_sentiment", "orig_score", "text_v", "text_clean"]


def clean(posts, text_limit=None):
    """Add ``text_v`` and ``text_clean``; drop removed, blank and too short posts.

    Whole texts are read unless ``text_limit`` names a number of characters.

    Both texts and both tests are one generator. As a filter over computed columns the optimiser would push
    the test below them and run every regular expression again for it.
    """
    seen = F.filter(F.transform(F.array("text"), lambda text: visible(text, text_limit)), lambda text_v: ~is_blank(text_v))
    both = F.transform(seen, lambda text_v: F.struct(text_v.alias("text_v"), plain(text_v).alias("text_clean")))
    kept = F.filter(both, lambda pair: is_long_enough(pair["text_clean"]))
    return posts.select("*", F.inline_outer(kept)).where(F.col("text_clean").isNotNull())


def deduplicate(cleaned, columns=None):
    """One post per (source, text_clean): the earliest, then the smallest ``post_id`` (no id comes last).

    A minimum over the whole row, so copies are merged before the shuffle and a text that makes up a
    third of all posts arrives as one row per task. The result is partitioned by ``dup_key``, which
    identifies a post from here on; scoring by that key needs no further shuffle.

    ``columns`` names what to keep (default: all). The optimiser cannot prune the minimum, and the raw text is
    by far the widest column, so an analysis that works on ``text_v`` should not shuffle ``text``.
    """
    columns = columns or cleaned.columns
    first = ["created_ts", "post_id"]
    rest = [c for c in columns if c not in first]
    order = [F.col("created_ts"), F.col("post_id").isNull().alias("nameless"), F.col("post_id")]
    return (cleaned.groupBy(duplicate_key("source", "text_clean").alias(KEY))
            .agg(F.min(F.struct(*order, *rest)).alias("post"))
            .select(KEY, *[F.col(f"post.{c}").alias(c) for c in columns]))


def removed_share(posts, text_limit=None):
    """Rows in, rows kept by cleaning, rows kept after de-duplication and the removed share, in one pass."""
    text_v = visible(F.col("text"), text_limit)
    rows = posts.select("source", text_v.alias("text_v")).withColumn("text_clean", plain(F.col("text_v")))
    kept = ~is_blank(F.col("text_v")) & is_long_enough(F.col("text_clean"))
    per_text = (rows.groupBy(F.when(kept, duplicate_key("source", "text_clean")).alias(KEY))
                .agg(F.count("*").alias("n")))
    counts = per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum(F.when(F.col(KEY).isNotNull(), F.col("n"))), F.lit(0)).alias("rows_clean"),
        F.count(KEY).alias("rows_distinct"))
    return counts.withColumn("removed_share",
                             F.lit(1.0) - F.try_divide(F.col("rows_distinct"), F.col("rows_in")))
