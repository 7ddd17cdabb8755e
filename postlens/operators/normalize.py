"""Raw feed to unified posts. The same functions serve batch and streaming DataFrames."""
from pyspark.sql import functions as F

from postlens.constants import (COMMUNITY_COLUMNS, COMMUNITY_PREFIX, ID_COLUMNS, LABEL_COLUMNS, SCORE_COLUMNS,
                                TEXT_COLUMNS, TIME_COLUMNS)
from postlens.functions.keys import content_id, sample_key
from postlens.functions.times import event_time, month_of
from postlens.schema import POSTS_SCHEMA, find_column


PARSED_TIME = "_event_time"


def usable(df):
    """Posts with text and time."""
    return df.where((F.length("text") > 0) & F.col("created_ts").isNotNull())


def with_default(df, name, value):
    """Add a constant column where the feed has none; a present column stays as it is, nulls included."""
    return df if find_column(df.columns, [name.lower()]) else df.withColumn(name, F.lit(value))


def with_sample_key(posts):
    """Stored sample key. Posts without an id are keyed by content, so every post has a key."""
    identity = F.coalesce("post_id", content_id("source", "text", "created_ts"))
    return posts.withColumn("sample_key", sample_key(identity))


def normalize(df, source, labels=False, community=False):
    """Project a raw feed onto the unified post fields (all but ``sample_key``).

    ``labels`` and ``community`` say which optional fields this feed provides.
    """
    def column(candidates, wanted=True):
        name = find_column(df.columns, candidates) if wanted else None
        return None if name is None else F.col(f"`{name}`")

    def field(expression, dtype):
        return F.lit(None).cast(dtype) if expression is None else expression

    text, time_name = column(TEXT_COLUMNS), find_column(df.columns, TIME_COLUMNS)
    if text is None or time_name is None:
        raise ValueError(f"feed {source!r} has no text or no time column among {df.columns}")
    post_id, label = column(ID_COLUMNS), column(LABEL_COLUMNS, labels)
    score, place = column(SCORE_COLUMNS, labels), column(COMMUNITY_COLUMNS, community)
    feed, text = F.lit(source), text.cast("string")
    # As generated column the parsed time is tested where it is; as a computed one it would be parsed again for
    # the filter, which the optimiser moves below it. Filters on the text still reach the scan.
    df = df.select("*", F.explode_outer(F.array(event_time(df, time_name))).alias(PARSED_TIME))
    created = F.col(PARSED_TIME)
    local_id = content_id(feed, text, created) if post_id is None else post_id.cast("string")
    return usable(df.select(
        F.concat(F.lit(f"{source}-"), local_id).alias("post_id"),
        feed.alias("source"),
        text.alias("text"),
        created.alias("created_ts"),
        field(None if place is None else F.regexp_replace(place.cast("string"), COMMUNITY_PREFIX, ""),
              "string").alias("community"),
        field(None if label is None else F.lower(label.cast("string")), "string").alias("orig_sentiment"),
        field(None if score is None else
              (score.try_cast("double") if dict(df.dtypes)[find_column(df.columns, SCORE_COLUMNS)] == "string"
               else score.cast("double")), "double").alias("orig_score"),
    ))


def unite(normalized):
    """Union of normalised feeds by column name, with sample keys, in schema order."""
    first, *rest = normalized
    for other in rest:
        first = first.unionByName(other)
    return with_sample_key(first).select(POSTS_SCHEMA.names)


def with_calendar(posts):
    """Day and month of each post."""
    return posts.withColumns({"day": F.to_date("created_ts"), "month": month_of(F.col("created_ts"))})


def language_only(df, language="en", column="language"):
    """Rows in one language; rows without a language are dropped."""
    return df.where(F.col(column) == language)


def storable(df):
    """Form for untyped sinks: dates as timestamps, NaN as null."""
    def convert(name, dtype):
        column = F.col(f"`{name}`")
        if dtype == "date":
            return column.cast("timestamp").alias(name)
        if dtype in ("double", "float"):
            return F.when(~F.isnan(column), column).alias(name)
        return column
    return df.select([convert(name, dtype) for name, dtype in df.dtypes])
