"""The unified post schema and the lookup of raw column names."""
from pyspark.sql import types as T

# Names, order and types of the stored posts.
POSTS_SCHEMA = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("created_ts", T.TimestampType()),
    T.StructField("community", T.StringType()),
    T.StructField("orig_sentiment", T.StringType()),
    T.StructField("orig_score", T.DoubleType()),
    T.StructField("sample_key", T.DoubleType()),
])

# A message carries the same fields as text: times and scores are parsed on arrival, where the key is added too.
MESSAGE_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in POSTS_SCHEMA if f.name != "sample_key"])


def find_column(columns, candidates):
    """The column named by the earliest candidate, ignoring case; None when no candidate is there."""
    present = {name.lower(): name for name in columns}
    return next((present[c] for c in candidates if c in present), None)
