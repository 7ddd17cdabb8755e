"""JSON messages: unified posts, and raw rows as text."""
from pyspark.sql import functions as F, types as T

# The fraction of a second is written only where there is one; the zone is always a number.
WHOLE_SECOND, PART_OF_SECOND = "yyyy-MM-dd HH:mm:ssxxx", "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"


def message_time(column):
    return F.when(F.date_trunc("second", column) == column, F.date_format(column, WHOLE_SECOND)).otherwise(
        F.date_format(column, PART_OF_SECOND))


def post_messages(posts):
    """One JSON message per post in column ``value``. Missing values keep their key, times are text."""
    fields = [F.when(~F.isnan("orig_score"), F.col("orig_score")).alias("orig_score") if c == "orig_score"
              else message_time(F.col(c)).alias(c) if c == "created_ts" else F.col(c)
              for c in posts.columns if c != "sample_key"]
    return posts.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def _as_text(column, dtype):
    """A value as text: ISO times without needless fractions, capitalised truth values, NaN as missing."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole, fine = "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        return F.when(F.date_trunc("second", column) == column, F.date_format(column, whole)).otherwise(
            F.date_format(column, fine))
    if isinstance(dtype, T.BooleanType):
        return F.initcap(column.cast("string"))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(column), column.cast("string"))
    return column.cast("string")


def stringify(df):
    """Every scalar as text, every array as an array of texts."""
    def convert(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ArrayType):
            item = field.dataType.elementType
            return F.transform(column, lambda x: _as_text(x, item)).alias(field.name)
        return _as_text(column, field.dataType).alias(field.name)
    return df.select([convert(f) for f in df.schema.fields])


def raw_messages(df):
    """One all-text JSON message per raw row."""
    return stringify(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def send(messages, format="kafka", path=None, **options):
    """Write messages to a topic (``topic``, ``kafka.bootstrap.servers`` as options) or to text files."""
    writer = messages.write.format(format).options(**options).mode("append")
    writer.save(path) if path else writer.save()


def message_stream(spark, format="kafka", path=None, **options):
    """Streaming DataFrame with one message per row in ``value``; from the earliest one unless options say otherwise."""
    if format == "kafka":
        options = {"startingOffsets": "earliest", **options}
    reader = spark.readStream.format(format).options(**options)
    stream = reader.load(path) if path else reader.load()
    return stream.select(F.col("value").cast("string").alias("value"))
