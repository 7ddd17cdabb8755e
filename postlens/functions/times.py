"""Event-time parsing."""
from pyspark.sql import functions as F, types as T

from postlens.constants import EPOCH_UNITS, FEED_TIME_FORMAT, WEEKDAY_PREFIX


def from_epoch(number):
    """Epoch number in s, ms, us or ns to timestamp; the unit follows from the magnitude."""
    value = number.cast("double")
    finer = [F.when(value > limit, value / per_second) for limit, per_second in EPOCH_UNITS]
    return F.timestamp_seconds(F.coalesce(*finer, value))


def from_text(text):
    """ISO text, then the weekday-first feed format, then epoch seconds; anything else is null."""
    return F.coalesce(
        F.try_to_timestamp(text),
        F.try_to_timestamp(F.regexp_replace(text, WEEKDAY_PREFIX, ""), F.lit(FEED_TIME_FORMAT)),
        F.timestamp_seconds(text.try_cast("double")),
    )


def event_time(df, name):
    """Timestamp column for ``df[name]``, whatever type the feed stores it in."""
    dtype, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp")
    if isinstance(dtype, T.NumericType):
        return from_epoch(column)
    return from_text(column.cast("string"))


def month_of(ts):
    """First day of the calendar month, as a date."""
    return F.trunc(F.to_date(ts), "month")
