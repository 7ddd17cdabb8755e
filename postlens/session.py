"""Session settings the results depend on."""
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings: safe to apply to a session somebody else created.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark):
    """Apply the result-relevant settings to an existing session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def get_session(app_name="postlens", **conf):
    """A session with the library settings; master, memory and shuffle width stay the user's choice.

    Keyword names use ``__`` for dots: ``get_session("job", spark__driver__memory="8g")``.
    """
    builder = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return configure(builder.getOrCreate())


@contextmanager
def settings(spark, values):
    """Runtime settings for the time of one write or the start of a query."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def wide_shuffles(spark, splits):
    """Shuffles at least twice as wide as the data has read splits, for a time: with the session's width alone tasks grow with
    the data."""
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * splits)
    return settings(spark, {"spark.sql.shuffle.partitions": str(width)})
