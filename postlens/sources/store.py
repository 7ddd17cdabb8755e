"""Post store and result tables: any Spark format and its options, Parquet by default."""
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from postlens.constants import ROWS_PER_FILE
from postlens.operators.normalize import storable
from postlens.operators.sampling import fraction_of
from postlens.schema import POSTS_SCHEMA
from postlens.scratch import settle
from postlens.session import settings
from postlens.sources.layout import z_ordered


def write_posts(posts, path=None, mode="append", format="parquet", by="sample_key", **options):
    """Write posts; ``mode="overwrite"`` starts the store anew.

    File stores are laid out for the access paths: one folder per source (partition pruning), and rows in each file
    sorted by ``by``: ``sample_key`` (page skipping for fraction reads) or ``created_ts`` (for reads of a source over a span of
    time), without a shuffle, however large one source is; or ``both``, along a curve that serves the two of them for one
    shuffle by range. Times are stored as 64-bit numbers, which have the statistics that skipping needs. Row stores
    keep their own indexes.
    """
    if path is None:
        posts.write.format(format).mode(mode).options(**options).save()
        return
    ordered = z_ordered(posts) if by == "both" else posts.sortWithinPartitions("source", by)
    with settings(posts.sparkSession, {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}):
        (ordered.write.format(format).mode(mode).option("partitionOverwriteMode", "static").options(**options)
         .partitionBy("source").save(path))


def read_posts(spark, fraction=1.0, path=None, format="parquet", source=None, since=None, until=None, **options):
    """Posts of the store whose sample key is below ``fraction``, read with the fixed schema; where asked for, of one source
    and from ``since`` to before ``until``."""
    reader = spark.read.schema(POSTS_SCHEMA).format(format).options(**options)
    posts = fraction_of((reader.load(path) if path else reader.load()).select(POSTS_SCHEMA.names), fraction)
    for wanted in (None if source is None else F.col("source") == source, None if since is None else F.col("created_ts") >= since,
                   None if until is None else F.col("created_ts") < until):
        posts = posts if wanted is None else posts.where(wanted)
    return posts


def count_stored(posts, fraction=None):
    """Number of stored posts, or of those below a sample fraction."""
    return (posts if fraction is None else fraction_of(posts, fraction)).count()


def count_by_source(posts, fraction=1.0):
    """Posts per source below a sample fraction."""
    return fraction_of(posts, fraction).groupBy("source").agg(F.count("*").alias("posts"))


def scan_inferred(spark, path=None, format="parquet", **options):
    """A stored table with the schema the format infers."""
    reader = spark.read.format(format).options(**options)
    return reader.load(path) if path else reader.load()


def replace_tables(tables, root, format="parquet", untyped=False, order=lambda name, df: df, **options):
    """Replace each result table under ``root``; an empty result leaves the old content. Returns the names written."""
    written = []
    for name, df in tables.items():
        df = df if hasattr(df, "settled_in") else settle(df, name)     # looked at and written: computed once
        if df.isEmpty():
            continue
        out = order(name, storable(df) if untyped else df)
        out.write.format(format).mode("overwrite").options(**options).save(f"{root}/{name}")
        written.append(name)
    return written


def read_csv_result(spark, path, schema):
    """Result file in which only the empty field is missing: the words ``null`` and ``nan`` are words."""
    return spark.read.schema(schema).csv(path, header=True, nullValue="", nanValue="")


MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_with_fallback(spark, schema, primary=None, fallback=None, unreachable=()):
    """First present, non-empty table and where it came from.

    ``primary`` and ``fallback`` are functions of the session that return a DataFrame. Only a table that is not there counts
    as missing, and errors of the types in ``unreachable`` (a store that cannot be connected to); any other error is raised.
    """
    for read, origin, may_be_empty in ((primary, "store", False), (fallback, "file", True)):
        if read is None:
            continue
        try:
            df = read(spark)
            if may_be_empty or not df.isEmpty():
                return df, origin
        except unreachable:
            continue
        except AnalysisException as error:
            if (error.getCondition() or "").split(".")[0] not in MISSING:
                raise
    return spark.createDataFrame([], schema), "missing"


def write_chunks(df, path, rows_per_file=ROWS_PER_FILE):
    """Replace a chunk folder by Parquet files of at most ``rows_per_file`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def append_metrics(spark, rows, path):
    """Append run-metric rows (plain dicts) to a metrics table."""
    spark.createDataFrame(rows).coalesce(1).write.mode("append").parquet(path)
