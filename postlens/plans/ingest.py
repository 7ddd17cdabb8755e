"""Bulk load in cumulative slices, and replay of posts as messages."""
import time
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Observation, functions as F

from postlens.constants import LOAD_SLICES
from postlens.operators.sampling import first_rows, key_slice
from postlens.scratch import forget, settle
from postlens.sources.messages import post_messages, send
from postlens.sources.store import append_metrics, read_posts, write_posts


def bulk_load(posts, path, slices=LOAD_SLICES, metrics=None):
    """Reload a store slice by slice; the time after each slice is the load time of that fraction.

    The raw feeds are read and parsed once; that time is shared out by rows. The first slice replaces the store. Rows are
    counted while they are written. A post without a key is in no slice. Returns one metrics row per slice.
    """
    spark, rows, total, total_seconds = posts.sparkSession, [], 0, 0.0
    started, parsed = time.time(), Observation("parsed")
    keyed = settle(posts.observe(parsed, F.count(F.lit(1)).alias("n")), "posts")
    parse_seconds, n_parsed = time.time() - started, max(parsed.get["n"], 1)
    for k, (low, high) in enumerate(slices):
        started, written = time.time(), Observation(f"slice-{k}")
        part = key_slice(keyed, low, high).observe(written, F.count(F.lit(1)).alias("n"))
        write_posts(part, path, mode="append" if rows else "overwrite")
        n = written.get["n"]
        seconds = time.time() - started + parse_seconds * n / n_parsed
        total, total_seconds = total + n, total_seconds + seconds
        rows.append(_slice_row(high, n, seconds, total, total_seconds))
    forget(keyed)
    if metrics:
        append_metrics(spark, rows, metrics)
    return rows


def _slice_row(high, n, seconds, total, total_seconds):
    return dict(dataset_fraction=float(high), slice_rows=n, slice_seconds=round(seconds, 2),
                slice_rows_per_sec=round(n / max(seconds, 1e-3), 1), cumulative_rows=total,
                cumulative_seconds=round(total_seconds, 2),
                cumulative_rows_per_sec=round(total / max(total_seconds, 1e-3), 1))


def resumable_load(posts, root, slices=LOAD_SLICES, before_slice=None):
    """A bulk load that can break off and be run again: what is done stays, what was begun is replaced, no row is there twice.

    Each slice has its own folder in ``root/posts``, written whole before its row in ``root/manifest`` says so; a slice with such a row
    of the same bounds is not loaded again. ``loaded_posts`` reads the finished slices only. Returns the manifest rows,
    the metrics of the slices, in order.
    """
    spark, total, total_seconds, rows = posts.sparkSession, 0, 0.0, []
    for k, (low, high) in enumerate(slices):
        done = _manifest(spark, root, k)
        if done is None or (done["low"], done["high"]) != (low, high):
            if before_slice:
                before_slice(k)
            started, written = time.time(), Observation(f"slice-{k}")
            part = key_slice(posts, low, high).observe(written, F.count(F.lit(1)).alias("n"))
            write_posts(part, f"{root}/posts/slice={k}", mode="overwrite")
            row = (k, float(low), float(high), written.get["n"], time.time() - started)
            spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/part={k}")
            done = _manifest(spark, root, k)
        total, total_seconds = total + done["rows"], total_seconds + done["seconds"]
        rows.append(_slice_row(high, done["rows"], done["seconds"], total, total_seconds))
    return rows


MANIFEST_SCHEMA = "slice int, low double, high double, rows long, seconds double"


def _manifest(spark, root, k):
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/manifest/part={k}").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def loaded_posts(spark, root):
    """Posts of the finished slices of a resumable load."""
    slices = [r["slice"] for r in spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/manifest").select("slice").collect()]
    parts = [read_posts(spark, 2.0, f"{root}/posts/slice={k}") for k in sorted(slices)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def replay(posts, n, format="kafka", path=None, **options):
    """Send ``n`` posts as messages, sources mixed by sample key, posts without id included. Returns a metrics row.

    The posts are settled once with a line number, which makes the order total also where posts repeat.
    """
    started, sent = time.time(), Observation("sent")
    lines = settle(posts.where(F.col("sample_key").isNotNull()).withColumn("line", F.monotonically_increasing_id()), "lines")
    chosen = first_rows(lines, n, ["sample_key", "line"]).drop("line").observe(sent, F.count(F.lit(1)).alias("n"))
    send(post_messages(chosen), format, path, **options)
    seconds, count = time.time() - started, sent.get["n"]
    forget(lines)
    return dict(mode="produce", records=count, seconds=round(seconds, 2), records_per_sec=round(count / seconds, 1))
