"""Structured Streaming jobs.

Every sink writes one folder per micro-batch, ``batch_id=N``, in overwrite mode: a batch that is run again
after a failure replaces its own output. A stream resumes from its checkpoint; a fresh checkpoint replays
from the earliest message.
"""
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Observation, functions as F

from postlens.functions.keys import duplicate_key
from postlens.functions.text import plain
from postlens.operators.cleaning import ANALYSED, KEY, clean, deduplicate
from postlens.operators.sentiment import RuleWords, score
from postlens.scratch import forget, settle
from postlens.session import wide_shuffles
from postlens.streaming.gate import checked, stored_form
from postlens.streaming.keyindex import BATCH, KeyIndex
from postlens.streaming.progress import ProgressLog


def drain(stream, on_batch, checkpoint, output_mode="append"):
    """Run ``on_batch(df, batch_id)`` over everything available, then stop."""
    query = (stream.writeStream.outputMode(output_mode).foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def write_batch(df, path, batch_id):
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark, path, schema):
    """All batches a sink has written, empty before the first one."""
    try:
        table = spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return table.select(schema.names)


def ingest_messages(messages, root, checkpoint, metrics=True):
    """Message stream to post store ``root/posts``; unusable messages go to ``root/quarantine`` with the reason.

    Each batch writes its row of ``root/accounts``: messages received, stored and set aside, and scores that were no
    number. Received is stored plus set aside, also when a batch is repeated. With ``metrics`` Spark's own report of each batch
    (input rows, seconds, rows a second, ...) goes to ``root/progress``; ``ingest_metrics`` puts both together.
    """
    def on_batch(batch, batch_id):
        rows = checked(batch).persist(StorageLevel.MEMORY_AND_DISK)    # one micro-batch, read by two sinks
        try:
            stored, aside = Observation(f"stored-{batch_id}"), Observation(f"aside-{batch_id}")
            good = rows.where(F.col("reason").isNull()).observe(
                stored, F.count(F.lit(1)).alias("n"), F.count_if("bad_score").alias("bad"))
            write_batch(stored_form(good), f"{root}/posts", batch_id)
            rest = rows.where(F.col("reason").isNotNull()).select("value", "reason").observe(aside, F.count(F.lit(1)).alias("n"))
            write_batch(rest, f"{root}/quarantine", batch_id)
            row = (stored.get["n"] + aside.get["n"], stored.get["n"], aside.get["n"], stored.get["bad"])
            write_batch(batch.sparkSession.createDataFrame([row], ACCOUNT_SCHEMA).coalesce(1), f"{root}/accounts", batch_id)
        finally:
            rows.unpersist()

    if not metrics:
        return drain(messages, on_batch, checkpoint)
    with ProgressLog(messages.sparkSession) as log:
        query = drain(messages, on_batch, checkpoint)
        log.finished(query)
        write_progress(log, query, f"{root}/progress")
    return query


ACCOUNT_SCHEMA = "received long, records long, skipped long, bad_scores long"


def write_progress(log, query, path):
    """The reports of a query that has ended, a folder per batch: a repeated batch replaces its own."""
    (log.table(query).withColumn(BATCH, F.col("batch")).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH).parquet(path))


def ingest_metrics(spark, root):
    """One row per batch: messages received, stored (``records``) and set aside, input rows as Spark counts them, seconds and
    records a second."""
    accounts, progress = (spark.read.option("basePath", f"{root}/{name}").parquet(f"{root}/{name}") for name in ("accounts", "progress"))
    joined = accounts.join(progress.select(BATCH, "input_rows", "seconds"), BATCH, "left")
    return joined.select(F.lit("stream_ingest").alias("mode"), BATCH, "received", "records", "skipped", "bad_scores", "input_rows", "seconds",
                         F.round(F.try_divide("records", "seconds"), 1).alias("records_per_sec"))


# The plain text follows from the visible one: found again where posts are written, it is neither shuffled nor kept in between.
CARRIED = [c for c in ANALYSED if c != "text_clean"]


def score_stream(posts, lexicon, path, checkpoint, rules=True, rule_words=RuleWords(), text_limit=None):
    """Clean, de-duplicate over the whole stream, score and store a stream of posts in ``path/scores``.

    A post is scored once, in the batch that first brings its text, so many batches give the scores of one.
    """
    known = settle(lexicon, "lexicon")

    def on_fresh(fresh, batch_id):
        write_batch(score(fresh, known, rules=rules, rule_words=rule_words), f"{path}/scores", batch_id)

    return dedupe_stream(posts, path, checkpoint, on_fresh, text_limit)


def dedupe_stream(posts, path, checkpoint, on_fresh=None, text_limit=None):
    """Exact de-duplication over the whole history of a stream.

    Copies inside a batch are merged before the shuffle, so a text that floods the stream costs one row per
    task; of a text the earliest post of the first batch that brings it stays, and nothing expires. The keys of all texts so far are in
    a ``KeyIndex``, so a batch reads its own rows and keys and not the history. Posts go to ``path/posts``, their 32-byte keys to
    ``path/index/keys``; ``on_fresh(df, batch_id)`` is called with the stored posts. A stream that may forget old
    texts is cheaper with ``drop_repeats``.
    """
    def on_batch(batch, batch_id):
        with wide_shuffles(batch.sparkSession, batch.rdd.getNumPartitions()):
            rows = settle(deduplicate(clean(batch, text_limit), CARRIED), "batch")
            fresh = rows.join(index.new(rows, batch_id), KEY, "left_semi").withColumn("text_clean", plain(F.col("text_v"))).select(KEY, *ANALYSED)
            write_batch(fresh, f"{path}/posts", batch_id)
        if on_fresh:
            on_fresh(batch.sparkSession.read.schema(fresh.schema).parquet(f"{path}/posts/{BATCH}={batch_id}"), batch_id)
        forget(rows)

    with KeyIndex(posts.sparkSession, f"{path}/index", f"{checkpoint}/index", KEY) as index:
        return drain(posts, on_batch, f"{checkpoint}/posts")


def drop_repeats(posts, delay, text_limit=None):
    """Streaming duplicate removal with bounded state: copies later than ``delay`` after the first come through.

    The state holds one digest per text seen within ``delay``. Every copy travels to the task of its text; where one text
    floods the stream ``dedupe_stream``, which merges copies first, is the better form.
    """
    keyed = clean(posts, text_limit).withColumn(KEY, duplicate_key("source", "text_clean"))    # state holds digests, not texts
    return keyed.withWatermark("created_ts", delay).dropDuplicatesWithinWatermark([KEY])


def window_counts(posts, keys, width="1 day", delay="1 day", time_column="created_ts"):
    """Tumbling-window counts of a stream; rows later than ``delay`` are ignored."""
    return (posts.withWatermark(time_column, delay)
            .groupBy(F.window(time_column, width).alias("window"), *keys)
            .agg(F.count("*").alias("n"))
            .select(F.col("window.start").alias("window_start"), *keys, "n"))


def count_windows(posts, path, checkpoint, keys, width="1 day", delay="1 day", time_column="created_ts"):
    """Tumbling-window counts with an account of every row: counted, late or without a time.

    A row is late if its window had ended ``delay`` before the latest time of the batches before its own, the rule of Spark's
    watermarks; late rows are kept in ``path/late``. The others are counted per batch in ``path/partials``, which ``window_totals`` adds
    up, so no state is held and a repeated batch replaces its own rows. ``path/clock`` has the latest time so far, a row per
    batch, and ``path/accounts`` what became of a batch's rows.
    """
    spark = posts.sparkSession

    def on_batch(batch, batch_id):
        time = F.col(time_column).cast("timestamp")
        before = spark.read.parquet(f"{path}/clock/{BATCH}={batch_id - 1}").first()["latest"] if batch_id else None
        mark = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        # A window expression drops rows without a time, so these take a way of their own.
        timely = batch.where(time.isNotNull()).withColumn("_window", F.window(time, width)).withColumn("window_start", F.col("_window.start"))
        timely = timely.withColumn("outcome", F.when(F.col("_window.end") <= mark, "late").otherwise("counted")).drop("_window")
        timeless = batch.where(time.isNull()).withColumn("window_start", F.lit(None).cast("timestamp")).withColumn("outcome", F.lit("timeless"))
        rows = settle(timely.unionByName(timeless), "batch")
        write_batch(rows.where("outcome = 'late'").drop("outcome", "window_start"), f"{path}/late", batch_id)
        write_batch(rows.where("outcome = 'counted'").groupBy("window_start", *keys).agg(F.count("*").alias("n")), f"{path}/partials", batch_id)
        write_batch(rows.groupBy("outcome").agg(F.count("*").alias("rows")), f"{path}/accounts", batch_id)
        write_batch(rows.agg(F.greatest(F.max(time), F.lit(before).cast("timestamp")).alias("latest")), f"{path}/clock", batch_id)
        forget(rows)

    return drain(posts, on_batch, checkpoint)


def window_totals(spark, path, keys):
    """Current counts of all windows."""
    return spark.read.parquet(f"{path}/partials").groupBy("window_start", *keys).agg(F.sum("n").alias("n"))


def store_windows(counts, path, checkpoint):
    """Store updated windows of each batch; ``latest`` gives the current value of every window."""
    return drain(counts, lambda batch, batch_id: write_batch(batch, path, batch_id), checkpoint, "update")


def latest(changes, keys):
    """Current row per key of a change table: the one of the highest batch."""
    values = [c for c in changes.columns if c not in (*keys, BATCH)]
    return (changes.groupBy(*keys).agg(F.max_by(F.struct(*values), BATCH).alias("row"))
            .select(*keys, "row.*"))


def monthly_roll_up(daily, keys):
    """Calendar months from daily counts; streams have no calendar-month window."""
    month = F.trunc(F.to_date("window_start"), "month").alias("month")
    return daily.groupBy(month, *keys).agg(F.sum("n").alias("n"))
