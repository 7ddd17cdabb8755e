import datetime as dt
import json
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import functions as F, types as T

from postlens.operators.cleaning import clean, deduplicate
from postlens.plans.ingest import replay
from postlens.schema import POSTS_SCHEMA
from postlens.session import settings
from postlens.sources.messages import message_stream, post_messages, raw_messages, stringify
from postlens.streaming import flows, gate
from postlens.streaming.keyindex import KeyIndex, seen_keys
from postlens.streaming.progress import ProgressLog

NOON = dt.datetime(2021, 1, 1, 12)


def post(i, text=None, source="a", ts=NOON):
    return (f"{source}-{i}", source, text or f"text number {'abcdefghij'[i % 10] * (1 + i // 10)}", ts, None, None, float("nan"), 0.5)


def posts(spark, rows):
    return spark.createDataFrame(rows, POSTS_SCHEMA)


def message(**fields):
    base = {"post_id": "a-1", "source": "a", "text": "hello", "created_ts": "2021-01-01 00:00:00+00:00"}
    return json.dumps({**base, **fields})


def test_gate(spark):
    whole = json.loads(message())
    texts = [message(), message(text=None), message(extra=1), json.dumps({k: whole[k] for k in ("post_id", "source", "text")}),
             message()[:20], "[1, 2]", "3", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = [r.accepted for r in gate.gated(df).orderBy("i").collect()]
    assert got == [True, True, True] + [False] * 6


def test_accepted_messages_become_posts(spark):
    df = spark.createDataFrame([(message(),), (message(post_id="a-2", text=None),), (message(post_id="a-3", created_ts="junk"),),
                                (message(post_id="a-4", created_ts="1609459200", orig_score=0.5),)], "value string")
    rows = {r.post_id: r for r in gate.posts_of(df).collect()}
    assert set(rows) == {"a-1", "a-4"} and rows["a-4"].created_ts == dt.datetime(2021, 1, 1) and rows["a-4"].orig_score == 0.5


def test_messages_keep_null_keys(spark):
    value = json.loads(post_messages(posts(spark, [post(1)])).first().value)
    assert value["community"] is None and value["orig_score"] is None and "sample_key" not in value
    assert value["created_ts"].startswith("2021-01-01 12:00:00")


def test_raw_messages_are_text(spark):
    df = spark.createDataFrame([(1, 2.5, True, [1, 2], NOON, None), (2, float("nan"), False, None, NOON.replace(microsecond=5), "x")],
                               "i int, d double, b boolean, a array<int>, t timestamp, s string")
    first, second = [json.loads(r.value) for r in raw_messages(df).collect()]
    assert first == {"i": "1", "d": "2.5", "b": "True", "a": ["1", "2"], "t": "2021-01-01T12:00:00", "s": None}
    assert second == {"i": "2", "d": None, "b": "False", "a": None, "t": "2021-01-01T12:00:00.000005", "s": "x"}
    assert dict(stringify(df).dtypes)["a"] == "array<string>"


def test_replay_ingest_and_resume(spark, tmp_path):
    topic, root, checkpoint = (str(tmp_path / n) for n in ("topic", "root", "checkpoint"))
    from postlens.operators.normalize import with_sample_key
    source = with_sample_key(posts(spark, [post(i) for i in range(40)]).drop("sample_key")).select(POSTS_SCHEMA.names)
    assert replay(source, 25, "text", topic)["records"] == 25
    spark.createDataFrame([("{broken",), ('{"post_id": 1}',)], "value string").write.mode("append").text(topic)
    flows.ingest_messages(message_stream(spark, "text", topic), root, checkpoint)
    stored = lambda: flows.read_batches(spark, f"{root}/posts", POSTS_SCHEMA)
    assert stored().count() == 25
    expected = {(r.post_id, r.sample_key) for r in source.orderBy("sample_key").limit(25).collect()}
    assert {(r.post_id, r.sample_key) for r in stored().collect()} == expected
    assert spark.read.parquet(f"{root}/quarantine").count() == 2
    flows.ingest_messages(message_stream(spark, "text", topic), root, checkpoint)       # nothing new
    assert stored().count() == 25
    replay(source.where("sample_key >= 0"), 40, "text", topic)
    flows.ingest_messages(message_stream(spark, "text", topic), root, checkpoint)       # only the new messages
    assert stored().count() == 65
    metrics = flows.ingest_metrics(spark, root)
    assert metrics.agg(F.sum("received"), F.sum("records"), F.sum("skipped")).first() == (67, 65, 2)
    assert all(r.input_rows == r.received == r.records + r.skipped and r.seconds > 0 for r in metrics.collect())


def test_every_message_is_stored_or_set_aside(spark):
    values = [message(), message(text=""), message(text=None), message(created_ts="junk"), "{broken", message(orig_score="0.5"),
              message(orig_score="much"), message(orig_score=2)]
    rows = gate.checked(spark.createDataFrame([(v,) for v in values], "value string")).collect()
    assert [r.reason for r in rows] == [None, "text", "text", "time", "keys", None, None, None]
    assert [(r.orig_score, r.bad_score) for r in rows if r.reason is None] == [(None, False), (0.5, False), (None, True), (2.0, False)]


def test_message_times_keep_their_fraction(spark):
    times = [NOON, NOON.replace(microsecond=123456)]
    sent = [json.loads(r.value)["created_ts"] for r in post_messages(posts(spark, [post(i, ts=t) for i, t in enumerate(times)])).collect()]
    assert sent == ["2021-01-01 12:00:00+00:00", "2021-01-01 12:00:00.123456+00:00"]


def test_replay_sends_posts_without_id_and_repeated_ones(spark, tmp_path):
    rows = [post(1), post(1), (None, "a", "no name", NOON, None, None, None, 0.1), post(2)]
    assert replay(posts(spark, rows), 3, "text", str(tmp_path / "t"))["records"] == 3
    sent = [json.loads(r.value)["post_id"] for r in spark.read.text(str(tmp_path / "t")).collect()]
    assert len(sent) == 3 and None in sent


def test_scores_over_batches_equal_batch(spark, tmp_path):
    from postlens.operators.sentiment import default_lexicon, score
    batches = [[post(1, "good words here")], [post(2, "Good words, here!"), post(3, "bad words here")], [post(4, "bad words here")]]
    out = str(tmp_path / "out")
    flows.score_stream(stream_of(spark, batches, str(tmp_path / "in")), default_lexicon(spark), out, str(tmp_path / "checkpoint"))
    got = {(r.text_clean, r.compound) for r in spark.read.parquet(f"{out}/scores").collect()}
    want = score(deduplicate(clean(posts(spark, [r for b in batches for r in b]))), default_lexicon(spark)).collect()
    assert got == {(r.text_clean, r.compound) for r in want} and spark.read.parquet(f"{out}/scores").count() == 2


def test_keys_outlive_a_restart(spark, tmp_path):
    out, source, checkpoint = (str(tmp_path / n) for n in ("out", "in", "checkpoint"))
    flows.dedupe_stream(stream_of(spark, [[post(1, "one text")], [post(2, "two texts")]], source), out, checkpoint)
    posts(spark, [post(3, "one text"), post(4, "three texts")]).coalesce(1).write.parquet(f"{source}/part9")
    flows.dedupe_stream(spark.readStream.schema(POSTS_SCHEMA).parquet(f"{source}/part*"), out, checkpoint)
    assert sorted(r.text_clean for r in spark.read.parquet(f"{out}/posts").collect()) == ["one text", "three texts", "two texts"]
    assert sorted(r.batch_id for r in seen_keys(spark, f"{out}/index").collect()) == [0, 1, 2]
    assert seen_keys(spark, str(tmp_path / "none")).count() == 0


def test_a_repeated_batch_gets_the_same_answer(spark, tmp_path):
    keys = spark.createDataFrame([(bytes([i]) * 32,) for i in range(5)], "dup_key binary")
    path, checkpoint = str(tmp_path / "index"), str(tmp_path / "checkpoint")
    with KeyIndex(spark, path, checkpoint) as index:
        first = index.new(keys.limit(3), 0).count()
        assert first == 4 == index.new(keys.limit(3), 0).count()      # three keys and the batch's own mark
        assert index.new(keys.limit(0), 1).count() == 1
    with KeyIndex(spark, path, checkpoint) as index:                    # started anew: repeated, then the rest
        assert index.new(keys.limit(3), 0).count() == 4
        new = {bytes(r.dup_key) for r in index.new(keys, 2).collect()}
    assert new == {bytes([3]) * 32, bytes([4]) * 32, b"batch 2"}


def test_a_part_of_the_key_state_reserves_no_disk(spark, tmp_path):
    keys = spark.createDataFrame([(bytes([i]) * 32,) for i in range(50)], "dup_key binary")
    local = Path(SparkFiles.getRootDirectory()).parent
    before = set(local.rglob("MANIFEST-*"))
    with KeyIndex(spark, str(tmp_path / "index"), str(tmp_path / "checkpoint")) as index:
        assert index.new(keys, 0).count() == 51
        logs = [log.stat() for log in set(local.rglob("MANIFEST-*")) - before]
    assert len(logs) >= 4 and all(log.st_blocks * 512 < 1 << 20 for log in logs)    # four parts


def test_bytes_read_by_a_batch_do_not_grow_with_the_history(spark, tmp_path):
    """Twenty batches of 400 posts, a tenth of them copies of earlier ones: what each reads through the file system."""
    def text(n):
        return "text number " + str(n).translate({48 + d: "abcdefghij"[d] for d in range(10)})

    batches = [[post(1000 * b + i, text(1000 * b + i if i % 10 or not b else 1000 * (b - 1) + i + 1)) for i in range(400)] for b in range(20)]
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    read = []
    out, stream = str(tmp_path / "out"), stream_of(spark, batches, str(tmp_path / "in"))
    flows.dedupe_stream(stream, out, str(tmp_path / "checkpoint"), lambda fresh, n: read.append(statistics.getLong("bytesRead")))
    per_batch = [b - a for a, b in zip(read, read[1:], strict=False)]
    assert len(read) == 20 and sorted(per_batch[-5:])[2] < 1.2 * sorted(per_batch[:5])[2]
    want = deduplicate(clean(posts(spark, [r for b in batches for r in b])))
    got = spark.read.parquet(f"{out}/posts")
    assert sorted(r.text_clean for r in got.select("text_clean").collect()) == sorted(r.text_clean for r in want.select("text_clean").collect())


def stream_of(spark, batches, folder):
    """One file per batch, one batch per file."""
    for i, rows in enumerate(batches):
        posts(spark, rows).coalesce(1).write.parquet(f"{folder}/part{i}")
    return (spark.readStream.schema(POSTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part*"))


def test_dedupe_over_batches_equals_batch(spark, tmp_path):
    batches = [[post(i) for i in range(0, 20)] + [post(90, "flood of copies")] * 5,
               [post(i) for i in range(10, 30)] + [post(91, "Flood of COPIES!")] * 5, [post(92, "flood of copies")]]
    out = str(tmp_path / "out")
    flows.dedupe_stream(stream_of(spark, batches, str(tmp_path / "in")), out, str(tmp_path / "checkpoint"))
    got = spark.read.parquet(f"{out}/posts")
    everything = posts(spark, [r for b in batches for r in b])
    want = deduplicate(clean(everything))
    assert sorted(r.text_clean for r in got.collect()) == sorted(r.text_clean for r in want.collect())
    assert got.select("dup_key").distinct().count() == got.count()
    assert got.select(flows.BATCH).distinct().count() == 2       # the third batch brought nothing new


def test_a_narrow_session_does_not_merge_a_large_batch_in_one_task(spark, tmp_path):
    rows, source, out = posts(spark, [post(i) for i in range(200)]), str(tmp_path / "in"), tmp_path / "out"
    rows.repartition(6).write.parquet(source)
    narrow = {"spark.sql.shuffle.partitions": "1", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.files.maxPartitionBytes": "4k",
              "spark.sql.files.openCostInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    widths = []
    with settings(spark, narrow):
        flows.dedupe_stream(spark.readStream.schema(POSTS_SCHEMA).parquet(source), str(out), str(tmp_path / "checkpoint"),
                            lambda fresh, n: widths.append(fresh.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    assert widths == ["1"]                                              # for these writes only
    assert len({file.name.split("-")[1] for file in out.glob("posts/batch_id=0/*.parquet")}) >= 6
    want = deduplicate(clean(rows))
    got = spark.read.parquet(str(out / "posts"))
    assert sorted(r.text_clean for r in got.collect()) == sorted(r.text_clean for r in want.collect())


def test_rerun_of_a_batch_replaces_its_output(spark, tmp_path):
    out = str(tmp_path / "out")
    flows.write_batch(spark.range(5), out, 0)
    flows.write_batch(spark.range(3), out, 0)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField(flows.BATCH, T.LongType())])
    assert flows.read_batches(spark, out, schema).count() == 3
    assert flows.read_batches(spark, str(tmp_path / "none"), schema).count() == 0


def test_windows_are_updated_and_late_rows_are_ignored(spark, tmp_path):
    day = lambda d: dt.datetime(2021, 1, d, 12)
    batches = [[post(1, ts=day(1)), post(2, ts=day(2))], [post(3, ts=day(2)), post(4, ts=day(20))], [post(5, ts=day(20))],
               [post(6, ts=day(1)), post(7, ts=day(20))]]      # Spark drops late rows from the second batch after the jump on
    out = str(tmp_path / "out")
    counts = flows.window_counts(stream_of(spark, batches, str(tmp_path / "in")), ["source"], "1 day", "2 days")
    flows.store_windows(counts, out, str(tmp_path / "checkpoint"))
    schema = T.StructType([T.StructField("window_start", T.TimestampType()), T.StructField("source", T.StringType()),
                           T.StructField("n", T.LongType()), T.StructField(flows.BATCH, T.LongType())])
    now = flows.latest(flows.read_batches(spark, out, schema), ["window_start", "source"])
    assert {(r.window_start.day, r.n) for r in now.collect()} == {(1, 1), (2, 2), (20, 3)}
    months = flows.monthly_roll_up(now, ["source"]).collect()
    assert [(str(r.month), r.n) for r in months] == [("2021-01-01", 6)]


def test_stateful_form_drops_copies_across_batches(spark, tmp_path):
    batches = [[post(1, "same words here")], [post(2, "Same words, here!"), post(3, "other words here")]]
    out = str(tmp_path / "out")
    kept = flows.drop_repeats(stream_of(spark, batches, str(tmp_path / "in")), "30 days").select("source", "text_clean")
    flows.drain(kept, lambda b, n: flows.write_batch(b, out, n), str(tmp_path / "checkpoint"))
    assert {r.text_clean for r in spark.read.parquet(out).collect()} == {"same words here", "other words here"}


def test_every_row_of_a_window_stream_is_accounted_for(spark, tmp_path):
    day = lambda d: dt.datetime(2021, 1, d, 12)
    batches = [[post(1, ts=day(1)), post(2, ts=day(2)), post(9, ts=None)], [post(3, ts=day(2)), post(4, ts=day(20))], [post(5, ts=day(20))],
               [post(6, ts=day(1)), post(7, ts=day(20)), post(8, ts=day(18))]]
    out, source, checkpoint = (str(tmp_path / n) for n in ("out", "in", "checkpoint"))
    flows.count_windows(stream_of(spark, batches, source), out, checkpoint, ["source"], "1 day", "2 days")
    totals = {(r.window_start.day, r.n) for r in flows.window_totals(spark, out, ["source"]).collect()}
    assert totals == {(1, 1), (2, 2), (18, 1), (20, 3)}
    assert [r.post_id for r in spark.read.parquet(f"{out}/late").collect()] == ["a-6"]
    accounts = {(r.batch_id, r.outcome): r.rows for r in spark.read.parquet(f"{out}/accounts").collect()}
    assert accounts == {(0, "counted"): 2, (0, "timeless"): 1, (1, "counted"): 2, (2, "counted"): 1, (3, "late"): 1, (3, "counted"): 2}
    posts(spark, [post(10, ts=day(2))]).coalesce(1).write.parquet(f"{source}/part9")       # after a restart the clock goes on
    flows.count_windows(spark.readStream.schema(POSTS_SCHEMA).parquet(f"{source}/part*"), out, checkpoint, ["source"], "1 day", "2 days")
    assert sorted(r.post_id for r in spark.read.parquet(f"{out}/late").collect()) == ["a-10", "a-6"]


def test_progress_reports_with_state_and_observed_numbers(spark, tmp_path):
    batches = [[post(1, "same words here")], [post(2, "Same words, here!"), post(3, "other words here")]]
    stream = stream_of(spark, batches, str(tmp_path / "in")).observe("seen", F.count(F.lit(1)).alias("n"))
    heard = []
    with ProgressLog(spark, on_row=heard.append) as log:
        query = flows.drain(flows.drop_repeats(stream, "30 days"), lambda b, n: b.count(), str(tmp_path / "checkpoint"))
        log.finished(query)
    rows = [r for r in log.table(query).orderBy("batch").collect() if r.input_rows]
    assert [r.input_rows for r in rows] == [1, 2] and rows[-1].state_rows == 2
    assert [json.loads(r.observed)["seen"]["n"] for r in rows] == [1, 2] and len(heard) >= 2
