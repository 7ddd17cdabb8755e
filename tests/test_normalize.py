import datetime as dt

import pytest
from pyspark.sql import functions as F

from postlens.functions.times import event_time
from postlens.operators.normalize import language_only, normalize, storable, unite, with_default
from postlens.schema import POSTS_SCHEMA, find_column


def parsed(spark, values, dtype):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, created_at {dtype}")
    rows = df.select("i", F.unix_micros(event_time(df, "created_at")).alias("t")).orderBy("i").collect()
    return [r.t for r in rows]


SECOND = 1609459200
MICROS = SECOND * 1_000_000


def test_epoch_units(spark):
    assert parsed(spark, [SECOND, SECOND * 1000, SECOND * 10**6, SECOND * 10**9], "bigint") == [MICROS] * 4
    # Limits are exclusive: exactly 1e11 is still seconds, one above is milliseconds.
    assert parsed(spark, [10**11, 10**11 + 1000], "bigint") == [10**17, (10**11 + 1000) * 1000]
    assert parsed(spark, [10**14, 10**17], "bigint") == [10**17, 10**17]


def test_epoch_types(spark):
    assert parsed(spark, [SECOND], "int") == [MICROS]
    assert parsed(spark, [float(SECOND) + 0.5], "double") == [MICROS + 500000]
    from decimal import Decimal
    assert parsed(spark, [Decimal(SECOND)], "decimal(20,0)") == [MICROS]


def test_text_times(spark):
    texts = ["2021-01-01T00:00:00Z", "2021-01-01 00:00:00+00:00", "2021-01-01", "Fri Jan 01 00:00:00 +0000 2021",
             "Fri Jan 01 01:00:00 +0100 2021", str(SECOND), "junk", "", None]
    assert parsed(spark, texts, "string") == [MICROS] * 6 + [None] * 3


def test_typed_times(spark):
    assert parsed(spark, [dt.date(2021, 1, 1), None], "date") == [MICROS, None]
    assert parsed(spark, [dt.datetime(2021, 1, 1)], "timestamp_ntz") == [MICROS]


def test_column_choice():
    assert find_column(["Body", "TEXT"], ["text", "body"]) == "TEXT"
    assert find_column(["BODY", "x"], ["text", "body"]) == "BODY"
    assert find_column(["x"], ["text"]) is None


def test_normalize_labelled_feed(spark):
    df = spark.createDataFrame(
        [(1, "Hello", SECOND, "BULLISH", 0.5), (2, "", SECOND, "x", 1.0), (3, None, SECOND, "x", 1.0),
         (4, "no time", None, "x", 1.0)],
        "Id bigint, Text string, Created_At bigint, Sentiment_Label string, sentiment_score double")
    rows = normalize(df, "a", labels=True).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.post_id, row.source, row.orig_sentiment, row.orig_score, row.community) == ("a-1", "a", "bullish", 0.5, None)


def test_normalize_community_feed_ignores_labels(spark):
    df = spark.createDataFrame([("x", "t", SECOND, "r/cats", "pos"), ("y", "t", SECOND, "dogs/r/", "pos")],
                               "comment_id string, body string, created_utc bigint, subreddit string, label string")
    rows = {r.post_id: r for r in normalize(df, "b", community=True).collect()}
    assert rows["b-x"].community == "cats" and rows["b-y"].community == "dogs/r/"
    assert rows["b-x"].orig_sentiment is None


def test_normalize_needs_text_and_time(spark):
    with pytest.raises(ValueError, match="no text or no time"):
        normalize(spark.createDataFrame([(1,)], "id int"), "a")


def test_ids_and_sample_keys_do_not_depend_on_layout(spark):
    df = spark.createDataFrame([(f"text {i}", SECOND + i) for i in range(200)], "text string, time bigint")
    one = {(r.post_id, r.sample_key) for r in unite([normalize(df.coalesce(1), "a")]).collect()}
    many = {(r.post_id, r.sample_key) for r in unite([normalize(df.repartition(7), "a")]).collect()}
    assert one == many and len(one) == 200
    assert all(0 <= key < 1 for _, key in one)


def test_missing_id_still_has_sample_key(spark):
    df = spark.createDataFrame([(None, "t", SECOND)], "id string, text string, time bigint")
    posts = unite([normalize(df, "a")])
    row = posts.first()
    assert row.post_id is None and row.sample_key is not None
    assert posts.schema.names == POSTS_SCHEMA.names


def test_default_column_and_language(spark):
    df = spark.createDataFrame([("en", None), (None, "x"), ("de", "y")], "language string, subreddit string")
    assert [r.subreddit for r in with_default(df, "subreddit", "z").collect()] == [None, "x", "y"]
    assert with_default(df.drop("subreddit"), "subreddit", "z").select("subreddit").distinct().collect()[0][0] == "z"
    assert language_only(df).count() == 1


def test_storable(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 2), float("nan"), 1), (None, 2.0, 2)], "d date, x double, n int")
    out = storable(df)
    assert out.dtypes == [("d", "timestamp"), ("x", "double"), ("n", "int")]
    assert [(r.d, r.x) for r in out.orderBy("n").collect()] == [(dt.datetime(2021, 1, 2), None), (None, 2.0)]
