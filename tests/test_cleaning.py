import datetime as dt
import hashlib
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from postlens.functions import text as X
from postlens.operators.cleaning import clean, deduplicate, removed_share

SCHEMA = "post_id string, source string, text string, created_ts timestamp"
NOON = dt.datetime(2021, 1, 1, 12)


def posts(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_cleaning_steps(spark):
    rows = [("1", "a", "See https://x.example/p#frag NOW @bob_1 it's 2 good\n\n!!", NOON),
            ("2", "a", " [Deleted] ", NOON), ("3", "a", "[removed]", NOON), ("4", "a", "www.only.url", NOON),
            ("5", "a", "12 !", NOON), ("6", "a", "ab", NOON), ("7", "a", "abc", NOON)]
    found = {r.post_id: r for r in clean(posts(spark, rows)).collect()}
    assert set(found) == {"1", "7"}
    assert found["1"].text_clean == "see now it s good"
    assert "https" not in found["1"].text_v and "NOW" in found["1"].text_v


def test_url_removed_before_the_cut(spark):
    rows = [("1", "a", "https://" + "x" * 2000 + " " + "word " * 400, NOON)]
    row = clean(posts(spark, rows), 1000).first()
    assert len(row.text_v) == 1000 and row.text_clean.startswith("word word")
    assert len(clean(posts(spark, rows)).first().text_v) == 2001


def test_texts_that_differ_late_are_no_duplicates(spark):
    rows = [("1", "a", "word " * 400 + "first", NOON), ("2", "a", "word " * 400 + "second", NOON)]
    assert deduplicate(clean(posts(spark, rows))).count() == 2
    assert deduplicate(clean(posts(spark, rows), 1000)).count() == 1


def test_a_post_with_an_id_survives_one_without(spark):
    for rows in ([(None, "a", "same text", NOON), ("7", "a", "same text", NOON)], [("7", "a", "same text", NOON), (None, "a", "same text", NOON)]):
        assert [r.post_id for r in deduplicate(clean(posts(spark, rows))).collect()] == ["7"]


def test_survivor_is_the_earliest_then_smallest_id(spark):
    later = NOON + dt.timedelta(hours=1)
    rows = [("9", "a", "Same text!", NOON), ("2", "a", "same TEXT", NOON), ("1", "a", "same text", later),
            ("5", "b", "same text", later)]
    for parts in (1, 5):
        kept = deduplicate(clean(posts(spark, rows).repartition(parts))).collect()
        assert {(r.post_id, r.source) for r in kept} == {("2", "a"), ("5", "b")}
        assert {r.text_v for r in kept if r.source == "a"} == {"same TEXT"}


def test_hot_duplicate_is_merged_before_the_shuffle(spark):
    many = spark.range(3000).select(F.col("id").cast("string").alias("post_id"), F.lit("a").alias("source"),
                                    F.when(F.col("id") % 3 == 0, F.lit("buy now please")).otherwise(
                                        F.concat(F.lit("text "), F.translate(F.col("id").cast("string"), "0123456789",
                                                                              "abcdefghij"))).alias("text"),
                                    F.lit(NOON).alias("created_ts"))
    kept = deduplicate(clean(many))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert kept.count() == 2001


def test_removed_share_counts_all_stages(spark):
    rows = [("1", "a", "one two", NOON), ("2", "a", "ONE two", NOON), ("3", "a", "[deleted]", NOON), ("4", "b", "one two", NOON)]
    row = removed_share(posts(spark, rows)).first()
    assert (row.rows_in, row.rows_clean, row.rows_distinct, row.removed_share) == (4, 3, 2, 0.5)
    assert removed_share(posts(spark, [])).first().removed_share is None


def brute(text):
    seen = re.sub(r"https?://\S+|www\.\S+", "", text, flags=re.ASCII)
    low = re.sub(r"@\w+", " ", seen, flags=re.ASCII).lower()
    return re.sub(r"\s+", " ", re.sub(r"[^a-z\s]", " ", low, flags=re.ASCII), flags=re.ASCII).strip(" ")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB é@_#/:.w\n\t htps!1", max_size=40), min_size=1, max_size=30))
def test_plain_text_matches_brute_force(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.c for r in df.select(X.plain(X.visible(F.col("text"))).alias("c")).collect()]
    assert got == [brute(t) for t in texts]


def test_tokens_and_hashtags(spark):
    df = spark.createDataFrame([("the cat cat sat mouse horse", "#Cat #cat #café #ab #x_1 a#b")], "c string, v string")
    row = df.select(X.distinct_tokens(F.col("c")).alias("t"), X.distinct_hashtags(F.col("v")).alias("h")).first()
    assert row.t == ["the", "cat", "sat", "mouse", "horse"]
    assert row.h == ["cat", "caf", "ab", "x_1", "b"]
    words = spark.createDataFrame([("mouse",), ("their",), ("cat",)], "token string")
    assert [r.token for r in words.where(X.is_keyword(F.col("token"))).collect()] == ["mouse"]


def test_sample_key_value(spark):
    from postlens.functions.keys import sample_key
    key = spark.createDataFrame([("a-1",)], "p string").select(sample_key(F.col("p"))).first()[0]
    assert key == int(hashlib.md5(b"a-1").hexdigest()[:8], 16) / 2**32
