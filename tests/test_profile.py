import pytest
from pyspark.sql import functions as F

from postlens.operators import profile
from postlens.streaming import gate


@pytest.mark.parametrize("tracked", [16, 512, 8192])
def test_top_values_equal_the_full_count(spark, tracked):
    """Few heavy values, a tie at the end, nulls, and thousands of rare ones; too small a sketch falls back to counting all."""
    rows = spark.range(40_000).select(F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 4 == 1, F.concat(F.lit("h"), F.col("id") % 24)).otherwise(
        F.concat(F.lit("r"), F.col("id") % 9973)).alias("v")).repartition(7)
    for n in (3, 7, 12):
        assert profile.top_values(rows, "v", n, tracked).collect() == profile.value_counts(rows, "v", n).collect()
    assert profile.top_values(rows.limit(0), "v", 3, tracked).count() == 0
    assert profile.top_values(rows.where("v is null"), "v", 3, tracked).collect() == [(None, 4000)]


def test_values_beyond_the_bound_are_not_counted_twice(spark):
    rows = spark.range(100_000).select(F.when(F.col("id") % 2 == 0, F.lit("half")).otherwise(F.col("id").cast("string")).alias("v"))
    assert profile.top_values(rows, "v", 1, 1024).collect() == [("half", 50_000)]


def test_fields_of_messages_set_aside(spark):
    values = ['{"post_id": "a", "body": "x", "when": 5}', '{"post_id": 7, "body": "y", "when": 6, "text": "kept"}', "{broken", "[1]", "", None, "3"]
    aside = spark.createDataFrame([(v,) for v in values], "value string")
    found = {(r.key, r.type, r.messages, r.known) for r in gate.foreign_fields(aside).collect() if r.key}
    assert found == {("post_id", "STRING", 1, True), ("post_id", "BIGINT", 1, True), ("body", "STRING", 2, False), ("when", "BIGINT", 2, False),
                     ("text", "STRING", 1, True)}
    sent = gate.with_renamed(aside, {"body": "text", "when": "created_ts"}).select(F.from_json("value", "post_id string, text string, created_ts string").alias(
        "m")).select("m.*").collect()
    assert {tuple(r) for r in sent} == {("a", "x", "5"), ("7", "kept", "6")}
