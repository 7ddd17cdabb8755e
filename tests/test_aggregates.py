import datetime as dt
import math

from pyspark.sql import functions as F

from postlens.operators import aggregates as A, insights as I

SCHEMA = ("source string, sentiment string, day date, month date, compound double, community string, text_v string, "
          "text_clean string, orig_sentiment string, orig_score double")
D1, D2, M = dt.date(2021, 1, 1), dt.date(2021, 1, 2), dt.date(2021, 1, 1)


def scored(spark, compounds, label=None, score=None):
    rows = [("a", "positive" if c >= .05 else "negative" if c <= -.05 else "neutral", D1, M, c, "x", "", "", label, score)
            for c in compounds]
    return spark.createDataFrame(rows, SCHEMA)


def test_histogram_edges(spark):
    got = {r.bin: r["count"] for r in A.compound_hist(scored(spark, [-1.0, -0.9, -0.8, -0.4, 0.05, 0.9, 1.0])).collect()}
    assert got == {-1.0: 1, -0.9: 1, -0.8: 1, -0.4: 1, 0.0: 1, 0.9: 1, 1.0: 1}


def test_daily_mean_does_not_depend_on_partitions(spark):
    values = [0.1234, -0.4321, 0.0001, 0.9999, 0.05, -0.05, 0.3333, 0.6667]
    answers = {A.daily_sentiment(scored(spark, values).repartition(n)).first().avg_compound for n in (1, 2, 3, 8)}
    assert answers == {round(sum(round(v * 10000) for v in values) / len(values)) / 10000}


def test_correlation_never_fails(spark):
    value = lambda df: A.validation_corr(df).first().value
    assert math.isnan(value(scored(spark, [])))
    assert math.isnan(value(scored(spark, [0.5], "pos", 1.0)))
    assert math.isnan(value(scored(spark, [0.5, 0.5, 0.5], "pos", 1.0)))
    mixed = scored(spark, [0.1, 0.2, 0.3], "pos").withColumn("orig_score", F.col("compound") * -2)
    assert abs(value(mixed) + 1) < 1e-12


def test_keyword_counts_posts_not_words(spark):
    rows = [("a", "neutral", D1, M, 0.0, None, "#One #one #to", "apple apple their pear", None, None)] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    assert {(r.token, r.n) for r in A.keyword_monthly(df, 1).collect()} == {("apple", 3), ("pear", 3)}
    assert A.keyword_monthly(df, 4).count() == 0
    assert {(r.hashtag, r.n) for r in A.hashtag_monthly(df, 1).collect()} == {("one", 3)}


def test_shares_contrast_and_checks(spark):
    table = spark.createDataFrame([("a", "positive", 3), ("a", "negative", 1), ("b", "positive", 1), ("b", "neutral", 1)],
                                  "source string, sentiment string, count bigint")
    shares = {r.source: (r.posts, r.positive, r.neutral, r.negative) for r in A.class_share(table).collect()}
    assert shares == {"a": (4, 0.75, 0.0, 0.25), "b": (2, 0.5, 0.5, 0.0)}
    row = A.source_contrast(A.class_share(table)).first()
    assert (row.highest, row.lowest, row.gap_points, row.verdict) == ("a", "b", 25.0, "different")
    same = A.source_contrast(A.class_share(table.withColumn("source", F.lit("a")))).first()
    assert same.verdict == "similar"
    confusion = spark.createDataFrame([("positive", "positive", 3), ("positive", "neutral", 1)],
                                      "orig string, sentiment string, count bigint")
    check = A.label_check(confusion).first()
    assert (check.label_classes, check.comparable, check.predicted_positive_pct) == (1, False, 75.0)


def test_kpis_of_nothing(spark):
    daily = spark.createDataFrame([], "day date, source string, n bigint, avg_compound double, n_pos bigint, n_neg bigint")
    assert A.kpis(daily).first() == (0, 0.0, 0.0, 0.0)


def test_rolling_rows_and_days(spark):
    days = [dt.date(2021, 1, d) for d in (1, 2, 10)]
    daily = spark.createDataFrame([(d, "a", v) for d, v in zip(days, [0.1, 0.3, 0.5])], "day date, source string, avg_compound double")
    rows = [round(r.smoothed, 6) for r in I.rolling_daily(daily, 2).orderBy("day").collect()]
    calendar = [round(r.smoothed, 6) for r in I.rolling_daily(daily, 2, "days").orderBy("day").collect()]
    assert rows == [0.1, 0.2, 0.4] and calendar == [0.1, 0.2, 0.5]


def test_per10k_without_total_is_null(spark):
    kw = spark.createDataFrame([(M, "a", "x", 5), (dt.date(2021, 2, 1), "a", "x", 5)], "month date, source string, token string, n bigint")
    totals = spark.createDataFrame([(M, "a", 100)], "month date, source string, n bigint")
    got = [r.per_10k for r in I.keyword_per10k(kw, totals, ["x"]).orderBy("month").collect()]
    assert got == [500.0, None]
