import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.operators.profile import describe_number, feed_summary, value_counts
from postlens.operators.sampling import byte_budget, first_rows, fraction_of, key_slice, priority_budget


def rows(spark, sizes, groups=None):
    data = [(i, "x" * s, (groups or ["g"] * len(sizes))[i]) for i, s in enumerate(sizes)]
    return spark.createDataFrame(data, "id int, text string, grp string").repartition(5)


def size_of(row):
    return len(str(row.id)) + len(row.text) + len(row.grp)


def expected(ordered, target):
    kept, total = set(), 0
    for r in ordered:
        if total >= target:
            break
        kept.add(r.id)
        total += size_of(r)
    return kept


@pytest.mark.parametrize("target", [1, 50, 333, 2500, 10**9])
def test_budget_keeps_the_crossing_row(spark, target):
    df = rows(spark, [(i * 7) % 40 for i in range(150)])
    ordered = sorted(df.collect(), key=lambda r: r.id)
    assert {r.id for r in byte_budget(df, target, ["id"]).collect()} == expected(ordered, target)


def test_budget_of_nothing(spark):
    assert byte_budget(rows(spark, [1, 2]), 0, ["id"]).count() == 0
    assert byte_budget(rows(spark, [1, 2]).limit(0), 10, ["id"]).count() == 0


def test_budget_with_priorities(spark):
    df = rows(spark, [(i * 5) % 30 for i in range(90)], [["b", "a", "c"][i % 3] for i in range(90)])
    order = {"a": 0, "b": 1}
    ordered = sorted([r for r in df.collect() if r.grp in order], key=lambda r: (order[r.grp], r.id))
    for target in (100, 700, 10**6):
        got = priority_budget(df, target, "grp", ["a", "none", "b"], ["id"])
        assert {r.id for r in got.collect()} == expected(ordered, target)
        assert got.columns == df.columns


def test_budget_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, [10] * 100).write.parquet(path)
    df = spark.read.parquet(path)
    plan = byte_budget(df, 300, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(id" in plan and "Window" not in plan


def test_nulls_weigh_four(spark):
    df = spark.createDataFrame([(i, None) for i in range(9)], "id int, text string")
    assert {r.id for r in byte_budget(df, 6, ["id"]).collect()} == {0, 1}


def test_first_rows(spark):
    df = rows(spark, [1] * 57)
    for n in (0, 1, 20, 57, 100):
        assert {r.id for r in first_rows(df, n, ["id"]).collect()} == set(range(min(n, 57)))


def test_ambiguous_order_is_an_error(spark):
    df = spark.createDataFrame([(1,), (1,), (1,)], "id int")
    with pytest.raises(ValueError, match="total order"):
        first_rows(df, 2, ["id"])


def test_two_column_order(spark):
    df = spark.createDataFrame([(a, b) for a in range(6) for b in range(6)], "a int, b int").repartition(4)
    assert {(r.a, r.b) for r in first_rows(df, 15, ["a", "b"]).collect()} == {(i // 6, i % 6) for i in range(15)}


def test_nulls_come_first(spark):
    df = spark.createDataFrame([(i if i else None, i) for i in range(6)], "a int, b int")
    assert {r.b for r in first_rows(df, 3, ["a"]).collect()} == {0, 1, 2}
    assert {r.b for r in first_rows(df, 1, ["a", "b"]).collect()} == {0}


def test_large_ranges_are_divided_again(spark, monkeypatch):
    from postlens.operators import sampling
    monkeypatch.setattr(sampling, "ROWS_IN_ORDER", 5)
    df = rows(spark, [1] * 157)
    for n in (1, 57, 156):
        assert {r.id for r in first_rows(df, n, ["id"]).collect()} == set(range(n))
    with pytest.raises(ValueError, match="total order"):
        first_rows(spark.createDataFrame([(1,)] * 50, "id int"), 20, ["id"])
    got = {r.statistic: r.value for r in describe_number(spark.range(101).select(F.col("id").cast("double").alias("x")), "x").collect()}
    assert (got["25%"], got["50%"], got["75%"]) == (25.0, 50.0, 75.0)


def test_slices_partition_the_keys(spark):
    df = spark.createDataFrame([(i / 100,) for i in range(100)] + [(None,)], "sample_key double")
    counts = [key_slice(df, lo, hi).count() for lo, hi in ((0.0, 0.25), (0.25, 0.5), (0.5, 1.0))]
    assert counts == [25, 25, 50] and fraction_of(df, 1.0).count() == 100


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [5.0] * 40 + [1.0, 9.0], list(range(101)), [None, 2.0, 4.0, 8.0]])
def test_describe_is_exact(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(3)
    got = {r.statistic: r.value for r in describe_number(df, "x").collect()}
    data = np.array([v for v in values if v is not None], dtype=float)
    for name, q in (("25%", 25), ("50%", 50), ("75%", 75)):
        assert got[name] == pytest.approx(np.percentile(data, q))
    assert got["count"] == len(data) and got["min"] == data.min() and got["max"] == data.max()
    assert got["mean"] == pytest.approx(data.mean())
    if len(data) > 1:
        assert got["std"] == pytest.approx(data.std(ddof=1))


def test_describe_of_nothing(spark):
    assert describe_number(spark.createDataFrame([], "x double"), "x").collect() == [("count", 0.0)]


def test_summary_and_counts(spark):
    df = rows(spark, [1, 2, 3], ["a", "a", "b"])
    got = {(r.feed, r.combined): (r.rows, r.bytes) for r in feed_summary(df, "grp").collect()}
    assert got == {("a", False): (2, 7), ("b", False): (1, 5), (None, True): (3, 12)}
    labels = df.select(F.when(F.col("id") > 0, F.lit("x")).alias("l"))
    assert value_counts(labels, "l").collect() == [("x", 2), (None, 1)]
