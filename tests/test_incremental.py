import datetime as dt
import math

import pytest

from postlens.operators.aggregates import result_tables
from postlens.operators.sentiment import default_lexicon
from postlens.plans.analytics import scored_posts
from postlens.plans.incremental import add_slice, merged_tables
from postlens.schema import POSTS_SCHEMA

TEXTS = ["good day #market", "bad day #market", "Great news today", "nothing to say here", "terrible news #crash today", "i love this market"]


def posts(spark, days):
    """A post a day and text; copies differ in case and time."""
    rows = [(f"{'ab'[d % 2]}-{d}-{k}", "ab"[d % 2], t.upper() if d % 3 else t, dt.datetime(2021, 1 + d % 3, 1 + d), f"c{d % 2}" if d % 2 else None,
             ["bullish", "bearish", None][k % 3], float(k - d) if k % 2 else None, 0.5) for d in days for k, t in enumerate(TEXTS) if (d + k) % 4]
    return spark.createDataFrame(rows, POSTS_SCHEMA)


def plain(table):
    columns = sorted(table.columns)
    return columns, sorted((tuple(r[c] for c in columns) for r in table.collect()), key=str)


@pytest.mark.parametrize("order", [[2, 0, 1]])
def test_slices_in_any_order_equal_one_run(spark, tmp_path, order):
    lexicon, root = default_lexicon(spark), str(tmp_path / "tables")
    slices = [posts(spark, range(a, a + 6)) for a in (0, 6, 12)]
    told = [add_slice(slices[i], lexicon, root, f"s{i}") for i in order]
    assert add_slice(slices[order[-1]], lexicon, root, f"s{order[-1]}") == told[-1]          # the last one again
    assert sum(t["taken_over"] for t in told) > 0
    whole = slices[0].unionByName(slices[1]).unionByName(slices[2])
    want, got = result_tables(scored_posts(whole, lexicon), 1, 1), merged_tables(spark, root, 1, 1)
    assert set(want) == set(got)
    for name in want:
        if name == "validation_corr":
            a, b = want[name].first().value, got[name].first().value
            assert a == pytest.approx(b, abs=1e-9) or math.isnan(a) and math.isnan(b)
        else:
            assert plain(got[name]) == plain(want[name]), name
    assert spark.read.parquet(f"{root}/survivors").count() == sum(t["new"] + t["taken_over"] for t in told)


def test_copy_of_the_same_day_and_bin_with_another_score(spark, tmp_path):
    root, moment = str(tmp_path / "tables"), dt.datetime(2021, 1, 1)
    for k, (name, text) in enumerate([("a-9", "good day!"), ("a-1", "good day")]):
        row = (name, "a", text, moment, "c", None, None, 0.5)
        add_slice(spark.createDataFrame([row], POSTS_SCHEMA), default_lexicon(spark), root, f"s{k}")
    tables = merged_tables(spark, root, 1, 1)
    assert [(r.n, r.avg_compound) for r in tables["daily_sentiment"].collect()] == [(1, 0.4404)]
    assert [(r.n, r.avg_compound) for r in tables["community_sentiment"].collect()] == [(1, 0.4404)]


def test_empty_slice_and_no_labels(spark, tmp_path):
    root = str(tmp_path / "tables")
    assert add_slice(posts(spark, []), default_lexicon(spark), root, "none") == {"new": 0, "taken_over": 0}
    tables = merged_tables(spark, root)
    assert all(tables[name].count() == 0 for name in tables if name != "validation_corr")
    assert math.isnan(tables["validation_corr"].first().value)
