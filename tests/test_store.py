import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from postlens.plans.analytics import refresh_derived, run_analytics
from postlens.plans.experiments import growth_verdict, scalability
from postlens.plans.ingest import bulk_load, loaded_posts, resumable_load
from postlens.operators.normalize import unite, normalize
from postlens.operators.sentiment import default_lexicon
from postlens.schema import POSTS_SCHEMA
from postlens.scratch import new_folder, scratch_root
from postlens.session import settings
from postlens.sources.feeds import Feed, load_feeds, scan_types, standard_feeds
from postlens.sources import store as S
from postlens.sources.layout import z_ordered

SECOND = 1609459200


def posts(spark, n=400):
    df = spark.range(n).select(
        F.col("id"), F.concat(F.lit("good market number "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"),
        (F.col("id") * 86400 + SECOND).alias("created_at"), F.lit("bullish").alias("label"), F.rand(1).alias("sentiment_score"))
    return unite([normalize(df, "a", labels=True), normalize(df, "b")])


def test_round_trip_prunes_by_source_and_key(spark, tmp_path):
    path = str(tmp_path / "store")
    S.write_posts(posts(spark), path)
    back = S.read_posts(spark, 0.5, path)
    assert back.schema.names == POSTS_SCHEMA.names
    assert sorted(back.collect()) == sorted(posts(spark).where("sample_key < 0.5").collect())
    plan = back.where("source = 'a'").select("post_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "LessThan(sample_key,0.5)" in plan
    assert "sample_key" in plan and "text:string" not in plan.split("ReadSchema")[1]


def test_writing_posts_does_not_shuffle(spark, tmp_path):
    plan = posts(spark).sortWithinPartitions("source", "sample_key")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_bulk_load_slices_add_up(spark, tmp_path):
    path = str(tmp_path / "store")
    for _ in range(2):       # a second load replaces the first
        rows = bulk_load(posts(spark), path, metrics=str(tmp_path / "metrics"))
    assert [r["dataset_fraction"] for r in rows] == [0.25, 0.5, 1.0]
    assert rows[-1]["cumulative_rows"] == 800 == sum(r["slice_rows"] for r in rows)
    assert S.count_stored(S.read_posts(spark, 1.0, path), 0.25) == rows[0]["slice_rows"]
    assert spark.read.parquet(str(tmp_path / "metrics")).count() == 6


def test_feeds(spark, tmp_path):
    a = spark.createDataFrame([(1, "hello there", SECOND)], "id int, text string, created_at bigint")
    with pytest.raises(FileNotFoundError, match="reddit_chunk"):
        load_feeds(spark, standard_feeds(str(tmp_path)))
    a.write.parquet(str(tmp_path / "tweets_chunk_0.parquet"))
    with pytest.raises(FileNotFoundError, match="tweets_chunk"):
        load_feeds(spark, standard_feeds(str(tmp_path)))
    a.withColumnRenamed("text", "body").write.parquet(str(tmp_path / "reddit_chunk_0.parquet"))
    found = load_feeds(spark, standard_feeds(str(tmp_path)))
    assert {r.post_id for r in found.collect()} == {"twitter-1", "reddit-1"}
    one = load_feeds(spark, [Feed("talk", str(tmp_path / "reddit_*"), community=True, default_community="r/all")])
    assert one.first().community == "all"


def test_result_tables(spark, tmp_path):
    root = str(tmp_path / "results")
    full = spark.createDataFrame([(dt.date(2021, 1, 1), 1.0)], "day date, x double")
    assert S.replace_tables({"t": full, "none": full.limit(0)}, root) == ["t"]
    assert S.replace_tables({"t": full.limit(0)}, root) == []
    assert spark.read.parquet(f"{root}/t").count() == 1
    S.replace_tables({"u": full}, root, untyped=True)
    assert dict(spark.read.parquet(f"{root}/u").dtypes)["day"] == "timestamp"


def test_csv_words_survive(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("token,n\nnull,1\nnan,2\n,3\nNA,4\n")
    rows = {r.n: r.token for r in S.read_csv_result(spark, str(path), "token string, n int").collect()}
    assert rows == {1: "null", 2: "nan", 3: None, 4: "NA"}


def test_fallback_order(spark, tmp_path):
    schema = "x int"
    full, empty = spark.createDataFrame([(1,)], schema), spark.createDataFrame([], schema)
    broken = lambda s: s.read.schema(schema).parquet(str(tmp_path / "nowhere"))
    read = lambda a, b: (lambda r: (r[0].count(), r[1]))(S.read_with_fallback(spark, schema, a, b))
    assert read(lambda s: full, lambda s: empty) == (1, "store")
    assert read(lambda s: empty, lambda s: full) == (1, "file")
    assert read(broken, lambda s: full) == (1, "file")
    assert read(broken, broken) == (0, "missing")
    assert read(None, None) == (0, "missing")
    (tmp_path / "broken.parquet").write_text("this is no Parquet file")
    with pytest.raises(Exception, match="broken.parquet"):
        read(lambda s: s.read.schema(schema).parquet(str(tmp_path / "broken.parquet")), lambda s: full)
    down = lambda s: (_ for _ in ()).throw(ConnectionError("no store"))
    with pytest.raises(ConnectionError):
        read(down, lambda s: full)
    assert S.read_with_fallback(spark, schema, down, lambda s: full, unreachable=(ConnectionError,))[1] == "file"


def test_store_by_time(spark, tmp_path):
    """The second layout: rows of a source in the order of time, so that a span of time skips pages."""
    from postlens.schema import POSTS_SCHEMA
    import datetime as dt
    rows = [(str(i), "a", "t", dt.datetime(2021, 1, 1) + dt.timedelta(hours=(i * 37) % 100), None, None, None, i / 100) for i in range(100)]
    S.write_posts(spark.createDataFrame(rows, POSTS_SCHEMA).coalesce(1), str(tmp_path / "p"), by="created_ts")
    times = [r.created_ts for r in spark.read.parquet(str(tmp_path / "p")).collect()]
    assert times == sorted(times) and len(times) == 100


def test_chunks(spark, tmp_path):
    path = str(tmp_path / "chunks")
    for _ in range(2):
        S.write_chunks(spark.range(0, 1050, 1, 1), path, 500)
    sizes = sorted(r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect())
    assert sizes == [50, 500, 500]


def test_run_and_refresh(spark, tmp_path):
    results = str(tmp_path / "results")
    metrics, tables = run_analytics(posts(spark), default_lexicon(spark), 1.0, results, min_keyword_count=2, min_total=10,
                                    min_months=2, min_peak_count=2)
    assert metrics["rows_in"] == 800 and metrics["rows_after_cleaning"] == 800
    stored = spark.read.parquet(f"{results}/daily_sentiment")
    assert stored.agg(F.sum("n")).first()[0] == 800
    assert spark.read.parquet(f"{results}/validation_metrics").count() == 13
    refreshed = refresh_derived(spark, results, min_total=10, min_months=2, min_peak_count=2)
    assert sorted(refreshed["trend_terms"].collect()) == sorted(tables["trend_terms"].collect())


def test_scalability_and_growth(spark):
    rows = scalability(posts(spark, 60), default_lexicon(spark), warm_up=None, fractions=[0.5, 1.0])
    assert [r["dataset_fraction"] for r in rows] == [0.5, 1.0] and rows[1]["rows_in"] == 120
    verdict = lambda full: growth_verdict(spark.createDataFrame([(0.25, 10.0), (1.0, full)], "dataset_fraction double, total_seconds double")).first().verdict
    assert [verdict(x) for x in (35.9, 36.0, 43.9, 44.0)] == ["sub-linear", "linear", "linear", "super-linear"]


def test_scratch_follows_the_session(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_store_for_both_access_paths(spark, tmp_path):
    """Either predicate lets statistics skip at least half of the row groups, also where most times lie close together."""
    rows = [(f"{s}-{i}", s, "x" * 200, dt.datetime(2021, 1, 1) + dt.timedelta(minutes=(i * 7919 % n) ** 2 // n), None, None, None, (i * 104729 % n) / n)
            for s, n in (("a", 40_000), ("b", 500)) for i in range(n)]
    odd = [(None, "a", "odd", dt.datetime(1970, 1, 1), None, None, None, 0.0), ("c-1", "c", "alone", dt.datetime(2021, 1, 1), None, None, None, 0.999999)]
    posts = spark.createDataFrame(rows + odd, POSTS_SCHEMA)
    path = str(tmp_path / "store")
    S.write_posts(posts, path, mode="overwrite", by="both", **{"parquet.block.size": 16384, "parquet.page.size": 2048,
                                                              "parquet.block.size.row.check.min": 100, "compression": "none"})
    assert sorted(map(str, S.read_posts(spark, 2.0, path).collect())) == sorted(map(str, posts.collect()))
    groups = []
    for file in sorted((tmp_path / "store" / "source=a").glob("*.parquet")):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            row_group = meta.row_group(g)
            groups.append([row_group.column(names.index(c)).statistics for c in ("sample_key", "created_ts")])
    assert len(groups) >= 16
    times = sorted(r[3] for r in rows if r[1] == "a")
    low, high = (t.replace(tzinfo=dt.timezone.utc) for t in (times[10_000], times[15_000]))
    hit = [sum(k.min < 0.1 for k, _ in groups), sum(t.max.replace(tzinfo=dt.timezone.utc) >= low and t.min.replace(tzinfo=dt.timezone.utc) < high
                                                 for _, t in groups)]
    assert max(hit) <= len(groups) / 2, (hit, len(groups))
    span = S.read_posts(spark, 0.5, path, source="a", since=times[10_000], until=times[15_000])
    assert span.count() == sum(times[10_000] <= r[3] < times[15_000] and r[7] < 0.5 and r[1] == "a" for r in rows)
    with settings(spark, {"spark.sql.maxMetadataStringLength": "1000"}):
        plan = span.where("true")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_ts" in plan and "LessThan(sample_key" in plan


def test_feed_of_mixed_types(spark, tmp_path):
    moment = dt.datetime(2021, 5, 1, 12)
    seconds = int(moment.replace(tzinfo=dt.timezone.utc).timestamp())
    tables = [("c0", [(1, "a", seconds * 1000)], "id long, text string, created_at long"), ("c1", [("2", "b", str(seconds))], "id string, text string, created_at string"),
              ("c2", [(3, "c", moment)], "id int, text string, created_at timestamp"), ("c3", [("4", "d", "2021-05-01 12:00:00")], "id string, text string, created_at string"),
              ("c4", [("e", "2021-05-01", 1.5)], "body string, date string, other double"), ("c5", [(None, None, None)], "id string, text string, created_at string")]
    for name, rows, schema in tables:
        spark.createDataFrame(rows, schema).withColumn(f"extra_{name}", F.lit(name)).coalesce(1).write.parquet(str(tmp_path / "raw" / name))
    feed = Feed("f", f"{tmp_path}/raw/c*", mixed_types=True)
    assert len(scan_types(spark, feed)) == 4
    got = load_feeds(spark, [feed]).collect()
    assert {(r.post_id, r.text) for r in got if r.text != "e"} == {("f-1", "a"), ("f-2", "b"), ("f-3", "c"), ("f-4", "d")}
    assert {r.created_ts for r in got} == {moment, dt.datetime(2021, 5, 1)}
    with pytest.raises(FileNotFoundError, match="none"):
        load_feeds(spark, [Feed("g", f"{tmp_path}/none*", mixed_types=True)])


def test_load_that_broke_off_is_resumed(spark, tmp_path):
    source, root, begun = posts(spark), str(tmp_path / "load"), []

    def break_off(k):
        begun.append(k)
        if len(begun) == 3:
            S.write_posts(source.limit(5), f"{root}/posts/slice=2", mode="overwrite")     # half a slice, no manifest row
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        resumable_load(source, root, before_slice=break_off)
    assert loaded_posts(spark, root).count() == source.where("sample_key < 0.5").count()
    rows = resumable_load(source, root, before_slice=begun.append)
    assert begun == [0, 1, 2, 2] and resumable_load(source, root, before_slice=begun.append) == rows and len(begun) == 4
    assert sorted(map(str, loaded_posts(spark, root).collect())) == sorted(map(str, source.select(POSTS_SCHEMA.names).collect()))
    assert [r["cumulative_rows"] for r in rows] == [source.where(f"sample_key < {f}").count() for f in (0.25, 0.5, 1.0)]
    resumable_load(source, root, slices=[(0.0, 0.25), (0.25, 0.4)])                       # other bounds: that slice anew
    assert loaded_posts(spark, root).where("sample_key >= 0.4 and sample_key < 0.5").count() == 0


def test_curve_deals_no_source_to_one_task(spark):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "64k"}):
        plan = z_ordered(posts(spark, 20_000))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "rangepartitioning" in plan and "hashpartitioning" not in plan
