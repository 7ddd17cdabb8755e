"""What a query writes and shuffles: nothing twice that can be had once."""
from pyspark.sql import DataFrame, functions as F

from postlens.operators.cleaning import ANALYSED, KEY, clean, deduplicate
from postlens.scratch import new_folder
from postlens.streaming import flows
from workload import queries, views

SF = "/root/testdata/sf0.001"


def test_chunks_of_a_mixed_feed_come_from_one_join(spark, monkeypatch):
    computed = spark.sparkContext.accumulator(0)

    def counted(spark, d, raw=views.raw_documents):
        rows = raw(spark, d)

        def each(batches):
            for batch in batches:
                computed.add(batch.num_rows)
                yield batch

        return rows.mapInArrow(each, rows.schema)

    monkeypatch.setattr(queries, "raw_documents", counted)
    loaded = queries.mixed_feed(spark, SF)
    assert computed.value == views.raw_documents(spark, SF).count()
    assert loaded.count() == views.raw_documents(spark, SF).where("o_orderdate IS NOT NULL AND text <> ''").count()


def test_streams_are_written_without_a_shuffle_and_joined_before(spark, monkeypatch):
    def shuffled(*_):
        raise AssertionError("dealt out anew")

    monkeypatch.setattr(DataFrame, "repartition", shuffled)
    assert views.table_stream(spark, SF, "documents").isStreaming
    stream = views.post_stream(spark, SF)
    assert stream.isStreaming and "Join" not in stream._jdf.queryExecution().logical().toString()


def test_plain_texts_are_not_kept_between_the_steps_of_a_stream(spark, monkeypatch):
    kept, written, path = [], flows.settle, new_folder(spark, "deduped")
    monkeypatch.setattr(flows, "settle", lambda df, purpose: kept.append(df.columns) or written(df, purpose))
    flows.dedupe_stream(views.post_stream(spark, SF), path, new_folder(spark, "checkpoint"))
    assert len(kept) > 1 and all("text_v" in columns and "text_clean" not in columns for columns in kept)
    stored = spark.read.parquet(f"{path}/posts").select(KEY, *ANALYSED)
    want = deduplicate(clean(views.posts(spark, SF)), ANALYSED)
    assert stored.select(KEY, "source", "text_clean").exceptAll(want.select(KEY, "source", "text_clean")).isEmpty()
    assert stored.count() == want.count() and stored.where(F.col("text_clean").isNull()).isEmpty()
