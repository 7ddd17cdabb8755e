import pyarrow.parquet as pq
from pyspark.sql import functions as F

from postlens.session import settings
from workload import views

SF = "/root/testdata/sf0.001"


def test_a_micro_batch_can_be_read_by_many_tasks(spark, tmp_path, monkeypatch):
    folders = []

    def folder(spark, purpose):
        folders.append(tmp_path / f"{purpose}-{len(folders)}")
        return str(folders[-1])

    monkeypatch.setattr(views, "new_folder", folder)
    spark.range(0, 400_000, 1, 8).select("id", F.md5(F.col("id").cast("string")).alias("word")).write.parquet(str(tmp_path / "t.parquet"))
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "1m"}):
        parted, streamed = views.parted_stream(spark, tmp_path, "t", "id"), views.table_stream(spark, tmp_path, "t")
    assert parted.isStreaming and streamed.isStreaming
    parts = [sorted(folders[0].glob(f"part{k}/*.parquet")) for k in range(4)]
    assert [len(files) for files in parts] == [1] * 4                                   # still one file a micro-batch
    assert all(pq.ParquetFile(files[0]).num_row_groups > 4 for files in parts)
    assert len(list(folders[1].glob("*.parquet"))) > 8                                  # by the size of the table, not four
    assert spark.read.parquet(str(folders[1])).exceptAll(spark.read.parquet(str(tmp_path / "t.parquet"))).isEmpty()


def test_a_narrow_session_does_not_join_all_posts_in_a_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "new_folder", lambda spark, purpose: str(tmp_path / purpose))
    narrow = {"spark.sql.shuffle.partitions": "1", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.files.maxPartitionBytes": "32k",
              "spark.sql.files.openCostInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with settings(spark, narrow):
        assert views.post_stream(spark, SF).isStreaming
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1"                    # for the write only
    tasks = {file.name.split("-")[1] for file in (tmp_path / "files").glob("*.parquet")}
    assert len(tasks) > 8                                                               # with the session's width: one for each feed
    stored, want = spark.read.parquet(str(tmp_path / "files")), views.posts(spark, SF)
    assert stored.count() == want.count() and stored.exceptAll(want).isEmpty()
