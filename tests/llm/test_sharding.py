import zlib
from collections import Counter

from pyspark.sql import functions as F

from postlens.llm import sharding

from .helpers import SF, docs_of, edge_rows


def test_curve_visits_neighbours(spark):
    for dims, bits in ((2, 4), (3, 3)):
        names = [f"c{i}" for i in range(dims)]
        cells = spark.range(1 << (dims * bits)).select(*[
            F.shiftright("id", bits * i).bitwiseAND((1 << bits) - 1).cast("int").alias(n) for i, n in enumerate(names)])
        found = cells.withColumn("h", sharding.hilbert([F.col(n) for n in names], bits)).orderBy("h").collect()
        assert [r.h for r in found] == list(range(1 << (dims * bits)))
        for a, b in zip(found, found[1:], strict=False):
            assert sum(abs(a[n] - b[n]) for n in names) == 1


def check(rows, result, shards):
    assert len(result) == len(rows)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in result) == want
    total, largest = sum(r["size"] for r in result), max(r["size"] for r in result)
    for s in range(shards):
        inside = [r for r in result if r.shard == s]
        assert sorted(r.slot for r in inside) == list(range(len(inside)))
        assert abs(sum(r["size"] for r in inside) - total / shards) <= largest
    return total


def test_shards_of_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, sharding.assign(docs, 16).collect(), 16)


def test_odd_rows_and_empty_table(spark):
    docs = docs_of(spark, edge_rows())
    check(edge_rows(), sharding.assign(docs, 4).collect(), 4)
    assert sharding.assign(docs.limit(0), 4).count() == 0


def test_files_hold_small_boxes(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sharding.write_shards(docs, str(tmp_path / "out"), shards=8)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == docs.count() and out.select("shard").distinct().count() == 8
    spread = out.groupBy("shard").agg(F.countDistinct("source").alias("n")).agg(F.avg("n")).first()[0]
    assert spread < docs.select("source").distinct().count() / 2


def test_every_row_is_written_once(spark, tmp_path):
    docs = docs_of(spark, edge_rows())
    for name in ("shard", "slot", "curve", "size", "_row", "n", "_hash"):
        docs = docs.withColumn(name, F.lit(7))
    sharding.write_shards(docs, str(tmp_path / "out"), shards=3)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert set(out.columns) == {*docs.columns, "_shard"}
    assert Counter(map(tuple, out.select(docs.columns).collect())) == Counter(map(tuple, docs.collect()))
    want = Counter((r.shard, r["size"]) for r in sharding.assign(docs, 3).collect())
    assert Counter((r._shard, len((r.text or "").encode()) + 1) for r in out.collect()) == want
