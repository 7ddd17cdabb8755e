"""Keys a stream has seen, looked up at a cost that does not grow with their number.

The keys live in the state of a small streaming query of its own, dealt by hash over the executors. The state store is RocksDB: keys
sorted in levels that are merged by size, a Bloom filter for each file, so that a new key is told from known ones without reading
them. A batch sends its distinct keys through that query and gets back the new ones; it reads its own keys only, however long the
history is, and uploads only what changed.
"""
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from postlens.session import settings

BATCH = "batch_id"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Otherwise each partition of the state reserves 4 MB of disk for a log of a few hundred bytes.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


class KeyIndex:
    """New keys of each batch of a stream; a context manager that runs the query behind it.

    ``path/asked/N`` holds the keys batch N asks for and ``path/keys/batch_id=N`` its new ones; the state itself is in
    ``checkpoint``. A batch that is repeated gets the same answer: its question is written once, and an answer
    is never given twice. Lost executors restore their part of the state from the checkpoint. Like streaming checkpoints, the
    folders need a file system that renames at once.
    """

    def __init__(self, spark, path, checkpoint, key="dup_key", poll="200 milliseconds"):
        self.spark, self.path, self.checkpoint, self.key, self.poll = spark, path, checkpoint, key, poll
        self.schema = T.StructType([T.StructField(key, T.BinaryType()), T.StructField(BATCH, T.LongType())])

    def __enter__(self):
        self._files("mkdirs", f"{self.path}/asked")
        asked = (self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true")
                 .option("cleanSource", "delete").parquet(f"{self.path}/asked"))
        with settings(self.spark, STATE_SETTINGS):
            self.query = (asked.dropDuplicates([self.key]).writeStream.foreachBatch(self._answer)
                          .option("checkpointLocation", self.checkpoint).trigger(processingTime=self.poll).start())
        return self

    def __exit__(self, *_):
        self.query.stop()

    def _files(self, action, *paths):
        places = [self.spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
        return getattr(places[0].getFileSystem(self.spark._jsc.hadoopConfiguration()), action)(*places)

    def _answer(self, rows, _):
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(f"{self.path}/keys"))

    def new(self, rows, batch_id):
        """Keys of ``rows`` (distinct there) that no earlier batch brought."""
        question, answer = f"{self.path}/asked/{batch_id}", f"{self.path}/keys/{BATCH}={batch_id}"
        if not self._files("exists", question):
            # One more key, of the batch itself and always new, so that there is an answer without new keys too.
            mark = self.spark.range(1).select(F.encode(F.lit(f"batch {batch_id}"), "UTF-8").alias(self.key))
            asked = rows.select(self.key).unionByName(mark).withColumn(BATCH, F.lit(batch_id).cast("long"))
            # Moved in whole, as the query would take single files of an unfinished question for all of it.
            asked.write.mode("overwrite").parquet(f"{self.path}/staged/{batch_id}")
            if not self._files("rename", f"{self.path}/staged/{batch_id}", question):
                raise OSError(f"cannot move the keys of batch {batch_id} to {question}")
        # A trigger that had looked at the folder just before may end the wait too early, hence the loop.
        while not self._files("exists", answer):
            self.query.processAllAvailable()
            if not self.query.isActive:
                raise RuntimeError("the key index stopped") from self.query.exception()
        return self.spark.read.schema(self.schema[:1]).parquet(answer)


def seen_keys(spark, path, key="dup_key"):
    """All keys an index has answered for with the batch that brought each, empty before the first."""
    schema = T.StructType([T.StructField(key, T.BinaryType()), T.StructField(BATCH, T.LongType())])
    try:
        table = spark.read.schema(schema).parquet(f"{path}/keys")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return table.where(F.col(key) != F.encode(F.concat(F.lit("batch "), F.col(BATCH).cast("string")), "UTF-8"))
