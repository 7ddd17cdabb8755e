"""What streams do, batch by batch, from Spark's own progress reports."""
import json
import threading
from collections import deque

from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = T.StructType([
    T.StructField("query_id", T.StringType()), T.StructField("run_id", T.StringType()), T.StructField("batch", T.LongType()),
    T.StructField("input_rows", T.LongType()), T.StructField("seconds", T.DoubleType()), T.StructField("rows_per_sec", T.DoubleType()),
    T.StructField("state_rows", T.LongType()), T.StructField("state_updated", T.LongType()), T.StructField("state_late", T.LongType()),
    T.StructField("watermark", T.StringType()), T.StructField("observed", T.StringType())])


class ProgressLog(StreamingQueryListener):
    """A row per batch of the queries run while it is attached (``with ProgressLog(spark) as log``).

    ``observed`` holds the numbers of ``DataFrame.observe`` in the stream as JSON. A batch that is repeated after a failure
    reports again; the later report replaces the earlier one. At most ``keep`` batches are held, the latest ones; ``on_row`` gets
    each as it comes, so that a long-running stream can send them on.
    """

    def __init__(self, spark, keep=10_000, on_row=None):
        self.spark, self.on_row, self.held, self.ended, self.news = spark, on_row, deque(maxlen=keep), set(), threading.Condition()

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_):
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        seconds = p.batchDuration / 1000
        states = p.stateOperators
        row = (str(p.id), str(p.runId), p.batchId, p.numInputRows, seconds, p.numInputRows / seconds if seconds else None,
               sum(s.numRowsTotal for s in states), sum(s.numRowsUpdated for s in states),
               sum(s.numRowsDroppedByWatermark for s in states), (p.eventTime or {}).get("watermark"),
               json.dumps({name: r.asDict() for name, r in p.observedMetrics.items()}, sort_keys=True, default=str))
        with self.news:
            self.held.append(row)
        if self.on_row:
            self.on_row(row)

    def onQueryTerminated(self, event):
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()

    def finished(self, query, timeout=60):
        """Wait until all reports of a query that has ended are in."""
        with self.news:
            if not self.news.wait_for(lambda: str(query.runId) in self.ended, timeout):
                raise TimeoutError(f"no end of query {query.id} was reported")

    def rows(self, query=None):
        """The latest report of each batch, of one query or of all."""
        with self.news:
            found = {(r[0], r[2]): r for r in self.held if query is None or r[0] == str(query.id)}
        return [found[k] for k in sorted(found)]

    def table(self, query=None):
        return self.spark.createDataFrame(self.rows(query), PROGRESS_SCHEMA)
