"""Counters of stream rules, kept as a table."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

COUNTERS = "query STRING, batch BIGINT, observation STRING, counter STRING, n BIGINT"


class CounterTable(StreamingQueryListener):
    """Writes what streams observe (``df.observe(name, ...)``) to a table: a row per query, batch and counter.

    Use it as a context around the streams: ``with CounterTable(spark, root) as counters: ...``. Every batch
    overwrites a folder of its own, so a batch that is run again after a crash is counted once. Batches
    without rows report nothing new and are skipped. A batch is a handful of numbers.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.failed: Exception | None = None
        # the listener's thread and ``catch_up`` may bring the same batch
        self.lock, self.seen = threading.Lock(), set()

    def __enter__(self) -> CounterTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)
        if self.failed and not exc[0]:
            raise self.failed

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            self.write(event.progress)
        except Exception as error:  # a listener's error would only be logged; the caller shall see it
            self.failed = error

    def write(self, progress) -> None:
        query = str(progress.id)
        with self.lock:
            if (progress.runId, progress.batchId) not in self.seen:
                self._write(query, progress)
                self.seen.add((progress.runId, progress.batchId))

    def _write(self, query: str, progress) -> None:
        rows = [
            (query, progress.batchId, name, counter, int(n))
            for name, row in progress.observedMetrics.items()
            for counter, n in row.asDict().items()
            if n is not None
        ]
        if rows:
            target = f"{self.root}/stream={query}/number={progress.batchId}"
            self.spark.createDataFrame(rows, COUNTERS).coalesce(1).write.mode("overwrite").parquet(target)

    def catch_up(self, query: StreamingQuery) -> None:
        """Events reach listeners some time after a query has ended; what it remembers itself is written here."""
        for progress in query.recentProgress:
            self.write(progress)

    def read(self) -> DataFrame:
        return self.spark.read.schema(COUNTERS).option("recursiveFileLookup", True).parquet(self.root)


def rule_totals(counters: DataFrame, observation: str, total: str = "rows") -> DataFrame:
    """Passed and failed rows of every rule over all batches, from counters of broken rows beside a counter of all."""
    seen = counters.where(F.col("observation") == observation)
    sums = seen.groupBy("counter").agg(F.sum("n").alias("failed"))
    rows = sums.where(F.col("counter") == total).select("failed").scalar()
    rules = sums.where(F.col("counter") != total)
    return rules.select(F.col("counter").alias("rule"), (rows - F.col("failed")).alias("passed"), "failed")
