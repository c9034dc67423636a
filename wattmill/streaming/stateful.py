"""Latest value per key as a stateful aggregation of the stream itself.

The newest row of every key is the state of a streaming aggregation, kept in RocksDB on the executors' disks and in the checkpoint;
a batch reads the state of the keys it brings and emits these keys alone (update mode). The table below follows with the rows
that changed, so what is written is a row per key and batch, however many versions of a key a batch holds.

``PointTable`` on its own folds whole batches in and keeps no state between them; it suits few large batches. The state
pays where batches are small and keys come again and again, or where a sink wants changes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.operators.latest import latest_by
from wattmill.operators.quality import apply_rules
from wattmill.streaming.upsert import UpsertTable, run_upsert

# Read when a query starts and then kept in its checkpoint.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a checkpoint holds the changes of a batch, not a copy of the whole state
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for a while, put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def newest(points: DataFrame, table: UpsertTable, event_time: str | None = None, lateness: str | None = None) -> DataFrame:
    """A stream of the newest row of each key. Rows that break a drop rule do not enter the state.

    Without ``lateness`` the state holds every key for good, since a correction may come at any time. With it, keys whose
    ``event_time`` (one of the keys) lies that far behind the newest one seen are forgotten, and rows
    that come later still are dropped and counted in the query's progress.
    """
    if "source_id" not in points.columns:
        points = points.withColumn("source_id", F.lit(None).cast("bigint"))
    # the counters of the rules are in the query's progress under "brought"
    kept, _ = apply_rules(points.withColumns(table.derived()), table.rules, observe_as="brought")
    if lateness:
        kept = kept.withWatermark(event_time, lateness)
    return latest_by(kept.select(*table.stored.names), table.keys, table.sequence)


def run_stateful(points: DataFrame, table: UpsertTable, checkpoint: str, event_time: str | None = None, lateness: str | None = None):
    """Drain a stream of points through the state into the table, then stop. Returns the finished query."""
    with settings(points.sparkSession, **STATE_STORE):
        return run_upsert(newest(points, table, event_time, lateness), table, checkpoint, mode="update")
