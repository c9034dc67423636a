"""Session settings the library relies on."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # "interval=1d" in a path must stay text; type inference reads it as the double 1.0
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(app_name: str = "wattmill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above. Cluster sizing stays with the caller (``extra``)."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_settings(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session someone else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# One shuffle partition for this much input. Packed files unfold to many times their size, and a task sorts its partition in memory.
INPUT_PER_PARTITION = 32 * 1024**2


def size_shuffles(spark: SparkSession, path: str, most: int | None = None, per: int | None = None) -> int:
    """Start shuffles with partitions to match the input below ``path``; AQE joins the small ones again.

    A fixed number either drowns small inputs in tasks or makes partitions of a large one too big to
    hold. Never goes below the session's own ``spark.sql.shuffle.partitions``, and above ``most`` only if
    that is larger. ``per`` is the input of one partition, where not all of it is shuffled. A session without a JVM at hand (Spark Connect) keeps its own number.
    """
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not hasattr(spark, "_jvm"):
        return number
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    wanted = files.getContentSummary(hadoop_path).getLength() // (per or INPUT_PER_PARTITION)
    number = max(number, wanted if most is None else min(wanted, most))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(number))
    return number


# A task reads this much of the files at most. Packed columns unfold to some forty times their size as points, which a task then sorts.
SCAN_BYTES = 16 * 1024**2


def size_scans(spark: SparkSession) -> None:
    """Cut files into pieces whose rows a task can sort in memory; a session that asks for smaller ones keeps them."""
    if hasattr(spark, "_jvm") and spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > SCAN_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SCAN_BYTES))


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"session time zone must be UTC, found {zone}")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    On a cluster every executor has its own /tmp, so a session without ``spark.checkpoint.dir`` gets a
    folder there only in local mode.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master or 'the cluster'} share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a function that writes a table below ``shared_dir`` and returns the written copy. The copies go at the end."""
    paths: list[str] = []

    def stored(df: DataFrame, name: str) -> DataFrame:
        paths.append(shared_dir(spark, name))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield stored
    finally:
        if hasattr(spark, "_jvm"):
            for path in paths:
                hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
                hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session options for what starts inside; the session's own come back at the end."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def cores(spark: SparkSession) -> int:
    """Tasks that run at a time, as far as the session can tell."""
    return spark.sparkContext.defaultParallelism if hasattr(spark, "_jvm") else int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def shuffles_dropped(spark: SparkSession, rows_per_task: int, bytes_per_task: int) -> Iterator[Callable[[int], None]]:
    """For jobs that run inside: shuffle files go when their job ends, and tasks hold no more than they can in memory.

    Gives a function to tell how many rows the next jobs shuffle. The session's own settings come back at the end.
    """
    number, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    own = int(spark.conf.get(number, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    bounded = spark.conf.get(size)
    if hasattr(spark, "_jvm"):
        bounded = str(min(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(bounded), bytes_per_task))

    def expect(rows: int) -> None:
        spark.conf.set(number, str(max(own, rows // rows_per_task)))

    with settings(spark, {number: str(own), size: bounded, "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield expect
