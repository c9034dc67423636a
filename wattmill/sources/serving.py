"""Checked snapshots of marts for lookups, and the lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.operators.quality import any_null, pk_violations
from wattmill.session import shared_dir
from wattmill.sources import versions
from wattmill.sources.tables import flatten_for_serving


class DuplicateKeys(ValueError):
    pass


def keyed_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a complete key; a serving key is NOT NULL, so others have no place there."""
    return df.where(~any_null(keys))


def publish_snapshot(df: DataFrame, root: str, keys: Sequence[str], as_json: bool = False) -> dict:
    """Replace the published copy of a mart, or leave it as it was if keys repeat.

    The mart runs once, into a scratch table that also yields the counts. From there it is laid out in
    ranges of the sorted key, so that a lookup opens the one or two files whose statistics cover it, with a
    Bloom filter for each key column, so that a key that is not there opens no row group at all;
    sampling the ranges and checking the key read the key columns of the scratch table only.
    ``as_json`` stores nested columns as JSON text.
    """
    spark = df.sparkSession
    if as_json:
        df = flatten_for_serving(df)
    number = versions.current(spark, root).number + 1
    counts = Observation(f"publish-{number}")
    scratch = shared_dir(spark, "publish")
    df.observe(
        counts, F.count(F.lit(1)).alias("source_rows"), F.count_if(any_null(keys)).alias("null_key_rows")
    ).write.parquet(scratch)
    keyed = keyed_rows(spark.read.schema(df.schema).parquet(scratch), keys)
    if not pk_violations(keyed, keys).isEmpty():
        raise DuplicateKeys(f"{root}: {', '.join(keys)} is not unique; the published copy is unchanged")
    folder = f"data/table_version={number}"
    laid_out = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    with_key_filters(laid_out, keys).mode("overwrite").parquet(f"{root}/{folder}")
    report = dict(counts.get)
    report["copy_rows"] = versions.read(spark, root, df.schema, [versions.Folder(folder)]).count()
    report["ok"] = report["copy_rows"] == report["source_rows"] - report["null_key_rows"]
    if not report["ok"]:
        raise ValueError(f"{root}: {report}; the published copy is unchanged")
    versions.commit(spark, root, versions.Version(number, live=versions.whole(folder, df.schema)))
    return report


def with_key_filters(df: DataFrame, keys: Sequence[str]) -> DataFrameWriter:
    """A writer whose files hold a Bloom filter for each text or whole-number key, as large as its distinct values need."""
    writer = df.write.option("parquet.bloom.filter.adaptive.enabled", True)
    for key in keys:
        if isinstance(df.schema[key].dataType, (T.StringType, T.LongType, T.IntegerType)):
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", True)
    return writer


def snapshot_to_jdbc(df: DataFrame, url: str, table: str, keys: Sequence[str], properties: dict[str, str]) -> None:
    """The same snapshot into a relational table; keys are checked before anything is replaced."""
    keyed = keyed_rows(df, keys)
    if not pk_violations(keyed, keys).isEmpty():
        raise DuplicateKeys(f"{table}: {', '.join(keys)} is not unique")
    flatten_for_serving(keyed).write.mode("overwrite").option("truncate", True).jdbc(url, table, properties=properties)


def lookup(snapshot: DataFrame, **key) -> DataFrame:
    for column, value in key.items():
        snapshot = snapshot.where(F.col(column) == F.lit(value))
    return snapshot


def last_rows(snapshot: DataFrame, n: int = 7, day: str = "nem_date", **key) -> DataFrame:
    """The latest n rows of one key: a top-n, not a sort."""
    return lookup(snapshot, **key).orderBy(F.desc_nulls_last(day)).limit(n)


def last_rows_each(snapshot: DataFrame, keys: Sequence[str], n: int = 7, day: str = "nem_date") -> DataFrame:
    """The latest n rows of every key. Spark keeps n rows per key before the shuffle already."""
    newest_first = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(day))
    return snapshot.withColumn("rn", F.row_number().over(newest_first)).where(F.col("rn") <= n).drop("rn")


def containing(snapshot: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose array holds the value; a copy that stores arrays as JSON text is read as such."""
    stored = snapshot.schema[column].dataType
    array = F.from_json(column, "array<string>") if isinstance(stored, T.StringType) else F.col(column)
    return snapshot.where(F.array_contains(array, value))
