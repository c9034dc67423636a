"""Landed files: reading them whole, decoding their paths, and auditing what is there.

Layout below a landing folder::

    facilities/fetched_at=<t>/part-000.json
    stats/region=<R>/year=<Y>/fetched_at=<t>/part-000.json
    facility_data/interval=<I>/chunk=<NNN>/fetched_at=<t>/part-000.json
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FETCHED_AT_FORMAT = "yyyy-MM-dd'T'HHmmssX"


def _raw_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("value").alias("raw_json"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("ingested_at"),
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path`` as one row: text, path and modification time."""
    return _raw_columns(spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path))


def stream_files(
    spark: SparkSession, path: str, max_files: int = 10_000, max_age: str = "36500d", archive: str | None = None
) -> DataFrame:
    """The same as a stream, each file once.

    ``max_files`` bounds a micro-batch. ``max_age`` is long because a gap that is filled later may
    bring files older than those already seen, which the default of a week would skip. ``archive``
    moves finished files out of the landing folder, which keeps its listing short over the years.
    """
    reader = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _raw_columns(reader.option("maxFilesPerTrigger", max_files).option("maxFileAge", max_age).load(path))


def path_key(name: str, path: Column | str = "source_file") -> Column:
    """Text of a ``name=value`` path segment, NULL when absent. Never inferred: 1d is not a number."""
    path = F.col(path) if isinstance(path, str) else path
    return F.nullif(F.regexp_extract(path, f"/{name}=([^/]+)/", 1), F.lit(""))


def fetch_time() -> Column:
    """When the source was asked, from the path; a copied file keeps it. Else the file's own time."""
    return F.coalesce(F.try_to_timestamp(path_key("fetched_at"), F.lit(FETCHED_AT_FORMAT)), F.col("ingested_at"))


def with_landing_keys(raw: DataFrame) -> DataFrame:
    return raw.select(
        "*",
        path_key("region").alias("region"),
        path_key("year").try_cast("int").alias("year"),
        path_key("interval").alias("interval"),
        path_key("chunk").alias("chunk"),
        fetch_time().alias("fetched_at"),
    )


def fetch_day() -> Column:
    """Day of the fetch as text, the partition of stored raw tables."""
    return fetch_time().cast("date").cast("string")


def newest_snapshot(raw: DataFrame) -> DataFrame:
    """Files of the most recent fetch.

    One fetch is one ``fetched_at`` folder, however many files it holds; a file outside such a
    folder is a fetch of its own. A raw table that is stored by ``fetch_day`` is read for the newest day alone: the day comes
    from the partitions' names, as a scalar subquery that prunes when the query runs, and the fetch from paths and times of that day's
    files. Without this partition paths and times of all files are read, and the texts are filtered behind the scan.
    """
    if "fetch_day" in raw.columns:
        newest_day = raw.agg(F.max("fetch_day")).scalar()
        raw = raw.where(F.col("fetch_day").eqNullSafe(newest_day))
    folder = F.regexp_extract("source_file", "^(.*/fetched_at=[^/]+)/", 1)
    fetch = F.struct(
        fetch_time().alias("at"), F.when(folder != "", folder).otherwise(F.col("source_file")).alias("name")
    )
    newest = raw.select(fetch.alias("fetch")).agg(F.max("fetch").alias("fetch"))
    return raw.where(fetch == newest.scalar())


def chunk_name(number: Column) -> Column:
    """At least three digits; a longer number keeps them all."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(3)), F.lit("0"))


def region_year_grid(spark: SparkSession, regions: Sequence[str], first_year: int | Column, last_year: int | Column) -> DataFrame:
    """Region-years a backfill asks for. Unfolds an array and a sequence; there is no cross join."""
    regions_only = spark.range(1).select(F.explode(F.array(*map(F.lit, regions))).alias("region"))
    return regions_only.select("region", F.explode(F.sequence(F.lit(first_year), F.lit(last_year)).cast("array<int>")).alias("year"))


def chunk_grid(codes: DataFrame, intervals: Sequence[str] = ("1d", "5m"), size: int = 30) -> DataFrame:
    """Interval-chunks a unit fetch asks for: facility codes in chunks of ``size``, once per interval."""
    last = codes.agg((F.ceil(F.count(F.lit(1)) / size) - 1).cast("int").alias("last")).where("last >= 0")
    chunks = last.select(F.explode(F.sequence(F.lit(0), F.col("last"))).alias("n"))
    return chunks.select(
        F.explode(F.array(*map(F.lit, intervals))).alias("interval"), chunk_name(F.col("n")).alias("chunk")
    )


def coverage_gaps(raw: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected fetches without a landed file; the columns of ``expected`` are landing keys.

    Landed files are reduced to distinct keys, from their paths alone, before they meet the grid.
    """
    landed = with_landing_keys(raw).select(*expected.columns).distinct()
    return expected.join(landed, expected.columns, "left_anti")
