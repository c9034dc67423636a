"""Shapes of the three raw JSON payloads, and the step from files to rows.

Shapes are written out, never inferred: an unknown field is ignored and a new status or fuel code
is just a new string. A file that does not parse is kept in a quarantine, not lost in an explode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Field names of the payloads.
REGISTRY = """
    success BOOLEAN,
    data ARRAY<STRUCT<
        code: STRING, name: STRING, network_id: STRING, network_region: STRING,
        location: STRUCT<lat: DOUBLE, lng: DOUBLE>,
        units: ARRAY<STRUCT<
            code: STRING, fueltech_id: STRING, status_id: STRING, dispatch_type: STRING,
            capacity_registered: DOUBLE, capacity_maximum: DOUBLE, emissions_factor_co2: DOUBLE,
            commencement_date: STRING, expected_closure_date: STRING>>>>
"""

STATS = """
    type STRING, network STRING, region STRING,
    data ARRAY<STRUCT<
        id: STRING, type: STRING, fuel_tech: STRING, region: STRING, units: STRING,
        history: STRUCT<start: STRING, last: STRING, interval: STRING, data: ARRAY<DOUBLE>>>>
"""

# A point is a pair [time text, number]; as text it keeps both, and a short or odd pair stays readable.
UNIT_METRICS = """
    success BOOLEAN,
    data ARRAY<STRUCT<
        metric: STRING, unit: STRING, interval: STRING,
        results: ARRAY<STRUCT<
            name: STRING, columns: STRUCT<unit_code: STRING>, data: ARRAY<ARRAY<STRING>>>>>>
"""


def parse(raw: DataFrame, shape: str) -> DataFrame:
    """One row per element of the payload's ``data`` array, with the file it came from.

    The path shrinks to a number here: every point carries it as the tie-break of its fetch time, and
    a path is several times the size of a point. Narrow: no shuffle, on a stream as on a batch.
    """
    return raw.select(
        F.xxhash64("source_file").alias("source_id"),
        "ingested_at",
        F.explode(F.from_json("raw_json", shape)["data"]).alias("item"),
    )


def quarantine(raw: DataFrame, shape: str) -> DataFrame:
    """Files that ``parse`` yields nothing for because the text is no such payload."""
    return raw.where(F.from_json("raw_json", shape)["data"].isNull()).select(
        "source_file",
        "ingested_at",
        F.when(F.trim("raw_json") == "", "empty file").otherwise("no readable data array").alias("reason"),
        "raw_json",
    )


def registry_units(raw: DataFrame) -> DataFrame:
    """Unit rows of every registry file, all networks, source names kept short."""
    facility = parse(raw, REGISTRY).select("source_id", "ingested_at", "item.*")
    return facility.select(
        "source_id",
        "ingested_at",
        F.col("code").alias("facility_code"),
        F.col("name").alias("facility_name"),
        "network_id",
        "network_region",
        "location.lat",
        "location.lng",
        F.explode("units").alias("unit"),
    )


def stats_points(raw: DataFrame, demand: bool) -> DataFrame:
    """Dated values of the positional series: value i belongs to the start day plus i days.

    ``demand`` picks the region demand family; otherwise every family comes out, and the caller's
    rules reject those without a fuel technology. The family is chosen before the arrays unfold.
    """
    series = parse(raw, STATS).select("source_id", "ingested_at", "item.*")
    if demand:
        series = series.where(F.col("id").like("%.demand.%"))
    dated = series.select(
        "source_id",
        "ingested_at",
        F.col("id").alias("series_id"),
        F.col("type").alias("metric"),
        F.col("fuel_tech").alias("fueltech_id"),
        F.col("region").alias("network_region"),
        F.col("units").alias("uom"),
        # The first ten characters are the local day; the offset behind them must not shift it.
        F.substring("history.start", 1, 10).try_cast("date").alias("first_day"),
        F.posexplode("history.data").alias("offset", "value"),
    )
    return dated.withColumn("nem_date", F.date_add("first_day", F.col("offset"))).drop("first_day", "offset")


def empty_series(raw: DataFrame) -> DataFrame:
    """Series without any value, which unfold to no row at all; listed so that the loss is counted."""
    series = raw.select("source_file", F.explode(F.from_json("raw_json", STATS)["data"]).alias("item"))
    return series.where(F.coalesce(F.size("item.history.data"), F.lit(0)) <= 0).select(
        "source_file", F.col("item.id").alias("series_id"), F.col("item.type").alias("metric")
    )


def unit_points(raw: DataFrame) -> DataFrame:
    """One row per reported point of a unit. A bad time or number becomes NULL, never an error."""
    keep = ["source_id", "ingested_at", "metric", "uom", "interval"]
    block = parse(raw, UNIT_METRICS).select("source_id", "ingested_at", "item.*").withColumnRenamed("unit", "uom")
    result = block.select(*keep, F.explode("results").alias("result"))
    # Name the unit before its points unfold, so that no point drags the whole array along.
    unit = result.select(*keep, "result.columns.unit_code", F.col("result.data").alias("pairs"))
    point = unit.select(*keep, "unit_code", F.explode("pairs").alias("pair"))
    return point.select(
        "unit_code",
        F.get("pair", F.lit(0)).try_cast("timestamp").alias("interval_ts_utc"),
        "metric",
        "interval",
        F.get("pair", F.lit(1)).try_cast("double").alias("value"),
        "uom",
        "ingested_at",
        "source_id",
        F.get("pair", F.lit(1)).alias("value_text"),
    )
