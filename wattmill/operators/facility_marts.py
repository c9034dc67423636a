"""Facility-grain tables: unit points and the daily marts over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattmill.functions.calendar import market_date
from wattmill.functions.numbers import ratio
from wattmill.functions.units import METRICS, to_mart_factor
from wattmill.operators.dimensions import facility_capacity
from wattmill.operators.latest import latest_abreast, newest_abreast, newest_of_rows, rows_of_fetches
from wattmill.operators.quality import POINT_RULES, apply_rules, kept_abreast
from wattmill.sources.tables import conform

# The interval belongs to the key: a daily and a five-minute point can share an instant.
POINT_KEYS = ["unit_code", "interval", "interval_ts_utc", "metric"]
POINT_SEQUENCE = ["ingested_at", "source_id"]


def facility_generation(points: DataFrame) -> DataFrame:
    """Latest fetched value of each point; the batch twin of the streaming upsert.

    The metrics of the marts come in the same fetch, so they cross the shuffle in one row for each unit and instant.
    """
    kept, _ = apply_rules(points, POINT_RULES)
    seq = [c for c in POINT_SEQUENCE if c in kept.columns]
    columns = ["unit_code", "interval_ts_utc", "metric", "interval", "value", "uom", "ingested_at"]
    return conform(latest_abreast(kept, POINT_KEYS, seq, "metric", METRICS).select(*columns), "facility_generation")


def facility_daily(generation: DataFrame, units: DataFrame) -> DataFrame:
    """Daily totals by facility, from daily points only."""
    value = F.col("value") * to_mart_factor(F.col("metric"), F.col("uom"))
    daily = generation.where(F.col("interval") == "1d").select(
        "unit_code", market_date(F.col("interval_ts_utc")).alias("nem_date"), *[F.when(F.col("metric") == m, value).alias(m) for m in METRICS]
    )
    return _totals(daily, units)


def facility_daily_of_fetches(points: DataFrame, units: DataFrame) -> DataFrame:
    """``facility_daily`` of all fetched points: the newest values of a unit and instant stay in one row until they are summed."""
    kept, _ = apply_rules(points.where(F.col("interval") == "1d").drop("interval"), POINT_RULES)
    keys, seq = [c for c in POINT_KEYS if c != "interval"], [c for c in POINT_SEQUENCE if c in kept.columns]
    return _totals(_days(newest_abreast(kept, keys, seq, "metric", METRICS)), units)


def facility_daily_of_rows(fetches: DataFrame, units: DataFrame) -> DataFrame:
    """``facility_daily`` of fetches that hold the metrics of a unit and instant side by side, as ``star.unit_fetches`` gives them.

    A task sorts the fetches as they are, where unfolded points are three times as many rows, and spill.
    """
    rows = rows_of_fetches(fetches.where(F.col("interval") == "1d").drop("interval"), "metric", METRICS, "points")
    names = {**{m: F.lit(m) for m in METRICS}, "other": F.col("other_metric")}
    kept = kept_abreast(rows, POINT_RULES, names, list(names), "metric")
    keys, seq = [c for c in POINT_KEYS if c not in ("interval", "metric")], [c for c in POINT_SEQUENCE if c in kept.columns]
    return _totals(_days(newest_of_rows(kept, keys, seq, "metric", METRICS)), units)


def _days(newest: DataFrame) -> DataFrame:
    """Newest values side by side, in the units of the marts, by market day."""
    return newest.select(
        "unit_code",
        market_date(F.col("interval_ts_utc")).alias("nem_date"),
        *[(F.col(f"newest_{i}.value") * to_mart_factor(F.lit(m), F.col(f"newest_{i}.uom"))).alias(m) for i, m in enumerate(METRICS)],
    )


def _totals(daily: DataFrame, units: DataFrame) -> DataFrame:
    """Sums by facility and day of rows with a unit, a day and a column for each metric; a sum is NULL where all values are.

    Points of units missing in the registry gather in one row per day with a NULL facility.
    The join carries no broadcast hint: Spark broadcasts the units when their size, estimated or
    measured at run time, is below its threshold, and otherwise joins by shuffle with skew splitting.
    """
    names = units.select("unit_code", "facility_code", "facility_name", "network_region")
    totals = (
        daily.join(names, "unit_code", "left")
        .groupBy("facility_code", "facility_name", "network_region", "nem_date")
        .agg(
            F.sum("energy").alias("energy_mwh"),
            F.sum("emissions").alias("emissions_tco2e"),
            F.sum("market_value").alias("market_value_aud"),
        )
    )
    return conform(totals, "facility_daily")


def facility_capacity_factor(daily: DataFrame, units: DataFrame) -> DataFrame:
    joined = daily.join(facility_capacity(units), "facility_code", "left")
    energy = F.col("energy_mwh")
    factors = joined.select(
        "facility_code",
        "facility_name",
        "network_region",
        "nem_date",
        "energy_mwh",
        "capacity_registered_mw",
        "capacity_registered_mw_operating",
        ratio(energy, F.col("capacity_registered_mw_operating") * 24).alias("capacity_factor"),
        ratio(energy, F.col("capacity_registered_mw") * 24).alias("capacity_factor_all_units"),
    )
    return conform(factors, "facility_capacity_factor")


def unattributed_days(daily: DataFrame) -> DataFrame:
    """Size of the NULL-facility bucket: how many days, and how much energy no facility accounts for."""
    return daily.where(F.col("facility_code").isNull()).agg(
        F.count(F.lit(1)).alias("days"), F.sum("energy_mwh").alias("energy_mwh")
    )
