"""Region-grain tables: long daily series and the marts over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.functions.numbers import ratio
from wattmill.functions.taxonomy import group_of, renewable_flag
from wattmill.functions.units import sum_of, to_mart_factor
from wattmill.operators.latest import latest_by
from wattmill.operators.quality import DEMAND_RULES, SERIES_RULES, apply_rules
from wattmill.sources.landing import fetch_time
from wattmill.sources.payloads import stats_points
from wattmill.sources.tables import conform


SERIES_KEYS = ["series_id", "network_region", "fueltech_id", "metric", "nem_date"]
SERIES_SEQUENCE = ["ingested_at", "source_id"]


def fetched_points(raw: DataFrame, demand: bool) -> DataFrame:
    """Dated values of the stats files, sequenced by fetch time. Narrow, for batch and stream."""
    return stats_points(raw.withColumn("ingested_at", fetch_time()), demand)


def _latest_points(raw: DataFrame, demand: bool, rules) -> DataFrame:
    """One point per series and day: a re-fetched file replaces, never adds."""
    kept, _ = apply_rules(fetched_points(raw, demand), rules)
    return latest_by(kept, SERIES_KEYS, SERIES_SEQUENCE)


def with_groups(points: DataFrame) -> DataFrame:
    """The long generation table over the latest points."""
    group = group_of(F.col("fueltech_id"))
    grouped = points.select(
        "nem_date",
        "network_region",
        "fueltech_id",
        group.alias("fueltech_group"),
        renewable_flag(group).alias("is_renewable"),
        "metric",
        F.col("value").alias("generated"),
        "uom",
    )
    return conform(grouped, "generation_daily_by_fueltech")


def as_demand(points: DataFrame) -> DataFrame:
    """The demand table over the latest points."""
    return conform(points.select("nem_date", "network_region", "metric", "value", "uom"), "demand_daily")


def generation_daily_by_fueltech(raw: DataFrame) -> DataFrame:
    return with_groups(_latest_points(raw, False, SERIES_RULES))


def demand_daily(raw: DataFrame) -> DataFrame:
    return as_demand(_latest_points(raw, True, DEMAND_RULES))


def _mart_value(value: str) -> Column:
    return F.col(value) * to_mart_factor(F.col("metric"), F.col("uom"))


def generation_daily_wide(series: DataFrame) -> DataFrame:
    """Metrics side by side, energy in MWh. Conditional sums: one partial aggregate, one small shuffle."""
    value = _mart_value("generated")
    wide = series.groupBy("nem_date", "network_region", "fueltech_id", "fueltech_group", "is_renewable").agg(
        sum_of("energy", value).alias("generated_mwh"),
        sum_of("emissions", value).alias("emissions_tco2e"),
        sum_of("market_value", value).alias("market_value_aud"),
    )
    return conform(wide, "generation_daily_wide")


def generation_mix_daily(wide: DataFrame) -> DataFrame:
    mix = wide.groupBy("nem_date", "network_region", "fueltech_group").agg(F.sum("generated_mwh").alias("generated_mwh"))
    return conform(mix, "generation_mix_daily")


def renewable_mwh(strict_nulls: bool = False) -> Column:
    """Summed renewable energy, 0 where there is none.

    By default it is also 0 where renewable rows exist but all are NULL. ``strict_nulls`` keeps those
    NULL and leaves 0 to days without any renewable row.
    """
    total = F.sum(F.when(F.col("is_renewable"), F.col("generated_mwh")))
    if not strict_nulls:
        return F.coalesce(total, F.lit(0.0))
    return F.when(F.count_if("is_renewable") == 0, F.lit(0.0)).otherwise(total)


def renewable_share_daily(wide: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """The total includes unmapped and negative rows, so a share may leave 0..1; it is not clipped."""
    days = wide.groupBy("nem_date", "network_region").agg(
        renewable_mwh(strict_nulls).alias("renewable_mwh"), F.sum("generated_mwh").alias("total_mwh")
    )
    share = days.withColumn("renewable_share", ratio(F.col("renewable_mwh"), F.col("total_mwh")))
    return conform(share, "renewable_share_daily")


def emissions_intensity_daily(wide: DataFrame) -> DataFrame:
    days = wide.groupBy("nem_date", "network_region").agg(
        F.sum("emissions_tco2e").alias("emissions_tco2e"), F.sum("generated_mwh").alias("generated_mwh")
    )
    intensity = ratio(F.col("emissions_tco2e"), F.col("generated_mwh"))
    return conform(
        days.withColumn("emissions_intensity_tco2e_per_mwh", intensity), "emissions_intensity_daily"
    )


def demand_vs_generation(demand: DataFrame, mix: DataFrame) -> DataFrame:
    """Region demand next to generation. Both sides are grouped by the join key, so the join adds no shuffle."""
    key = ["nem_date", "network_region"]
    used = demand.groupBy(*key).agg(sum_of("energy", _mart_value("value")).alias("demand_mwh"))
    made = mix.groupBy(*key).agg(F.sum("generated_mwh").alias("generated_mwh"))
    both = used.join(made, key, "full")
    return both.withColumn("generation_to_demand", ratio(F.col("generated_mwh"), F.col("demand_mwh")))
