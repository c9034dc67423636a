"""Measures that hold at any grain: sums first, ratios last."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.functions.calendar import as_date
from wattmill.functions.numbers import ratio
from wattmill.operators.region_marts import renewable_mwh

# name -> aggregate expression over generation_daily_wide; a ratio divides two aggregates
MEASURES = {
    "total_generated_mwh": lambda: F.sum("generated_mwh"),
    "renewable_share": lambda: ratio(renewable_mwh(), F.sum("generated_mwh")),
    "emissions_intensity_tco2e_per_mwh": lambda: ratio(F.sum("emissions_tco2e"), F.sum("generated_mwh")),
}

# the same over facility_capacity_factor; days without energy or capacity weigh nothing
FACILITY_MEASURES = {
    "total_energy_mwh": lambda: F.sum("energy_mwh"),
    "weighted_capacity_factor": lambda: ratio(
        F.sum(F.when(F.col("capacity_factor").isNotNull(), F.col("energy_mwh"))),
        F.sum(F.when(F.col("capacity_factor").isNotNull(), F.col("capacity_registered_mw_operating") * 24)),
    ),
}


def measure(
    table: DataFrame, measures: Sequence[str], dims: Sequence[str | Column] = (), known: Mapping = MEASURES
) -> DataFrame:
    """The named measures by any dimensions of the table they are defined over (columns or expressions)."""
    unknown = [m for m in measures if m not in known]
    if unknown:
        raise ValueError(f"unknown measures {unknown}; known are {sorted(known)}")
    return table.groupBy(*dims).agg(*[known[m]().alias(m) for m in measures])


# What the measures are made of: sums over rows, which add up over any grain.
PARTS = {
    "generated_mwh": lambda: F.sum("generated_mwh"),
    "renewable_rows_mwh": lambda: F.sum(F.when(F.col("is_renewable"), F.col("generated_mwh"))),
    "emissions_tco2e": lambda: F.sum("emissions_tco2e"),
}

# the same measures over stored parts
FROM_PARTS = {
    "total_generated_mwh": lambda: F.sum("generated_mwh"),
    "renewable_share": lambda: ratio(F.coalesce(F.sum("renewable_rows_mwh"), F.lit(0.0)), F.sum("generated_mwh")),
    "emissions_intensity_tco2e_per_mwh": lambda: ratio(F.sum("emissions_tco2e"), F.sum("generated_mwh")),
}

FINE_GRAIN = ("network_region", "fueltech_group", "month")


def measure_parts(wide: DataFrame, grain: Sequence[str | Column] = FINE_GRAIN) -> DataFrame:
    """Sums by a fine grain, to be stored: one pass over the mart serves every question on coarser dimensions."""
    dated = wide.withColumn("month", F.trunc("nem_date", "month"))
    return dated.groupBy(*grain).agg(*[part().alias(name) for name, part in PARTS.items()])


def roll_up(parts: DataFrame, measures: Sequence[str], dims: Sequence[str | Column] = ()) -> DataFrame:
    """The named measures from stored parts, by any dimensions that the parts' grain holds: sums first, ratios last."""
    return measure(parts, measures, dims, FROM_PARTS)


def facility_capacity_factor_between(capacity_factor: DataFrame, facility_code: str, start, end) -> DataFrame:
    """Daily capacity factor of one facility over a closed date range."""
    chosen = capacity_factor.where(F.col("facility_code") == facility_code).where(
        F.col("nem_date").between(as_date(start), as_date(end))
    )
    return chosen.select(
        "facility_code", "facility_name", "nem_date", "energy_mwh", "capacity_factor", "capacity_factor_all_units"
    ).orderBy("nem_date")


def region_mix(mix: DataFrame, region: str, start, end) -> DataFrame:
    """Energy by group of one region over a closed date range."""
    chosen = mix.where(F.col("network_region") == region).where(F.col("nem_date").between(as_date(start), as_date(end)))
    totals = chosen.groupBy("fueltech_group").agg(F.sum("generated_mwh").alias("total_mwh"))
    return totals.orderBy(F.desc_nulls_last("total_mwh"), F.asc_nulls_last("fueltech_group"))
