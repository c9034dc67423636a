"""Fuel technology codes, their groups and the renewable flag, as JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fuel technology code and the group it belongs to.
FUELTECH_GROUPS = {
    "coal_black": "coal",
    "coal_brown": "coal",
    "gas_ccgt": "gas",
    "gas_ocgt": "gas",
    "gas_recip": "gas",
    "gas_steam": "gas",
    "gas_wcmg": "gas",
    "solar_rooftop": "solar",
    "solar_thermal": "solar",
    "solar_utility": "solar",
    "wind": "wind",
    "wind_offshore": "wind",
    "bioenergy_biogas": "bioenergy",
    "bioenergy_biomass": "bioenergy",
    "hydro": "hydro",
    "distillate": "distillate",
    "pumps": "pumps",
    "battery_charging": "battery_charging",
    "battery_discharging": "battery_discharging",
}

GROUPS = tuple(dict.fromkeys(FUELTECH_GROUPS.values()))

# Known codes that belong to no group.
UNGROUPED_FUELTECHS = ("nuclear", "imports", "exports", "interconnector", "aggregator_vpp", "aggregator_dr")

# The groups that count as renewable.
RENEWABLE_GROUPS = ("solar", "wind", "hydro", "bioenergy")


def group_of(code: Column) -> Column:
    """Group of a fuel technology code; NULL for a code without a group."""
    lookup = F.create_map(*[F.lit(item) for entry in FUELTECH_GROUPS.items() for item in entry])
    return F.try_element_at(lookup, code)


def renewable_flag(group: Column) -> Column:
    """TRUE or FALSE for a known group and NULL for no group: an unknown code is neither."""
    return group.isin(list(RENEWABLE_GROUPS))


def taxonomy_table(spark: SparkSession) -> DataFrame:
    """The code list as a 25-row table, for users who would rather join than map."""
    codes = spark.createDataFrame(
        [(c, FUELTECH_GROUPS.get(c)) for c in (*FUELTECH_GROUPS, *UNGROUPED_FUELTECHS)],
        "fueltech_id string, fueltech_group string",
    )
    return codes.withColumn("is_renewable", renewable_flag(F.col("fueltech_group")))
