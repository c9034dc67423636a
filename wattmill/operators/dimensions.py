"""Unit and facility dimensions, from the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.functions.taxonomy import GROUPS, group_of, renewable_flag
from wattmill.operators.quality import UNIT_RULES, apply_rules, pk_violations
from wattmill.sources.landing import newest_snapshot
from wattmill.sources.payloads import REGISTRY, parse, registry_units
from wattmill.sources.tables import conform


def unit_rows(raw: DataFrame, network: str = "NEM") -> DataFrame:
    """Units of one network in the newest registry fetch, before any rule."""
    units = registry_units(newest_snapshot(raw)).where(F.col("network_id") == network)
    group = group_of(F.col("unit.fueltech_id"))
    return units.select(
        F.col("unit.code").alias("unit_code"),
        "facility_code",
        "facility_name",
        "network_id",
        "network_region",
        "lat",
        "lng",
        "unit.fueltech_id",
        group.alias("fueltech_group"),
        renewable_flag(group).alias("is_renewable"),
        "unit.status_id",
        "unit.dispatch_type",
        F.col("unit.capacity_registered").alias("capacity_registered_mw"),
        F.col("unit.capacity_maximum").alias("capacity_maximum_mw"),
        "unit.emissions_factor_co2",
    )


def dim_unit(raw: DataFrame, network: str = "NEM") -> DataFrame:
    """One row per unit, so that neither capacity nor the facts that join it can count double."""
    kept, _ = apply_rules(unit_rows(raw, network), UNIT_RULES)
    return conform(once_each(kept), "dim_unit")


def units_listed_twice(raw: DataFrame, network: str = "NEM") -> DataFrame:
    """Registry rows of units that the newest fetch lists more than once, of which ``dim_unit`` keeps one."""
    kept, _ = apply_rules(unit_rows(raw, network), UNIT_RULES)
    twice = pk_violations(kept, ["unit_code"]).select("unit_code")
    return kept.join(twice, "unit_code")


def registry_codes(raw: DataFrame, network: str = "NEM") -> DataFrame:
    """Sorted facility codes of the newest registry fetch, also of facilities without units."""
    facility = parse(newest_snapshot(raw), REGISTRY).where(F.col("item.network_id") == network)
    return facility.select(F.col("item.code").alias("facility_code")).distinct().orderBy("facility_code")


def once_each(units: DataFrame) -> DataFrame:
    """One row per unit: where the registry lists a unit twice, the one first by facility, and then by the other columns.

    ``units_listed_twice`` lists such units.
    """
    rest = [c for c in units.columns if c not in ("unit_code", "facility_code")]
    first = units.groupBy("unit_code").agg(F.min(F.struct("facility_code", *rest)).alias("unit"))
    return first.select(*[F.col(c) if c == "unit_code" else F.col(f"unit.{c}").alias(c) for c in units.columns])


def operating(capacity: Column) -> Column:
    return F.when(F.col("status_id") == "operating", capacity)


def facility_capacity(units: DataFrame) -> DataFrame:
    """Registered capacity by facility, of all units and of operating ones (NULL when none operates)."""
    capacity = F.col("capacity_registered_mw")
    return units.groupBy("facility_code").agg(
        F.sum(capacity).alias("capacity_registered_mw"),
        F.sum(operating(capacity)).alias("capacity_registered_mw_operating"),
    )


def dim_facility(units: DataFrame) -> DataFrame:
    """One row per facility, in one grouping and without a self-join.

    The groups are a fixed short list, so the capacity of each is a conditional sum. The smallest
    (no capacity, minus capacity, name) among the groups present is the primary one. Distinct units
    are counted by Spark's two-step distinct, which spreads a facility with very many units.

    Name, region and position come from the unit with the smallest code that has one, so that the
    same registry always gives the same row and a code never splits in two.
    """
    capacity = F.col("capacity_registered_mw")

    def contender(group: str) -> Column:
        member = F.col("fueltech_group") == group
        total = F.sum(F.when(member, capacity))
        entry = F.struct(total.isNull().alias("unknown"), (-total).alias("less"), F.lit(group).alias("name"))
        return F.when(F.count_if(member) > 0, entry)

    def of_first_unit(column: str) -> Column:
        return F.min(F.when(F.col(column).isNotNull(), F.struct("unit_code", column)))[column].alias(column)

    rolled = units.groupBy("facility_code").agg(
        of_first_unit("facility_name"),
        of_first_unit("network_region"),
        F.array_min(F.array(*map(contender, GROUPS)))["name"].alias("primary_fueltech_group"),
        F.sort_array(F.collect_set("fueltech_group")).alias("fueltech_groups"),
        F.count_distinct("unit_code").alias("unit_count"),
        F.sum(capacity).alias("capacity_registered_mw"),
        F.sum(operating(capacity)).alias("capacity_registered_mw_operating"),
        of_first_unit("lat"),
        of_first_unit("lng"),
    )
    return conform(
        rolled.withColumn("is_renewable", renewable_flag(F.col("primary_fueltech_group"))), "dim_facility"
    )
