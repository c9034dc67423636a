"""The set of tables a question can draw on, built on demand."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from wattmill.operators import dimensions, facility_marts, region_marts
from wattmill.sources import star


class Marts:
    """Gold tables over the four silver ones. Every attribute is a lazy plan."""

    dim_unit: DataFrame
    generation_daily_by_fueltech: DataFrame
    facility_generation: DataFrame
    demand_daily: DataFrame

    @cached_property
    def generation_daily_wide(self) -> DataFrame:
        return region_marts.generation_daily_wide(self.generation_daily_by_fueltech)

    @cached_property
    def generation_mix_daily(self) -> DataFrame:
        return region_marts.generation_mix_daily(self.generation_daily_wide)

    @cached_property
    def renewable_share_daily(self) -> DataFrame:
        return region_marts.renewable_share_daily(self.generation_daily_wide)

    @cached_property
    def emissions_intensity_daily(self) -> DataFrame:
        return region_marts.emissions_intensity_daily(self.generation_daily_wide)

    @cached_property
    def facility_daily(self) -> DataFrame:
        return facility_marts.facility_daily(self.facility_generation, self.dim_unit)

    @cached_property
    def facility_capacity_factor(self) -> DataFrame:
        return facility_marts.facility_capacity_factor(self.facility_daily, self.dim_unit)

    @cached_property
    def dim_facility(self) -> DataFrame:
        return dimensions.dim_facility(self.dim_unit)

    @cached_property
    def demand_vs_generation(self) -> DataFrame:
        return region_marts.demand_vs_generation(self.demand_daily, self.generation_mix_daily)


class SilverMarts(Marts):
    """Marts over given silver tables."""

    def __init__(self, units: DataFrame, series: DataFrame, generation: DataFrame, demand: DataFrame):
        self.dim_unit = units
        self.generation_daily_by_fueltech = series
        self.facility_generation = generation
        self.demand_daily = demand


class StarMarts(Marts):
    """Marts over the bundled star-schema tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.source = (spark, sf_dir)

    @cached_property
    def dim_unit(self) -> DataFrame:
        return star.dim_unit(*self.source)

    @cached_property
    def generation_daily_by_fueltech(self) -> DataFrame:
        return star.generation_daily_by_fueltech(*self.source)

    @cached_property
    def facility_generation(self) -> DataFrame:
        return facility_marts.facility_generation(star.unit_points(*self.source))

    @cached_property
    def facility_daily(self) -> DataFrame:
        return facility_marts.facility_daily_of_rows(star.unit_fetches(*self.source), self.dim_unit)

    @cached_property
    def demand_daily(self) -> DataFrame:
        return star.demand_daily(*self.source)
