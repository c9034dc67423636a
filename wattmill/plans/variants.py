"""Other wordings of the question bank: pattern matches, truncated dates, ranks over aggregates.

People and tools phrase the same question in these forms; each keeps its own answer's shape. A rank
that only keeps the best rows is a top-k with ties, so nothing is ordered in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattmill.functions.calendar import as_date
from wattmill.functions.numbers import ratio
from wattmill.plans.questions import days_of_rank


def record_day_by_rank(m, as_of) -> DataFrame:
    """Record days of a region found by code prefix, ties included."""
    days = m.renewable_share_daily.where(F.col("network_region").like("QLD%"))
    return days_of_rank(days.select("nem_date", "network_region", "total_mwh"), "total_mwh")


def best_day_in_sixty_months(m, as_of) -> DataFrame:
    """Best share of a region found by part of its name, back to the same day five years ago."""
    recent = F.col("nem_date") >= F.add_months(as_date(as_of), -60)
    days = m.renewable_share_daily.where(F.col("network_region").ilike("%tas%") & recent)
    return days_of_rank(days.select("nem_date", "network_region", "renewable_share"), "renewable_share")


def intensity_by_truncated_year(m, as_of) -> DataFrame:
    """Yearly mean intensity, the year given as its first day."""
    rows = m.emissions_intensity_daily.where(F.lower("network_region").like("%qld%"))
    rows = rows.where("nem_date >= DATE'1997-01-01' AND nem_date <= DATE'2001-12-31'")
    rows = rows.where(F.col("emissions_intensity_tco2e_per_mwh").isNotNull())
    by_year = rows.groupBy(F.trunc("nem_date", "YEAR").alias("calendar_year"))
    return by_year.agg(F.avg("emissions_intensity_tco2e_per_mwh").alias("avg_intensity")).orderBy("calendar_year")


def wind_leader(m, as_of) -> DataFrame:
    """The region with the most wind energy between the starts of last year and of this one."""
    this_year = F.trunc(as_date(as_of), "YEAR")
    day = F.col("nem_date")
    rows = m.generation_mix_daily.where(F.col("fueltech_group").ilike("%wind%"))
    rows = rows.where((day >= F.add_months(this_year, -12)) & (day < this_year))
    return days_of_rank(rows.groupBy("network_region").agg(F.sum("generated_mwh").alias("wind_mwh")), "wind_mwh")


def region_count_and_set(m, as_of) -> DataFrame:
    """How many regions there are and which, in one row."""
    regions = m.generation_mix_daily.where(F.col("network_region").isNotNull())
    return regions.agg(
        F.count_distinct("network_region").alias("region_count"),
        F.sort_array(F.collect_set("network_region")).alias("region_codes"),
    )


def coal_share_percent(m, as_of) -> DataFrame:
    """Coal's share by year in percent."""
    coal = F.when(F.col("fueltech_group").ilike("%coal%"), F.col("generated_mwh")).otherwise(0.0)
    rows = m.generation_mix_daily.where(F.col("network_region").ilike("%VIC%"))
    sums = rows.groupBy(F.year("nem_date").alias("yr")).agg(
        F.sum(coal).alias("coal_mwh"), F.sum("generated_mwh").alias("total_mwh")
    )
    return sums.withColumn("coal_share_percent", 100 * ratio(F.col("coal_mwh"), F.col("total_mwh"))).orderBy("yr")


def lowest_factors_of_the_last_month(m, as_of) -> DataFrame:
    """Lowest mean capacity factors in the 30 days up to the mart's own last day."""
    last = m.facility_capacity_factor.agg(F.max("nem_date")).scalar()
    rows = m.facility_capacity_factor.where(F.col("nem_date").between(F.date_sub(last, 29), last))
    means = rows.groupBy("facility_code", "facility_name").agg(
        F.count("capacity_factor").alias("days_with_data"), F.avg("capacity_factor").alias("avg_capacity_factor")
    )
    enough = means.where((F.col("days_with_data") >= 5) & F.col("facility_code").isNotNull())
    return enough.orderBy("avg_capacity_factor", "facility_code").limit(5)


VARIANTS = (
    record_day_by_rank,
    best_day_in_sixty_months,
    intensity_by_truncated_year,
    wind_leader,
    region_count_and_set,
    coal_share_percent,
    lowest_factors_of_the_last_month,
)
