"""The question bank: each question is a function of the marts and of "today".

``m`` is anything with the gold tables as attributes. Rankings end in a unique column, so a limit
always cuts at the same row; NULL sorts last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.functions.calendar import in_last_days, in_last_full_year, in_years
from wattmill.functions.numbers import ratio
from wattmill.sources.serving import containing, last_rows, lookup

FACILITY = ["facility_code", "facility_name", "network_region"]


def _in(code: str) -> Column:
    return F.col("network_region") == code


def _of(group: str) -> Column:
    return F.col("fueltech_group") == group


def _year() -> Column:
    return F.year("nem_date").alias("yr")


def _mean(column: str, name: str) -> Column:
    return F.avg(column).alias(name)


def _mean_share() -> Column:
    return _mean("renewable_share", "avg_renewable_share")


def _mean_intensity() -> Column:
    return _mean("emissions_intensity_tco2e_per_mwh", "avg_intensity")


def _mean_factor() -> Column:
    return _mean("capacity_factor", "avg_capacity_factor")


def _known_factor() -> Column:
    return F.col("capacity_factor").isNotNull()


def _ranked(df: DataFrame, by: Column, *ties: str, limit: int | None = None) -> DataFrame:
    ordered = df.orderBy(by, *[F.asc_nulls_last(t) for t in ties])
    return ordered if limit is None else ordered.limit(limit)


def _most(df: DataFrame, column: str, *ties: str, limit: int | None = None) -> DataFrame:
    return _ranked(df, F.desc_nulls_last(column), *ties, limit=limit)


def _least(df: DataFrame, column: str, *ties: str, limit: int | None = None) -> DataFrame:
    return _ranked(df, F.asc_nulls_last(column), *ties, limit=limit)


# --- technology mix ------------------------------------------------------------------------------


def _mix_last_year(m, as_of, code: str) -> DataFrame:
    rows = m.generation_mix_daily.where(_in(code) & in_last_full_year("nem_date", as_of))
    totals = rows.groupBy("fueltech_group").agg(F.sum("generated_mwh").alias("total_mwh"))
    return _most(totals, "total_mwh", "fueltech_group")


def q01(m, as_of) -> DataFrame:
    """Generation by technology group in one region, last calendar year."""
    return _mix_last_year(m, as_of, "NSW1")


def q02(m, as_of) -> DataFrame:
    """Regions by wind generation, last calendar year."""
    rows = m.generation_mix_daily.where(_of("wind") & in_last_full_year("nem_date", as_of))
    totals = rows.groupBy("network_region").agg(F.sum("generated_mwh").alias("wind_mwh"))
    return _most(totals, "wind_mwh", "network_region")


def q03(m, as_of, first: int = 2000, last: int = 2024) -> DataFrame:
    """Coal's share of a region's generation in two years."""
    either = in_years("nem_date", first, first) | in_years("nem_date", last, last)
    rows = m.generation_mix_daily.where(_in("VIC1") & either)
    coal = F.when(_of("coal"), F.col("generated_mwh")).otherwise(0.0)
    sums = rows.groupBy(_year()).agg(F.sum(coal).alias("coal_mwh"), F.sum("generated_mwh").alias("total_mwh"))
    return sums.withColumn("coal_share", ratio(F.col("coal_mwh"), F.col("total_mwh"))).orderBy("yr")


def q04(m, as_of) -> DataFrame:
    """As the first question, for a region people call by name."""
    return _mix_last_year(m, as_of, "SA1")


def q18(m, as_of) -> DataFrame:
    """Which regions there are."""
    return m.generation_mix_daily.select("network_region").distinct().orderBy(F.asc_nulls_last("network_region"))


def q19(m, as_of) -> DataFrame:
    """Record day of a region."""
    days = m.generation_mix_daily.where(_in("QLD1")).groupBy("nem_date").agg(F.sum("generated_mwh").alias("total_mwh"))
    return _most(days, "total_mwh", "nem_date", limit=1)


def q20(m, as_of) -> DataFrame:
    """Days on which a group of a region was a net load, last 90 days."""
    rows = m.generation_mix_daily.where(_in("NSW1") & in_last_days("nem_date", as_of, 90) & (F.col("generated_mwh") < 0))
    return rows.select("nem_date", "fueltech_group", "generated_mwh").orderBy("nem_date", F.asc_nulls_last("fueltech_group"))


# --- renewable share -----------------------------------------------------------------------------


def q05(m, as_of) -> DataFrame:
    """Mean daily renewable share by region, last calendar year."""
    rows = m.renewable_share_daily.where(in_last_full_year("nem_date", as_of))
    return _most(rows.groupBy("network_region").agg(_mean_share()), "avg_renewable_share", "network_region")


def q06(m, as_of) -> DataFrame:
    """Best day of a region in five years."""
    share = F.col("renewable_share")
    rows = m.renewable_share_daily.where(_in("TAS1") & in_last_days("nem_date", as_of, 1825) & share.isNotNull())
    return _most(rows.select("nem_date", "renewable_share"), "renewable_share", "nem_date", limit=1)


def q07(m, as_of, first: int = 2015, last: int = 2024) -> DataFrame:
    """Mean share of a region by year."""
    rows = m.renewable_share_daily.where(_in("SA1") & in_years("nem_date", first, last))
    return rows.groupBy(_year()).agg(_mean_share()).orderBy("yr")


def q16(m, as_of) -> DataFrame:
    """Mean share of a region over the days the facility data covers.

    The two bounds are scalar subqueries, so the long history is cut by a plain date filter.
    """
    covered = m.facility_daily
    first, last = covered.agg(F.min("nem_date")).scalar(), covered.agg(F.max("nem_date")).scalar()
    return m.renewable_share_daily.where(_in("SA1") & F.col("nem_date").between(first, last)).agg(_mean_share())


# --- emissions -----------------------------------------------------------------------------------


def q08(m, as_of) -> DataFrame:
    """Regions from the lowest mean intensity, last calendar year."""
    rows = m.emissions_intensity_daily.where(in_last_full_year("nem_date", as_of))
    return _least(rows.groupBy("network_region").agg(_mean_intensity()), "avg_intensity", "network_region")


def q09(m, as_of, first: int = 2019, last: int = 2024) -> DataFrame:
    """Mean intensity of a region by year."""
    rows = m.emissions_intensity_daily.where(_in("QLD1") & in_years("nem_date", first, last))
    return rows.groupBy(_year()).agg(_mean_intensity()).orderBy("yr")


# --- facilities ----------------------------------------------------------------------------------


def q10(m, as_of) -> DataFrame:
    """Top facilities by energy, last 30 days."""
    rows = m.facility_daily.where(in_last_days("nem_date", as_of, 30))
    return _most(rows.groupBy(*FACILITY).agg(F.sum("energy_mwh").alias("total_mwh")), "total_mwh", "facility_code", limit=10)


def q11(m, as_of) -> DataFrame:
    """Top facilities by revenue, last 90 days."""
    rows = m.facility_daily.where(in_last_days("nem_date", as_of, 90))
    totals = rows.groupBy(*FACILITY).agg(F.sum("market_value_aud").alias("total_market_value_aud"))
    return _most(totals, "total_market_value_aud", "facility_code", limit=10)


def q12(m, as_of) -> DataFrame:
    """All facilities of a region by energy, last 30 days."""
    rows = m.facility_daily.where(_in("NSW1") & in_last_days("nem_date", as_of, 30))
    totals = rows.groupBy("facility_code", "facility_name").agg(F.sum("energy_mwh").alias("total_mwh"))
    return _most(totals, "total_mwh", "facility_code")


def q13(m, as_of) -> DataFrame:
    """Top facilities by mean capacity factor, last 30 days."""
    rows = m.facility_capacity_factor.where(in_last_days("nem_date", as_of, 30) & _known_factor())
    return _most(rows.groupBy(*FACILITY).agg(_mean_factor()), "avg_capacity_factor", "facility_code", limit=10)


def q14(m, as_of) -> DataFrame:
    """Mean capacity factor by region, last 90 days."""
    rows = m.facility_capacity_factor.where(in_last_days("nem_date", as_of, 90) & _known_factor())
    return _most(rows.groupBy("network_region").agg(_mean_factor()), "avg_capacity_factor", "network_region")


def q15(m, as_of, min_days: int = 10) -> DataFrame:
    """Lowest mean capacity factors among facilities with enough days, last 30 days."""
    rows = m.facility_capacity_factor.where(in_last_days("nem_date", as_of, 30) & _known_factor())
    means = rows.groupBy(*FACILITY).agg(_mean_factor(), F.count(F.lit(1)).alias("days"))
    return _least(means.where(F.col("days") >= min_days), "avg_capacity_factor", "facility_code", limit=5)


def q17(m, as_of) -> DataFrame:
    """Revenue of a region's facilities, last 30 days."""
    return _revenue_last_30_days(m, as_of, "SA1")


def _revenue_last_30_days(m, as_of, code: str) -> DataFrame:
    rows = m.facility_daily.where(_in(code) & in_last_days("nem_date", as_of, 30))
    return rows.agg(F.sum("market_value_aud").alias("total_market_value_aud"))


# --- worked examples -----------------------------------------------------------------------------


def _with_technology(m, primary: str) -> DataFrame:
    """Capacity factors of the facilities of one technology, under the dimension's names."""
    chosen = m.dim_facility.where(F.col("primary_fueltech_group") == primary)
    factors = m.facility_capacity_factor.where(_known_factor())
    return factors.drop("facility_name").withColumnRenamed("network_region", "fact_region").join(
        chosen.select(*FACILITY), "facility_code"
    )


def e01(m, as_of) -> DataFrame:
    """Wind farms of a region by mean capacity factor, last 30 days."""
    rows = _with_technology(m, "wind").where((F.col("fact_region") == "SA1") & in_last_days("nem_date", as_of, 30))
    return _most(rows.groupBy("facility_code", "facility_name").agg(_mean_factor()), "avg_capacity_factor", "facility_code")


def e02(m, as_of) -> DataFrame:
    """Coal generation of a region by year."""
    rows = m.generation_mix_daily.where(_in("VIC1") & _of("coal"))
    return rows.groupBy(_year()).agg(F.sum("generated_mwh").alias("coal_mwh")).orderBy("yr")


def e03(m, as_of) -> DataFrame:
    """Mean share across regions, last calendar year."""
    return q05(m, as_of)


def e04(m, as_of) -> DataFrame:
    """Solar facilities by mean capacity factor, whole history."""
    rows = _with_technology(m, "solar")
    return _most(rows.groupBy(*FACILITY).agg(_mean_factor()), "avg_capacity_factor", "facility_code", limit=10)


def e05(m, as_of) -> DataFrame:
    """Mean share over the facility window."""
    return q16(m, as_of)


def e06(m, as_of, name: str = "Eraring") -> DataFrame:
    """Technologies of a facility found by name."""
    return lookup(m.dim_facility, facility_name=name).select(
        "facility_code", "facility_name", "primary_fueltech_group", "fueltech_groups", "unit_count"
    )


def e07(m, as_of) -> DataFrame:
    """Mix of a region, last calendar year."""
    return q01(m, as_of)


def e08(m, as_of) -> DataFrame:
    """Mean intensity of a region by year, last five years."""
    rows = m.emissions_intensity_daily.where(_in("QLD1") & in_last_days("nem_date", as_of, 1825))
    return rows.groupBy(_year()).agg(_mean_intensity()).orderBy("yr")


def e09(m, as_of) -> DataFrame:
    """Revenue of a region's facilities, last 30 days."""
    return _revenue_last_30_days(m, as_of, "VIC1")


def e10(m, as_of) -> DataFrame:
    """Latest days on which a facility was a net load."""
    rows = m.facility_daily.where((F.col("energy_mwh") < 0) & in_last_days("nem_date", as_of, 30))
    chosen = rows.select("facility_code", "facility_name", "nem_date", "energy_mwh")
    return chosen.orderBy(F.desc("nem_date"), F.asc_nulls_last("facility_code")).limit(20)


# --- lookups on the published copies -------------------------------------------------------------


def l0(m, as_of, n: int = 3) -> DataFrame:
    """Largest facilities by registered capacity."""
    columns = [*FACILITY, "primary_fueltech_group", "capacity_registered_mw"]
    return _most(m.dim_facility.select(*columns), "capacity_registered_mw", "facility_code", limit=n)


def l1(m, as_of, code: str = "ABC") -> DataFrame:
    """One facility by key."""
    return lookup(m.dim_facility, facility_code=code)


def l2(m, as_of, code: str = "ABC") -> DataFrame:
    """Latest seven days of a facility."""
    return last_rows(m.facility_capacity_factor, 7, facility_code=code).select("nem_date", "energy_mwh", "capacity_factor")


def l3(m, as_of, member: str = "battery_discharging", limit: int = 20) -> DataFrame:
    """Facilities that have a technology among their groups."""
    rows = containing(m.dim_facility, "fueltech_groups", member).select("facility_code", "facility_name", "fueltech_groups")
    return rows.orderBy("facility_name", "facility_code").limit(limit)


def l4(m, as_of, first: int = 2010, last: int = 2025) -> DataFrame:
    """A region's renewable share in two years, energy over energy."""
    either = in_years("nem_date", first, first) | in_years("nem_date", last, last)
    rows = m.renewable_share_daily.where(_in("SA1") & either)
    share = ratio(F.sum("renewable_mwh"), F.sum("total_mwh"))
    return rows.groupBy(_year()).agg(share.alias("renewable_share")).orderBy("yr")


def days_of_rank(days: DataFrame, measure: str, k: int = 1) -> DataFrame:
    """All rows whose measure ranks k or better, ties included, without ordering the whole set in one task.

    The k-th best value comes from a top-k, and the rows that reach it from a filter.
    """
    best = days.where(F.col(measure).isNotNull()).select(measure).orderBy(F.desc(measure)).limit(k)
    return days.where(F.col(measure) >= best.agg(F.min(measure)).scalar())


QUESTIONS = {
    name: fn for name, fn in list(globals().items()) if len(name) in (2, 3) and name[0] in "qel" and name[1:].isdigit()
}
