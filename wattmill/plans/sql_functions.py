"""The parameterised answers as SQL table functions, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from wattmill.operators import metrics
from wattmill.plans.marts import Marts

# Tables that the functions read, as temporary views under their own names.
VIEWS = ("facility_capacity_factor", "generation_mix_daily", "measure_parts")

FUNCTIONS = {
    "capacity_factor_between": """
        (code STRING COMMENT 'Facility key', first DATE, last DATE)
        RETURNS TABLE (facility_code STRING, facility_name STRING, nem_date DATE, energy_mwh DOUBLE, capacity_factor DOUBLE,
                       capacity_factor_all_units DOUBLE)
        COMMENT 'Daily capacity factor of one facility over a closed date range'
        RETURN SELECT facility_code, facility_name, nem_date, energy_mwh, capacity_factor, capacity_factor_all_units
        FROM facility_capacity_factor WHERE facility_code = code AND nem_date BETWEEN first AND last
    """,
    "region_mix": """
        (region STRING COMMENT 'Region code', first DATE, last DATE)
        RETURNS TABLE (fueltech_group STRING, total_mwh DOUBLE)
        COMMENT 'Energy by technology group of one region over a closed date range'
        RETURN SELECT fueltech_group, sum(generated_mwh) AS total_mwh
        FROM generation_mix_daily WHERE network_region = region AND nem_date BETWEEN first AND last GROUP BY fueltech_group
    """,
    "region_measures": """
        (region STRING COMMENT 'Region code, NULL for all', first DATE COMMENT 'Any day of the first month', last DATE)
        RETURNS TABLE (network_region STRING, total_generated_mwh DOUBLE, renewable_share DOUBLE, emissions_intensity_tco2e_per_mwh DOUBLE)
        COMMENT 'The three measures by region over whole months, sums first and ratios last'
        RETURN SELECT network_region, sum(generated_mwh) AS total_generated_mwh,
            try_divide(coalesce(sum(renewable_rows_mwh), 0), sum(generated_mwh)) AS renewable_share,
            try_divide(sum(emissions_tco2e), sum(generated_mwh)) AS emissions_intensity_tco2e_per_mwh
        FROM measure_parts
        WHERE (region IS NULL OR network_region = region) AND month BETWEEN trunc(first, 'month') AND trunc(last, 'month')
        GROUP BY network_region
    """,
}


def register(spark: SparkSession, marts: Marts) -> None:
    """Create the views and functions in the session: ``SELECT * FROM region_mix('SA1', DATE'2024-01-01', DATE'2024-12-31')``.

    Function bodies are plain selects that Spark inlines, so a parameter becomes a filter that reaches the files.
    """
    frames = {
        "facility_capacity_factor": marts.facility_capacity_factor,
        "generation_mix_daily": marts.generation_mix_daily,
        "measure_parts": metrics.measure_parts(marts.generation_daily_wide),
    }
    for name in VIEWS:
        frames[name].createOrReplaceTempView(name)
    for name, definition in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {definition}")
