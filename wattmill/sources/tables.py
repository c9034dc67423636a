"""Declared tables: columns, comments, writing and reading."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.sources import versions

LAYERS = ("bronze", "silver", "gold", "serving")

_DAY = "nem_date DATE COMMENT 'Market day, UTC+10 all year'"
_REGION = "network_region STRING COMMENT 'Region code: NSW1, QLD1, SA1, TAS1 or VIC1'"
_FACILITY = f"""
    facility_code STRING COMMENT 'Facility key; NULL collects points of units the registry does not list',
    facility_name STRING COMMENT 'Display name', {_REGION}, {_DAY}
"""

COLUMNS = {
    "raw_files": "raw_json STRING, source_file STRING, ingested_at TIMESTAMP",
    "dim_unit": """
        unit_code STRING, facility_code STRING, facility_name STRING, network_id STRING, network_region STRING,
        lat DOUBLE, lng DOUBLE, fueltech_id STRING, fueltech_group STRING, is_renewable BOOLEAN,
        status_id STRING, dispatch_type STRING, capacity_registered_mw DOUBLE, capacity_maximum_mw DOUBLE,
        emissions_factor_co2 DOUBLE
    """,
    "generation_daily_by_fueltech": """
        nem_date DATE, network_region STRING, fueltech_id STRING, fueltech_group STRING, is_renewable BOOLEAN,
        metric STRING, generated DOUBLE, uom STRING
    """,
    "demand_daily": "nem_date DATE, network_region STRING, metric STRING, value DOUBLE, uom STRING",
    "facility_generation": """
        unit_code STRING, interval_ts_utc TIMESTAMP, metric STRING, interval STRING, value DOUBLE, uom STRING,
        ingested_at TIMESTAMP
    """,
    "generation_daily_wide": """
        nem_date DATE, network_region STRING, fueltech_id STRING, fueltech_group STRING, is_renewable BOOLEAN,
        generated_mwh DOUBLE, emissions_tco2e DOUBLE, market_value_aud DOUBLE
    """,
    "generation_mix_daily": f"""
        {_DAY}, {_REGION},
        fueltech_group STRING COMMENT 'Technology group; NULL for codes without one',
        generated_mwh DOUBLE COMMENT 'Energy, MWh. NULL: nothing reported. Zero: measured zero'
    """,
    "renewable_share_daily": f"""
        {_DAY}, {_REGION},
        renewable_mwh DOUBLE COMMENT 'Energy of solar, wind, hydro and bioenergy, MWh; 0 where the day has none',
        total_mwh DOUBLE COMMENT 'Energy of all technologies, MWh, load included as negative',
        renewable_share DOUBLE COMMENT 'renewable_mwh over total_mwh; NULL without a total or with total 0'
    """,
    "emissions_intensity_daily": f"""
        {_DAY}, {_REGION},
        emissions_tco2e DOUBLE COMMENT 'Emissions of all technologies, t CO2e',
        generated_mwh DOUBLE COMMENT 'Energy of all technologies, MWh',
        emissions_intensity_tco2e_per_mwh DOUBLE COMMENT 'Summed emissions over summed energy'
    """,
    "facility_daily": f"""
        {_FACILITY},
        energy_mwh DOUBLE COMMENT 'Energy, MWh; below zero for load and charging',
        emissions_tco2e DOUBLE COMMENT 'Emissions, t CO2e',
        market_value_aud DOUBLE COMMENT 'Revenue, AUD; not a price'
    """,
    "facility_capacity_factor": f"""
        {_FACILITY},
        energy_mwh DOUBLE COMMENT 'Energy, MWh',
        capacity_registered_mw DOUBLE COMMENT 'Registered capacity of all units, MW',
        capacity_registered_mw_operating DOUBLE COMMENT 'Registered capacity of operating units, MW',
        capacity_factor DOUBLE COMMENT 'Energy over operating capacity times 24 h',
        capacity_factor_all_units DOUBLE COMMENT 'Energy over the capacity of all units times 24 h'
    """,
    "dim_facility": f"""
        facility_code STRING COMMENT 'Facility key', facility_name STRING COMMENT 'Display name', {_REGION},
        primary_fueltech_group STRING COMMENT 'Group with the most registered capacity, ties by name',
        fueltech_groups ARRAY<STRING> COMMENT 'All groups at the facility, sorted',
        is_renewable BOOLEAN COMMENT 'Whether the primary group is renewable',
        unit_count BIGINT COMMENT 'Distinct units, any status',
        capacity_registered_mw DOUBLE COMMENT 'Registered capacity of all units, MW',
        capacity_registered_mw_operating DOUBLE COMMENT 'Registered capacity of operating units, MW',
        lat DOUBLE COMMENT 'Latitude', lng DOUBLE COMMENT 'Longitude'
    """,
}

TABLE_COMMENTS = {
    "dim_unit": "Units of the newest registry snapshot, one network",
    "generation_daily_by_fueltech": "Daily series by region and technology, one row per metric",
    "demand_daily": "Daily demand series by region, one row per metric",
    "facility_generation": "Latest fetched value per unit, interval, instant and metric",
    "generation_mix_daily": "Energy by day, region and technology group",
    "renewable_share_daily": "Renewable part of the energy by day and region",
    "emissions_intensity_daily": "Emissions per energy by day and region",
    "facility_daily": "Energy, emissions and revenue by facility and day",
    "facility_capacity_factor": "Energy against registered capacity by facility and day",
    "dim_facility": "Facilities of the newest registry snapshot",
}


def declared(table: str) -> T.StructType:
    return T.StructType.fromDDL(re.sub(r"\s+", " ", COLUMNS[table]).strip())


def conform(df: DataFrame, table: str) -> DataFrame:
    """Bring ``df`` to the declared columns, order, types and comments; fails if it cannot.

    Missing columns are an error too: left to Spark they would turn up as NULL.
    """
    schema = declared(table)
    surplus, missing = set(df.columns) - set(schema.names), set(schema.names) - set(df.columns)
    if surplus or missing:
        raise ValueError(f"{table}: undeclared columns {sorted(surplus)}, missing columns {sorted(missing)}")
    return df.to(schema)


def write_table(df: DataFrame, root: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Store ``df`` as the next version of a table and return the stored copy.

    ``order_by`` range-partitions and sorts the files, so that a filter on the leading columns reads
    only the files and row groups that hold them. Give it enough columns to split a hot leading value.
    Readers keep the previous version until this one is complete.
    """
    spark = df.sparkSession
    number = versions.current(spark, root).number + 1
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    folder = f"data/table_version={number}"
    df.write.mode("overwrite").parquet(f"{root}/{folder}")
    versions.commit(spark, root, versions.Version(number, live=versions.whole(folder, df.schema)))
    return read_table(spark, root, df.schema)


def read_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return versions.read(spark, root, schema, versions.current(spark, root).folders())


def create_namespaces(spark: SparkSession, layers: Sequence[str] = LAYERS, base: str | None = None) -> None:
    for layer in layers:
        location = f" LOCATION '{base.rstrip('/')}/{layer}'" if base else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{location}")


def save_to_catalog(df: DataFrame, layer: str, table: str) -> None:
    """Declared columns and comments as a catalog table."""
    conform(df, table).write.mode("overwrite").format("parquet").saveAsTable(f"{layer}.{table}")
    if table in TABLE_COMMENTS:
        df.sparkSession.sql(f"COMMENT ON TABLE {layer}.{table} IS '{TABLE_COMMENTS[table]}'")


def flatten_for_serving(df: DataFrame) -> DataFrame:
    """Columns a plain relational or CSV sink can hold: arrays, maps and structs as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields]
    )


def export_csv(df: DataFrame, path: str) -> None:
    """Header and quoted fields, a quote inside a field doubled. One file per partition, written in parallel."""
    writer = flatten_for_serving(df).write.mode("overwrite").option("header", True)
    writer.option("quote", '"').option("escape", '"').csv(path)
