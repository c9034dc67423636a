import datetime as dt

from wattmill.operators import dimensions, facility_marts, latest, metrics, region_marts
from wattmill.plans.marts import StarMarts
from wattmill.sources import star
from wattmill.sources.tables import conform

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
WIDE = "nem_date date, network_region string, fueltech_id string, fueltech_group string, is_renewable boolean, generated_mwh double, emissions_tco2e double, market_value_aud double"


def wide(spark, *lines):
    return spark.createDataFrame([(d, "SA1", f, g, r, e, x, None) for d, f, g, r, e, x in lines], WIDE)


def test_sum_of_nulls_is_null_and_zero_stays_zero(spark, rows):
    w = wide(spark, (D1, "wind", "wind", True, None, None), (D1, "wind_offshore", "wind", True, None, 0.0), (D2, "wind", "wind", True, 0.0, None))
    assert rows(region_marts.generation_mix_daily(w), "nem_date", "generated_mwh") == [(D1, None), (D2, 0.0)]
    assert rows(region_marts.emissions_intensity_daily(w), "nem_date", "emissions_tco2e", "generated_mwh", "emissions_intensity_tco2e_per_mwh") == [
        (D1, 0.0, None, None),
        (D2, None, 0.0, None),
    ]


def test_unmapped_group_is_kept(spark, rows):
    w = wide(spark, (D1, "nuclear", None, None, 5.0, None), (D1, "exports", None, None, -2.0, None))
    assert rows(region_marts.generation_mix_daily(w), "fueltech_group", "generated_mwh") == [(None, 3.0)]


def test_renewable_share(spark, rows):
    d3, d4 = dt.date(2024, 1, 3), dt.date(2024, 1, 4)
    w = wide(
        spark,
        (D1, "wind", "wind", True, 30.0, None), (D1, "coal_black", "coal", False, 70.0, None), (D1, "nuclear", None, None, 100.0, None),
        (D2, "coal_black", "coal", False, 10.0, None),
        (d3, "wind", "wind", True, None, None), (d3, "coal_black", "coal", False, 10.0, None),
        (d4, "wind", "wind", True, 5.0, None), (d4, "battery_charging", "battery_charging", False, -5.0, None),
    )
    assert rows(region_marts.renewable_share_daily(w), "nem_date", "renewable_mwh", "total_mwh", "renewable_share") == [
        (D1, 30.0, 200.0, 0.15),
        (D2, 0.0, 10.0, 0.0),
        (d3, 0.0, 10.0, 0.0),
        (d4, 5.0, 0.0, None),
    ]
    strict = region_marts.renewable_share_daily(w, strict_nulls=True)
    assert rows(strict, "renewable_mwh") == sorted([(30.0,), (0.0,), (None,), (5.0,)], key=lambda r: [(v is not None, str(v)) for v in r])


def test_ratios_divide_sums(spark):
    w = wide(spark, (D1, "coal_black", "coal", False, 100.0, 90.0), (D1, "wind", "wind", True, 300.0, 0.0), (D2, "wind", "wind", True, 600.0, 10.0))
    total = metrics.measure(w, ["renewable_share", "emissions_intensity_tco2e_per_mwh", "total_generated_mwh"]).first()
    assert (total.renewable_share, total.emissions_intensity_tco2e_per_mwh, total.total_generated_mwh) == (0.9, 0.1, 1000.0)
    daily = region_marts.renewable_share_daily(w).agg({"renewable_share": "avg"}).first()[0]
    assert daily == (0.75 + 1.0) / 2  # the mean of the days is another number


UNIT = "unit_code string, facility_code string, facility_name string, network_region string, fueltech_group string, status_id string, capacity_registered_mw double, lat double, lng double"


def units(spark, *lines):
    df = spark.createDataFrame(list(lines), UNIT)
    extra = {c: "CAST(NULL AS STRING)" for c in ("network_id", "fueltech_id", "dispatch_type")}
    numbers = {c: "CAST(NULL AS DOUBLE)" for c in ("capacity_maximum_mw", "emissions_factor_co2")}
    df = df.selectExpr("*", *[f"{e} AS {c}" for c, e in {**extra, **numbers}.items()], "CAST(NULL AS BOOLEAN) AS is_renewable")
    return conform(df, "dim_unit")


def test_dim_facility(spark, rows):
    df = units(
        spark,
        ("U1", "F1", "Alpha", "SA1", "wind", "operating", 100.0, None, None),
        ("U2", "F1", "Alpha", "SA1", "battery_charging", "operating", 100.0, -33.0, 138.0),
        ("U3", "F1", "Alpha", "SA1", None, "retired", 900.0, -34.0, 139.0),
        ("U4", "F2", "Beta", "VIC1", "coal", "retired", 500.0, None, None),
        ("U5", "F3", "Gamma", "NSW1", None, "operating", 5.0, None, None),
        ("U6", "F4", "Delta", "NSW1", "solar", "operating", None, None, None),
        ("U7", "F4", "Delta", "NSW1", "hydro", "operating", -1.0, None, None),
        ("U8", "F5", "Echo", "QLD1", "hydro", "committed", None, None, None),
        ("U9", "F5", "Echo (new)", "QLD1", "wind", "committed", None, None, None),
        ("U9", "F5", "Echo (new)", "QLD1", "hydro", "committed", None, None, None),
    )
    columns = ("facility_code", "facility_name", "primary_fueltech_group", "is_renewable", "unit_count", "capacity_registered_mw", "capacity_registered_mw_operating", "lat")
    dim = dimensions.dim_facility(df)
    assert rows(dim, *columns) == [
        ("F1", "Alpha", "battery_charging", False, 3, 1100.0, 200.0, -33.0),
        ("F2", "Beta", "coal", False, 1, 500.0, None, None),
        ("F3", "Gamma", None, None, 1, 5.0, 5.0, None),
        ("F4", "Delta", "hydro", True, 2, -1.0, -1.0, None),
        ("F5", "Echo", "hydro", True, 2, None, None, None),
    ]
    assert {r.facility_code: r.fueltech_groups for r in dim.collect()} == {
        "F1": ["battery_charging", "wind"], "F2": ["coal"], "F3": [], "F4": ["hydro", "solar"], "F5": ["hydro", "wind"],
    }


POINT = "unit_code string, interval_ts_utc timestamp, metric string, interval string, value double, uom string, ingested_at timestamp"


def test_facility_marts(spark, rows):
    at, late = dt.datetime(2023, 12, 31, 14), dt.datetime(2024, 1, 1, 13, 55)
    lines = [
        ("U1", at, "energy", "1d", 1200.0), ("U2", at, "energy", "1d", -200.0), ("U1", at, "emissions", "1d", None),
        ("U1", late, "energy", "5m", 9999.0), ("U4", at, "energy", "1d", 24.0), ("U9", at, "energy", "1d", 7.0),
        ("U1", late, "market_value", "1d", 3.0), ("U1", at, "power", "1d", 5.0),
    ]
    points = spark.createDataFrame([(*p, "MWh", at) for p in lines], POINT)
    df = units(
        spark,
        ("U1", "F1", "Alpha", "SA1", "wind", "operating", 100.0, None, None),
        ("U2", "F1", "Alpha", "SA1", "battery_charging", "committed", 100.0, None, None),
        ("U4", "F2", "Beta", "VIC1", "coal", "retired", 500.0, None, None),
    )
    daily = facility_marts.facility_daily(points, df)
    assert rows(daily, "facility_code", "nem_date", "energy_mwh", "emissions_tco2e", "market_value_aud") == [
        (None, D1, 7.0, None, None),
        ("F1", D1, 1000.0, None, 3.0),
        ("F2", D1, 24.0, None, None),
    ]
    factor = facility_marts.facility_capacity_factor(daily, df)
    assert rows(factor, "facility_code", "capacity_factor", "capacity_factor_all_units") == [
        (None, None, None),
        ("F1", 1000.0 / 2400.0, 1000.0 / 4800.0),
        ("F2", None, 24.0 / 12000.0),
    ]
    lost = facility_marts.unattributed_days(daily).first()
    assert (lost.days, lost.energy_mwh) == (1, 7.0)


def test_facility_days_of_fetches(spark, rows):
    """Metrics side by side up to the sum give the days of the points unfolded: late fetches, ties, other metrics, units and intervals, NULLs and rejected rows included."""
    at, late, noon = dt.datetime(2023, 12, 31, 14), dt.datetime(2024, 1, 1, 13, 55), dt.datetime(2024, 1, 5)
    lines = [
        ("U1", at, "energy", "1d", 1.2, "GWh", noon), ("U1", at, "energy", "1d", 9.0, "MWh", at), ("U1", late, "energy", "1d", 3.0, "MWh", at),
        ("U1", at, "emissions", "1d", 4.0, "t", at), ("U1", at, "emissions", "1d", None, "t", noon), ("U1", at, "energy", "5m", 99.0, "MWh", noon),
        ("U2", at, "market_value", "1d", 5.0, "AUD", None), ("U2", at, "market_value", "1d", 6.0, "AUD", None), ("U3", at, "power", "1d", 7.0, "MW", at),
        ("U9", at, "energy", "1d", 8.0, "MWh", at), ("U2", at, "energy", "1d", 8.0, "TJ", at), ("U2", None, "energy", "1d", 8.0, "MWh", at),
        (None, at, "energy", "1d", 8.0, "MWh", at), ("U2", at, None, "1d", 8.0, "MWh", at), ("U2", late, "energy", None, 8.0, "MWh", at),
    ]
    points = spark.createDataFrame(lines, POINT)
    df = units(spark, *[(f"U{i}", f"F{i}", f"Name {i}", "SA1", "wind", "operating", 100.0, None, None) for i in (1, 2, 3, 2)])
    found = facility_marts.facility_daily_of_fetches(points, df)
    assert rows(found, "facility_code", "nem_date", "energy_mwh", "emissions_tco2e", "market_value_aud") == [
        (None, D1, 8.0, None, None),
        ("F1", D1, 1203.0, None, None),
        ("F2", D1, None, None, 12.0),
        ("F3", D1, None, None, None),
    ]
    assert rows(found) == rows(facility_marts.facility_daily(facility_marts.facility_generation(points), df))


def test_facility_days_of_fetches_side_by_side(spark, rows):
    """Fetches with their metrics in a row give the days of the same points unfolded, whatever a fetch lacks, repeats or breaks."""
    at, late, noon = dt.datetime(2023, 12, 31, 14), dt.datetime(2024, 1, 1, 13, 55), dt.datetime(2024, 1, 5)
    fetches = [
        ("U1", at, "1d", at, (9.0, "MWh"), (4.0, "t"), None, []), ("U1", at, "1d", noon, (1.2, "GWh"), (None, None), None, None),
        ("U1", late, "1d", at, (3.0, "MWh"), None, None, []), ("U1", at, "5m", noon, (99.0, "MWh"), None, None, []),
        ("U2", at, "1d", None, (8.0, "TJ"), None, (5.0, "AUD"), []), ("U2", at, "1d", None, None, None, (6.0, "AUD"), [("market_value", 7.0, "AUD")]),
        ("U2", None, "1d", at, (8.0, "MWh"), None, None, []), (None, at, "1d", at, (8.0, "MWh"), None, None, []), ("U2", late, None, at, (8.0, "MWh"), None, None, []),
        ("U3", at, "1d", at, None, None, None, [("power", 7.0, "MW"), (None, 1.0, "MW")]), ("U4", at, "1d", at, (8.0, None), None, None, [("energy", 2.0, "TJ"), None]),
        ("U9", at, "1d", at, None, None, None, [("energy", 8.0, "MWh"), ("energy", 0.5, "GWh"), ("energy", None, "MWh")]),
    ]
    point = "struct<value: double, uom: string>"
    schema = f"unit_code string, interval_ts_utc timestamp, interval string, ingested_at timestamp, energy {point}, emissions {point}, market_value {point}, points array<struct<metric: string, value: double, uom: string>>"
    lines = [
        (u, t, m, i, v, uom, f)
        for u, t, i, f, e, em, mv, ps in fetches
        for m, v, uom in [*[(m, *p) for m, p in zip(facility_marts.METRICS, (e, em, mv)) if p], *[p for p in ps or [] if p]]
    ]
    points = spark.createDataFrame(lines, POINT)
    df = units(spark, *[(f"U{i}", f"F{i}", f"Name {i}", "SA1", "wind", "operating", 100.0, None, None) for i in (1, 2, 3, 4)])
    found = facility_marts.facility_daily_of_rows(spark.createDataFrame(fetches, schema), df)
    assert rows(found, "facility_code", "nem_date", "energy_mwh", "emissions_tco2e", "market_value_aud") == [
        (None, D1, 8.0, None, None),
        ("F1", D1, 1203.0, None, None),
        ("F2", D1, None, None, 7.0),
        ("F3", D1, None, None, None),
    ]
    assert rows(found) == rows(facility_marts.facility_daily_of_fetches(points, df))


def test_facility_days_sort_a_row_per_fetch(spark):
    """The first aggregation sorts what a fetch holds side by side: no more rows than there are line items."""
    from conftest import SF_DIR

    fetches = star.unit_fetches(spark, SF_DIR).where("interval = '1d'")
    names = facility_marts.METRICS
    assert latest.rows_of_fetches(fetches, "metric", names, "points").count() == spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    plan = StarMarts(spark, SF_DIR).facility_daily._jdf.queryExecution().optimizedPlan().toString()
    assert "(metric#" not in plan  # as in MAX(CASE WHEN metric = ...) over a row for each metric


def test_facility_days_meet_their_units_in_one_row_per_unit_and_day(spark):
    from conftest import SF_DIR

    plan = StarMarts(spark, SF_DIR).facility_daily._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1  # the points of the source are not unfolded again after the newest are found


def test_demand_next_to_generation(spark, rows):
    demand = spark.createDataFrame([(D1, "SA1", "energy", 2.0, "GWh"), (D1, "SA1", "market_value", 9.0, "AUD")], "nem_date date, network_region string, metric string, value double, uom string")
    mix = spark.createDataFrame([(D1, "SA1", "wind", 500.0), (D1, "SA1", None, 500.0), (D2, "SA1", "wind", 1.0)], "nem_date date, network_region string, fueltech_group string, generated_mwh double")
    assert rows(region_marts.demand_vs_generation(demand, mix), "nem_date", "demand_mwh", "generated_mwh", "generation_to_demand") == [
        (D1, 2000.0, 1000.0, 0.5),
        (D2, None, 1.0, None),
    ]


def test_marts_agree_with_each_other(spark):
    from conftest import SF_DIR

    m = StarMarts(spark, SF_DIR)
    by_day = m.generation_mix_daily.groupBy("nem_date", "network_region").agg({"generated_mwh": "sum"}).toDF("nem_date", "network_region", "s")
    joined = m.renewable_share_daily.join(by_day, ["nem_date", "network_region"], "full")
    assert joined.where("NOT (abs(s - total_mwh) < 1e-6 OR (s IS NULL AND total_mwh IS NULL))").isEmpty()
    cf = m.facility_capacity_factor
    assert cf.where("abs(capacity_factor * capacity_registered_mw_operating * 24 - energy_mwh) > 1e-6").isEmpty()
    assert cf.where("capacity_factor IS NOT NULL").count() > 0


def test_plausibility(spark):
    """Shares and intensities stay in range wherever no load is involved, and factors mostly below one."""
    from conftest import SF_DIR

    m = StarMarts(spark, SF_DIR)
    loads = m.generation_daily_wide.where("generated_mwh < 0").select("nem_date", "network_region").distinct()
    key = ["nem_date", "network_region"]
    assert m.renewable_share_daily.join(loads, key, "left_anti").where("renewable_share NOT BETWEEN 0 AND 1").isEmpty()
    assert m.emissions_intensity_daily.join(loads, key, "left_anti").where("emissions_intensity_tco2e_per_mwh < 0").isEmpty()
    both = m.facility_capacity_factor.where("capacity_factor IS NOT NULL AND energy_mwh > 0")
    assert both.where("capacity_factor < capacity_factor_all_units").isEmpty()
