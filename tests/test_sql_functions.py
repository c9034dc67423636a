import datetime as dt

from conftest import SF_DIR

from wattmill.operators import metrics
from wattmill.plans import sql_functions
from wattmill.plans.marts import StarMarts
from wattmill.sources.tables import write_table


def test_functions_equal_the_dataframe_form(spark, rows):
    marts = StarMarts(spark, SF_DIR)
    sql_functions.register(spark, marts)
    first, last = dt.date(1996, 3, 1), dt.date(1999, 8, 31)
    got = spark.sql("SELECT * FROM capacity_factor_between('F3', DATE'1996-03-01', DATE'1999-08-31')")
    assert rows(got) == rows(metrics.facility_capacity_factor_between(marts.facility_capacity_factor, "F3", first, last))
    mix = spark.sql("SELECT fueltech_group, round(total_mwh, 6) FROM region_mix(region => 'SA1', first => DATE'1996-03-01', last => DATE'1999-08-31')")
    assert rows(mix) == rows(metrics.region_mix(marts.generation_mix_daily, "SA1", first, last).selectExpr("fueltech_group", "round(total_mwh, 6)"))
    # joins, laterals and aggregates over them are plain SQL
    each = spark.sql(
        "SELECT r.region, sum(m.total_mwh) AS t FROM VALUES ('SA1'), ('TAS1') AS r(region), "
        "LATERAL region_mix(r.region, DATE'1996-01-01', DATE'1996-12-31') AS m GROUP BY r.region"
    )
    year = marts.generation_mix_daily.where("year(nem_date) = 1996 AND network_region IN ('SA1', 'TAS1')")
    want = {r.network_region: r.t for r in year.groupBy("network_region").agg({"generated_mwh": "sum"}).toDF("network_region", "t").collect()}
    assert {r.region: round(r.t, 6) for r in each.collect()} == {k: round(v, 6) for k, v in want.items()}


def test_a_parameter_reaches_the_scan(spark, tmp_path):
    marts = StarMarts(spark, SF_DIR)
    marts.generation_mix_daily = write_table(marts.generation_mix_daily, str(tmp_path / "mix"))
    sql_functions.register(spark, marts)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = spark.sql("SELECT * FROM region_mix('SA1', DATE'1996-03-01', DATE'1999-08-31')")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(network_region,SA1)" in plan and "GreaterThanOrEqual(nem_date,1996-03-01)" in plan


def test_parts_serve_any_coarser_grain(spark, rows):
    wide = StarMarts(spark, SF_DIR).generation_daily_wide
    parts = metrics.measure_parts(wide)
    # stored in two pieces, as if a month had been added later
    parts = parts.where("month < DATE'1997-06-01'").unionByName(parts.where("month >= DATE'1997-06-01'"))
    names = list(metrics.MEASURES)
    rounded = lambda df: rows(df.selectExpr(*[c if c not in names else f"round({c}, 6) AS {c}" for c in df.columns]))
    for dims in ([], ["network_region"], ["fueltech_group"], ["network_region", "fueltech_group"]):
        assert rounded(metrics.roll_up(parts, names, dims)) == rounded(metrics.measure(wide, names, dims))
