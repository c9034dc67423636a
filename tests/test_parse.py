import datetime as dt
import json

import samples
from pyspark.sql import functions as F

from wattmill.operators import dimensions, region_marts
from wattmill.operators.quality import POINT_RULES, SERIES_RULES, apply_rules, rule_counts
from wattmill.sources import landing, payloads
from wattmill.sources.tables import declared
from wattmill.streaming import ingest
from wattmill.streaming.upsert import points_of

D = dt.date


def test_registry_to_units(spark, rows):
    raw = samples.raw(spark, (samples.fetched(5, "facilities"), samples.REGISTRY))
    units = dimensions.dim_unit(raw)
    assert units.schema.names == declared("dim_unit").names
    assert rows(units, "unit_code", "facility_code", "fueltech_group", "is_renewable", "status_id") == [
        ("U1", "F1", "wind", True, "operating"),
        ("U2", "F1", "battery_charging", False, "operating"),
        ("U3", "F2", "coal", False, "retired"),
        ("U5", "F4", None, None, "commissioning"),
    ]
    kept, rejected = apply_rules(dimensions.unit_rows(raw), dimensions.UNIT_RULES)
    assert (kept.count(), rejected.count()) == (4, 1)
    assert rows(dimensions.registry_codes(raw)) == [("F1",), ("F2",), ("F4",), ("F5",)]


def _one_unit(code, mw):
    unit = {"code": code, "fueltech_id": "wind", "status_id": "operating", "capacity_registered": mw}
    return {"data": [{"code": "F", "name": "F", "network_id": "NEM", "network_region": "SA1", "units": [unit]}]}


def test_newest_fetch_wins_whatever_the_file_times(spark, rows):
    raw = samples.raw(
        spark,
        (samples.fetched(9, "facilities"), _one_unit("A", 2.0)),
        (samples.fetched(9, "facilities").replace("000", "001"), _one_unit("B", 3.0)),
        (samples.fetched(8, "facilities"), _one_unit("A", 1.0)),  # copied last, fetched first
    )
    assert rows(dimensions.dim_unit(raw), "unit_code", "capacity_registered_mw") == [("A", 2.0), ("B", 3.0)]


def test_without_fetch_folder_the_newest_file_wins(spark, rows):
    raw = samples.raw(spark, ("file:/x/a.json", _one_unit("A", 1.0)), ("file:/x/b.json", _one_unit("A", 2.0)))
    assert rows(dimensions.dim_unit(raw), "unit_code", "capacity_registered_mw") == [("A", 2.0)]


def test_stats_to_generation(spark, rows):
    raw = samples.raw(spark, (samples.fetched(5), samples.STATS))
    series = region_marts.generation_daily_by_fueltech(raw)
    assert rows(series.where("metric = 'energy'"), "nem_date", "generated", "uom") == [
        (D(2024, 1, 1), 1.5, "GWh"),
        (D(2024, 1, 2), None, "GWh"),
        (D(2024, 1, 3), 0.0, "GWh"),
        (D(2024, 1, 4), 2.0, "GWh"),
    ]
    wide = region_marts.generation_daily_wide(series)
    assert rows(wide, "nem_date", "generated_mwh", "emissions_tco2e") == [
        (D(2024, 1, 1), 1500.0, 0.0),
        (D(2024, 1, 2), None, None),
        (D(2024, 1, 3), 0.0, None),
        (D(2024, 1, 4), 2000.0, None),
    ]
    assert rows(region_marts.demand_daily(raw), "nem_date", "value") == [(D(2024, 1, 1), 30.0), (D(2024, 1, 2), 31.0)]


def test_every_lost_series_is_counted(spark, rows):
    raw = samples.raw(spark, (samples.fetched(5), samples.STATS))
    assert rows(payloads.empty_series(raw), "series_id") == [("au.nem.sa1.fuel_tech.hydro.energy",)]
    counts = {r.rule: (r.passed, r.failed) for r in rule_counts(payloads.stats_points(raw, False), SERIES_RULES).collect()}
    assert counts == {"valid_key": (5, 3), "known_energy_unit": (8, 0)}


def test_landing_twice_does_not_double(spark, rows):
    newer = {**samples.STATS, "data": [samples.series("au.nem.sa1.fuel_tech.wind.energy", "energy", "wind", "GWh", "2024-01-02", [4.0, None])]}
    raw = samples.raw(spark, (samples.fetched(7), newer), (samples.fetched(5), samples.STATS), (samples.fetched(6), samples.STATS))
    wide = region_marts.generation_daily_wide(region_marts.generation_daily_by_fueltech(raw))
    assert rows(wide, "nem_date", "generated_mwh") == [
        (D(2024, 1, 1), 1500.0),
        (D(2024, 1, 2), 4000.0),
        (D(2024, 1, 3), None),  # the later fetch withdrew the value
        (D(2024, 1, 4), 2000.0),
    ]


def test_energy_units(spark, rows):
    data = [
        samples.series("a.energy", "energy", "wind", "MWh", "2024-01-01", [5.0]),
        samples.series("b.energy", "energy", "hydro", "GWh", "2024-01-01", [5.0]),
        samples.series("c.energy", "energy", "pumps", "PJ", "2024-01-01", [5.0]),
    ]
    raw = samples.raw(spark, (samples.fetched(5), {"data": data}))
    wide = region_marts.generation_daily_wide(region_marts.generation_daily_by_fueltech(raw))
    assert rows(wide, "fueltech_id", "generated_mwh") == [("hydro", 5000.0), ("wind", 5.0)]
    _, rejected = apply_rules(payloads.stats_points(raw, False), SERIES_RULES)
    assert rows(rejected, "fueltech_id", F.col("broken_rules")[0]) == [("pumps", "known_energy_unit")]


def test_start_day_is_not_shifted_by_its_offset(spark, rows):
    for start in ("1998-12-31T14:00:00Z", "1998-12-31T23:30:00-05:00", "1998-12-31"):
        item = samples.series("x.energy", "energy", "wind", "GWh", "1998-12-31", [1.0])
        item["history"]["start"] = start
        raw = samples.raw(spark, (samples.fetched(5), {"data": [item]}))
        assert rows(payloads.stats_points(raw, False), "nem_date") == [(D(1998, 12, 31),)]


def test_unit_points(spark, rows):
    points = points_of(samples.raw(spark, (samples.fetched(5, "facility_data/interval=1d/chunk=000"), samples.UNIT_METRICS)))
    utc = lambda *a: dt.datetime(*a)
    kept, rejected = apply_rules(points, POINT_RULES)
    assert rows(kept, "unit_code", "interval", "interval_ts_utc", "value") == sorted(
        [
            ("U1", "1d", utc(2023, 12, 31, 14), 120.5),
            ("U1", "1d", utc(2024, 1, 1, 14), None),
            ("U1", "1d", utc(2024, 1, 2, 14), None),
            ("U1", "1d", utc(2024, 1, 3, 14), None),
            ("U1", "5m", utc(2023, 12, 31, 14), 0.4),
            ("U1", "5m", utc(2024, 1, 1, 13, 55), -0.2),
            ("U9", "1d", utc(2023, 12, 31, 14), 7.0),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )
    assert rejected.count() == 1
    failed = {r.rule: r.failed for r in rule_counts(points, POINT_RULES).collect()}
    assert failed == {"valid_unit_code": 0, "valid_ts": 1, "valid_metric": 0, "known_energy_unit": 0, "non_negative_value": 1}


def test_odd_numbers_can_be_counted(spark):
    raw = samples.raw(spark, (samples.fetched(5, "facility_data"), samples.UNIT_METRICS))
    unreadable = payloads.unit_points(raw).where("value IS NULL AND value_text IS NOT NULL")
    assert [r.value_text for r in unreadable.collect()] == ["n/a"]


def test_unreadable_files_are_kept_aside(spark, rows):
    raw = samples.raw(
        spark, ("a", "not json"), ("b", " "), ("c", {"success": False}), ("d", samples.STATS), ("e", {"data": []})
    )
    assert rows(payloads.quarantine(raw, payloads.STATS), "source_file", "reason") == [
        ("a", "no readable data array"),
        ("b", "empty file"),
        ("c", "no readable data array"),
    ]


def test_landing_keys_stay_text(spark, rows):
    raw = samples.raw(spark, (samples.fetched(5, "facility_data/interval=1d/chunk=007"), {}), ("file:/elsewhere/x.json", {}))
    assert rows(landing.with_landing_keys(raw), "interval", "chunk", "fetched_at") == [
        (None, None, samples.NOON + dt.timedelta(seconds=1)),
        ("1d", "007", dt.datetime(2024, 1, 5, 1, 2, 3)),
    ]


def test_coverage_gaps(spark, rows):
    files = [(f"file:/l/stats/region={r}/year={y}/fetched_at=2024-01-05T010203Z/part-000.json", {}) for r, y in [("SA1", 2020), ("SA1", 2021), ("VIC1", 2021)]]
    gaps = landing.coverage_gaps(samples.raw(spark, *files), landing.region_year_grid(spark, ["SA1", "VIC1"], 2020, 2021))
    assert rows(gaps) == [("VIC1", 2020)]


def test_chunk_gaps(spark, rows):
    files = [(f"file:/l/facility_data/interval={i}/chunk={c}/fetched_at=2024-01-05T010203Z/part-000.json", {}) for i, c in [("1d", "000"), ("5m", "000"), ("5m", "001")]]
    codes = spark.range(31).selectExpr("concat('F', id) AS facility_code")
    raw = samples.raw(spark, *files)
    assert rows(landing.coverage_gaps(raw, landing.chunk_grid(codes))) == [("1d", "001")]
    assert landing.coverage_gaps(raw, landing.chunk_grid(codes.limit(30))).isEmpty()
    assert landing.chunk_grid(codes.limit(0)).isEmpty()


def test_the_newest_fetch_opens_its_own_day_alone(spark, tmp_path, rows):
    target = str(tmp_path / "raw")
    text = lambda n: json.dumps(samples.REGISTRY).replace("Alpha", f"Alpha {n}")
    paths = [f"file:/landing/facilities/fetched_at=2024-01-{d:02d}T{h:02d}0203Z/part-000.json" for d, h in ((5, 1), (7, 3), (7, 9), (6, 1))]
    for n, path in enumerate(paths):
        ingest.write_raw(samples.raw(spark, (path, text(n))), target)
    newest = landing.newest_snapshot(ingest.read_raw(spark, target))
    assert rows(newest, "source_file") == [(paths[2],)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    assert any("PartitionFilters: [" in line and "subquery" in line.lower() for line in newest._jdf.queryExecution().executedPlan().toString().splitlines())
    # two files lie in the newest day, four in all
    assert [scan.metrics().apply("numFiles").value() for scan in samples.scans(newest)] == [2]
    assert dimensions.dim_unit(ingest.read_raw(spark, target)).where("facility_name = 'Alpha 2'").count() == 2
    # a table without days reads as before
    samples.raw(spark, *[(p, text(n)) for n, p in enumerate(paths)]).write.parquet(str(tmp_path / "flat"))
    assert rows(landing.newest_snapshot(ingest.read_raw(spark, str(tmp_path / "flat"))), "source_file") == [(paths[2],)]


def test_a_unit_listed_twice_counts_once(spark, rows):
    twice = json.loads(json.dumps(samples.REGISTRY))
    twice["data"][1]["units"].append({**twice["data"][0]["units"][0], "capacity_registered": 7.0})
    raw = samples.raw(spark, ("file:/landing/facilities/fetched_at=2024-01-05T010203Z/part-000.json", twice))
    assert rows(dimensions.units_listed_twice(raw), "unit_code", "facility_code") == [("U1", "F1"), ("U1", "F2")]
    units = dimensions.dim_unit(raw)
    assert rows(units, "unit_code", "facility_code", "capacity_registered_mw")[0] == ("U1", "F1", 100.0) and units.count() == 4
    assert rows(dimensions.facility_capacity(units), "facility_code", "capacity_registered_mw") == [("F1", 200.0), ("F2", 500.0), ("F4", 5.0)]


def test_raw_rows_are_dealt_before_they_are_sorted_by_folder(spark, rows, tmp_path):
    """Payloads that come in one task are written by several."""
    key, target = "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(tmp_path / "raw")
    raw = spark.range(0, 40_000, numPartitions=1).selectExpr(
        "sha2(string(id), 512) AS raw_json", "concat('/landing/facilities/fetched_at=2024-01-0', id % 2 + 1, 'T000000Z/part-', id, '.json') AS source_file",
        "timestamp'2024-03-01' AS ingested_at",
    )
    try:
        spark.conf.set(key, "64k")
        ingest.write_raw(raw, target)
    finally:
        spark.conf.unset(key)
    assert len(spark.read.parquet(f"{target}/fetch_day=2024-01-01").inputFiles()) > 1
    assert rows(ingest.read_raw(spark, target), "raw_json", "source_file") == rows(raw, "raw_json", "source_file")
