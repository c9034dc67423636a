import datetime as dt
import json

import pytest
import samples
from pyspark.errors import StreamingQueryException

from wattmill.operators import facility_marts
from wattmill.operators.quality import Rule
from wattmill.plans import questions
from wattmill.plans.refresh import Warehouse, expire, quarantined, refresh, refresh_or_replay, replay, rule_report, stored_marts
from wattmill.sources import versions
from wattmill.streaming.upsert import PointTable

POINTS = "facility_data/interval=1d/chunk=000/fetched_at={}/part-000.json"


def test_files_to_marts_and_again(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    w = Warehouse(str(landing), str(tmp_path / "wh"))
    samples.land(landing, "facilities/fetched_at=2024-01-05T010203Z/part-000.json", samples.REGISTRY)
    samples.land(landing, "stats/region=SA1/year=2024/fetched_at=2024-01-05T010203Z/part-000.json", samples.STATS)
    samples.land(landing, "stats/region=SA1/year=2023/fetched_at=2024-01-05T010203Z/part-000.json", "oops")
    samples.land(landing, POINTS.format("2024-01-05T010203Z"), samples.UNIT_METRICS)
    marts = refresh(spark, w)
    d1, d4 = dt.date(2024, 1, 1), dt.date(2024, 1, 4)
    first = rows(marts.facility_daily, "facility_code", "nem_date", "energy_mwh")
    assert first[0] == (None, d1, 7.0) and ("F1", d1, 120.5) in first and ("F1", d4, None) in first
    assert rows(marts.facility_capacity_factor.where("energy_mwh = 120.5"), "capacity_factor") == [(120.5 / (200 * 24),)]
    assert rows(marts.renewable_share_daily, "total_mwh", "renewable_share") == [(None, None), (0.0, None), (1500.0, 1.0), (2000.0, 1.0)]
    assert {f: q.count() for f, q in quarantined(spark, w).items()} == {"facilities": 0, "stats": 1, "facility_data": 0}

    report = {(r.tbl, r.rule): (r.passed, r.failed) for r in rule_report(spark, w).collect()}
    assert report["dim_unit", "valid_unit_code"] == (4, 1)
    assert report["generation_daily_by_fueltech", "valid_key"] == (5, 3)
    assert report["demand_daily", "valid_key"] == (2, 0)
    assert report["facility_generation", "valid_ts"] == (7, 1)
    assert report["facility_generation", "non_negative_value"] == (7, 1)
    assert report["stats_raw", "readable_payload"] == (1, 1)

    again = refresh(spark, w)  # nothing new: same answer
    assert rows(again.facility_daily, "facility_code", "nem_date", "energy_mwh") == first

    newer = json.loads(json.dumps(samples.UNIT_METRICS))
    newer["data"][0]["results"][0]["data"][0][1] = 99.0
    samples.land(landing, POINTS.format("2024-01-06T010203Z"), newer)
    samples.land(landing, POINTS.format("2024-01-01T010203Z"), samples.UNIT_METRICS)  # older fetch, late arrival
    third = refresh(spark, w)
    corrected = rows(third.facility_daily, "facility_code", "nem_date", "energy_mwh")
    assert ("F1", d1, 99.0) in corrected and len(corrected) == len(first)

    fresh, rebuilt = replay(spark, w)
    assert rows(rebuilt.facility_daily, "facility_code", "nem_date", "energy_mwh") == corrected
    assert fresh.points().root != w.points().root
    comments = {f.name: f.metadata.get("comment") for f in stored_marts(spark, fresh)["facility_daily"].schema.fields}
    assert "price" in comments["market_value_aud"]


def test_only_changed_months_are_recomputed(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    w = Warehouse(str(landing), str(tmp_path / "wh"))
    root = w.table("gold", "facility_daily")

    def fetch(stamp, month, value, unit="U1"):
        pairs = [[f"2024-{month:02d}-{d:02d}T00:00:00+10:00", value] for d in (1, 15, 28)]
        samples.land(landing, POINTS.format(stamp), {"data": [samples.block("energy", "1d", unit, pairs)]})

    def versions_of_months():
        return {part[0]: folder.dir.split("/")[1] for part, [folder] in versions.current(spark, root).live.items()}

    samples.land(landing, "facilities/fetched_at=2024-01-05T010203Z/part-000.json", samples.REGISTRY)
    samples.land(landing, "stats/region=SA1/year=2024/fetched_at=2024-01-05T010203Z/part-000.json", samples.STATS)
    fetch("2024-05-01T000000Z", 3, 1.0)
    fetch("2024-05-01T000001Z", 4, 1.0)
    refresh(spark, w)
    assert versions_of_months() == {"2024-03": "table_version=1", "2024-04": "table_version=1"}
    fetch("2024-05-02T000000Z", 4, 2.0)
    marts = refresh(spark, w)
    assert versions_of_months() == {"2024-03": "table_version=1", "2024-04": "table_version=2"}
    got = rows(marts.facility_daily.groupBy("facility_code").agg({"energy_mwh": "sum"}))
    assert got == [("F1", 9.0)]
    full = facility_marts.facility_daily(w.points().read(spark), marts.dim_unit)
    assert rows(full) == rows(marts.facility_daily)
    refresh(spark, w)
    assert versions.current(spark, root).number == 2

    renamed = json.loads(json.dumps(samples.REGISTRY).replace("Alpha", "Alpha II"))
    samples.land(landing, "facilities/fetched_at=2024-06-05T010203Z/part-000.json", renamed)
    marts = refresh(spark, w)
    assert versions_of_months() == {"2024-03": "table_version=3", "2024-04": "table_version=3"}
    assert rows(marts.facility_daily.select("facility_name").distinct()) == [("Alpha II",)]


def test_rejects_are_kept(spark, tmp_path):
    landing = tmp_path / "landing"
    w = Warehouse(str(landing), str(tmp_path / "wh"))
    samples.land(landing, "facilities/fetched_at=2024-01-05T010203Z/part-000.json", samples.REGISTRY)
    samples.land(landing, "stats/region=SA1/year=2024/fetched_at=2024-01-05T010203Z/part-000.json", samples.STATS)
    samples.land(landing, "stats/region=SA1/year=2024/fetched_at=2024-01-05T010203Z/part-001.json", "no json")
    samples.land(landing, POINTS.format("2024-01-05T010203Z"), samples.UNIT_METRICS)
    refresh(spark, w)
    reasons = lambda: sorted(r.reason for r in spark.read.parquet(w.table("silver", "stats_quarantine")).collect())
    assert reasons() == ["no readable data array"]
    samples.land(landing, "stats/region=SA1/year=2024/fetched_at=2024-01-06T010203Z/part-000.json", " ")
    refresh(spark, w)
    assert reasons() == ["empty file", "no readable data array"]


def test_questions_on_stored_marts_prune(spark, tmp_path):
    """Date and region filters of a question must reach the files of the stored marts."""
    landing = tmp_path / "landing"
    w = Warehouse(str(landing), str(tmp_path / "wh"))
    samples.land(landing, "facilities/fetched_at=2024-01-05T010203Z/part-000.json", samples.REGISTRY)
    samples.land(landing, "stats/region=SA1/year=2024/fetched_at=2024-01-05T010203Z/part-000.json", samples.STATS)
    samples.land(landing, POINTS.format("2024-01-05T010203Z"), samples.UNIT_METRICS)
    marts = refresh(spark, w)

    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")

    def scan(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return next(line for line in plan.splitlines() if "FileScan" in line)

    found = scan(questions.q04(marts, dt.date(2025, 3, 1)))
    assert "GreaterThanOrEqual(nem_date,2024-01-01)" in found and "EqualTo(network_region,SA1)" in found
    assert "ReadSchema: struct<nem_date:date,network_region:string,fueltech_group:string,generated_mwh:double>" in found
    assert "GreaterThanOrEqual(nem_date," in scan(questions.q10(marts, dt.date(2024, 1, 5)))
    assert rows_of(questions.q04(marts, dt.date(2025, 3, 1))) == [("wind", 3500.0)]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_only_changed_years_of_region_marts_are_recomputed(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    w = Warehouse(str(landing), str(tmp_path / "wh"))
    samples.land(landing, "facilities/fetched_at=2024-01-05T010203Z/part-000.json", samples.REGISTRY)
    samples.land(landing, POINTS.format("2024-01-05T010203Z"), samples.UNIT_METRICS)

    def fetch(day, year, values):
        item = samples.series("au.nem.sa1.fuel_tech.wind.energy", "energy", "wind", "GWh", f"{year}-03-01", values)
        samples.land(landing, f"stats/region=SA1/year={year}/fetched_at=2024-06-{day:02d}T000000Z/part-000.json", {"data": [item]})

    def made(name):
        return {part[0]: folder.dir.split("/")[1] for part, [folder] in versions.current(spark, w.table("gold", name)).live.items()}

    fetch(1, 2022, [1.0, 2.0])
    fetch(1, 2023, [3.0])
    refresh(spark, w)
    fetch(2, 2023, [4.0])
    marts = refresh(spark, w)
    for name in ("generation_daily_wide", "generation_mix_daily", "renewable_share_daily", "emissions_intensity_daily"):
        assert made(name) == {"2022": "table_version=1", "2023": "table_version=2"}
    assert rows(marts.generation_mix_daily, "nem_date", "generated_mwh") == [(dt.date(2022, 3, 1), 1000.0), (dt.date(2022, 3, 2), 2000.0), (dt.date(2023, 3, 1), 4000.0)]
    before = {name: rows(df) for name, df in stored_marts(spark, w).items()}
    assert any(expire(spark, w).values())
    assert {name: rows(df) for name, df in stored_marts(spark, w).items()} == before
    same, _ = refresh_or_replay(spark, w)
    assert same == w and {name: rows(df) for name, df in stored_marts(spark, w).items()} == before


def test_changed_rules_replay_history(spark, tmp_path, rows, monkeypatch):
    landing = tmp_path / "landing"
    w = Warehouse(str(landing), str(tmp_path / "wh"))
    samples.land(landing, "facilities/fetched_at=2024-01-05T010203Z/part-000.json", samples.REGISTRY)
    samples.land(landing, "stats/region=SA1/year=2024/fetched_at=2024-01-05T010203Z/part-000.json", samples.STATS)
    samples.land(landing, POINTS.format("2024-01-05T010203Z"), samples.UNIT_METRICS)
    refresh(spark, w)
    monkeypatch.setattr(PointTable, "rules", (*PointTable.rules, Rule("not_above_100", "value IS NULL OR value <= 100")))
    with pytest.raises(StreamingQueryException, match="replay it"):
        samples.land(landing, POINTS.format("2024-01-06T010203Z"), samples.UNIT_METRICS)
        refresh(spark, w)
    fresh, marts = refresh_or_replay(spark, w)
    assert fresh.generation == 1
    assert ("F1", dt.date(2024, 1, 1), 120.5) not in rows(marts.facility_daily, "facility_code", "nem_date", "energy_mwh")
    assert fresh.points().rejected(spark).where("array_contains(broken_rules, 'not_above_100')").count() == 2
