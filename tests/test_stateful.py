import datetime as dt
import random

import pytest

from wattmill.operators import quality
from wattmill.operators.facility_marts import facility_generation
from wattmill.streaming import counters, stateful, upsert

POINT = "unit_code string, interval_ts_utc timestamp, metric string, interval string, value double, uom string, ingested_at timestamp"
COLUMNS = ("unit_code", "interval_ts_utc", "metric", "value", "ingested_at")


def drawn(seed, n):
    rng = random.Random(seed)
    day = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(4))
    return [(rng.choice(["U1", "U2", None]), day(), "energy", "1d", rng.choice([None, -1.0, 2.0]), "MWh", dt.datetime(2024, 2, 1) + dt.timedelta(hours=i)) for i in range(n)]


def stream(spark, folder):
    return spark.readStream.schema(POINT).option("maxFilesPerTrigger", 1).parquet(folder)


def test_shuffled_late_and_replayed_files_with_a_restart(spark, tmp_path, rows):
    lines = drawn(1, 60)
    random.Random(2).shuffle(lines)
    folder, table = str(tmp_path / "in"), upsert.PointTable(str(tmp_path / "t"))
    store = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for part in (lines[:25], lines[25:] + lines[:10]):
        for i in range(0, len(part), 20):
            spark.createDataFrame(part[i : i + 20], POINT).coalesce(1).write.mode("append").parquet(folder)
        query = stateful.run_stateful(stream(spark, folder), table, str(tmp_path / "cp"))
        progress = query.recentProgress[-1]
        assert "RocksDB" in str(progress["stateOperators"][0]["customMetrics"]) or "rocksdb" in str(progress["stateOperators"][0]["customMetrics"])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == store
    assert rows(table.read(spark), *COLUMNS) == rows(facility_generation(spark.createDataFrame(lines, POINT)), *COLUMNS)
    # the state holds a row per key, not per point
    keys = {(u, at) for u, at, *_ in lines if u}
    assert progress["stateOperators"][0]["numRowsTotal"] == len(keys)


def test_old_keys_are_forgotten_with_a_lateness(spark, tmp_path, rows):
    folder, table = str(tmp_path / "in"), upsert.PointTable(str(tmp_path / "t"))
    at = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    for n, days in enumerate(([0, 1], [30], [1, 31], [60])):
        part = [("U1", at(d), "energy", "1d", float(n), "MWh", at(100 + n)) for d in days]
        spark.createDataFrame(part, POINT).coalesce(1).write.mode("append").parquet(folder)
        query = stateful.run_stateful(stream(spark, folder), table, str(tmp_path / "cp"), "interval_ts_utc", "10 days")
    assert rows(table.read(spark), "interval_ts_utc", "value") == [(at(0), 0.0), (at(1), 0.0), (at(30), 1.0), (at(31), 2.0), (at(60), 3.0)]
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < 4


def test_counters_of_every_batch_are_kept_once(spark, tmp_path, rows):
    folder, lines = str(tmp_path / "in"), drawn(3, 30)
    for i in range(0, 30, 10):
        spark.createDataFrame(lines[i : i + 10], POINT).coalesce(1).write.mode("append").parquet(folder)
    with counters.CounterTable(spark, str(tmp_path / "counters")) as kept:
        query = upsert.run_upsert(stream(spark, folder), upsert.PointTable(str(tmp_path / "t")), str(tmp_path / "cp"))
        kept.catch_up(query)
        kept.catch_up(query)
    found = kept.read()
    assert found.where("counter = 'rows'").count() == 3
    want = quality.rule_counts(spark.createDataFrame(lines, POINT), quality.POINT_RULES)
    assert rows(counters.rule_totals(found, "points")) == rows(want.select("rule", "passed", "failed"))


def test_an_error_of_the_listener_is_not_lost(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame(drawn(4, 5), POINT).write.parquet(folder)
    with pytest.raises(RuntimeError, match="no room"):
        with counters.CounterTable(spark, str(tmp_path / "counters")) as kept:
            kept._write = lambda *_: (_ for _ in ()).throw(RuntimeError("no room"))
            kept.catch_up(upsert.run_upsert(stream(spark, folder), upsert.PointTable(str(tmp_path / "t")), str(tmp_path / "cp")))
