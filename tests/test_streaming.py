import datetime as dt
import json
import random
import re

import pytest
import samples
from pyspark.sql import functions as F

from wattmill.operators.facility_marts import facility_generation
from wattmill.operators.region_marts import fetched_points, generation_daily_by_fueltech, with_groups
from wattmill.sources import landing, star, versions
from wattmill.sources.tables import write_table
from wattmill.session import cores
from wattmill.streaming import ingest, upsert

COLUMNS = ("unit_code", "interval", "interval_ts_utc", "metric", "value")


def files(n=12, seed=3):
    """Overlapping fetches of three units, daily and five-minute points at the same instants."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        blocks = []
        for unit in ("U1", "U2", "U3"):
            for interval, step in (("1d", 24 * 60), ("5m", 5)):
                start = dt.datetime(2024, 1, 30) + dt.timedelta(days=rng.randrange(4))
                pairs = [
                    [(start + dt.timedelta(minutes=step * k)).isoformat() + "+10:00", rng.choice([None, rng.randrange(-5, 50) / 2])]
                    for k in range(4)
                ]
                blocks.append(samples.block("energy", interval, unit, pairs))
        blocks.append(samples.block("energy", "1d", "U1", [["never", 1.0]]))
        blocks.append(samples.block(None, "1d", "U1", [["2024-01-30T00:00:00+10:00", 1.0]]))
        out.append((f"facility_data/interval=all/chunk={i:03d}/fetched_at=2024-02-{i + 1:02d}T000000Z/part-000.json", {"data": blocks}))
    return out


def test_each_file_is_taken_in_once(spark, tmp_path):
    landing, target, checkpoint = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "cp")
    samples.land(landing, "stats/region=SA1/year=2024/fetched_at=2024-01-05T010203Z/part-000.json", samples.STATS)
    samples.land(landing, "stats/region=SA1/year=2024/fetched_at=2024-01-05T010203Z/part-001.json", "not json")
    for _ in range(2):
        ingest.ingest(spark, str(landing), target, checkpoint)
        assert ingest.read_raw(spark, target).count() == 2
    samples.land(landing, "stats/region=SA1/year=2024/fetched_at=2024-01-06T010203Z/part-000.json", samples.STATS)
    ingest.ingest(spark, str(landing), target, checkpoint)
    raw = ingest.read_raw(spark, target)
    assert raw.count() == 3
    assert json.loads(raw.where("source_file LIKE '%06T%'").first().raw_json) == samples.STATS
    assert generation_daily_by_fueltech(raw).where("metric = 'energy'").count() == 4


@pytest.mark.parametrize("order", ["as_fetched", "reversed", "shuffled_with_copies"])
def test_stream_equals_batch(spark, tmp_path, rows, order):
    batch = files()
    raw_batch = samples.raw(spark, *[(f"file:/landing/{p}", d) for p, d in batch])
    expected = rows(facility_generation(upsert.points_of(raw_batch)), *COLUMNS)
    arriving = {"as_fetched": batch, "reversed": batch[::-1], "shuffled_with_copies": batch + batch[3:6]}[order]
    if order == "shuffled_with_copies":
        random.Random(5).shuffle(arriving)
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    table = upsert.PointTable(str(tmp_path / "points"))
    for run in range(3):
        for i, (path, payload) in enumerate(arriving[run * 5 : run * 5 + 5]):
            samples.land(landing, f"run={run}-{i}/{path}", payload)
        ingest.ingest(spark, str(landing), raw, str(tmp_path / "cp-raw"), max_files=2)
        query = upsert.run_upsert(upsert.points_of(ingest.stream_raw(spark, raw, 1)), table, str(tmp_path / "cp-points"))
    assert rows(table.read(spark), *COLUMNS) == expected
    assert rows(table.read(spark, intervals=["1d"]), *COLUMNS) == [r for r in expected if r[1] == "1d"]
    rejected = table.rejected(spark)
    assert rows(rejected.groupBy(F.array_join("broken_rules", ",")).count()) == [("valid_metric", len(arriving)), ("valid_ts", len(arriving))]
    assert query.exception() is None


def test_series_stream_equals_batch(spark, tmp_path, rows):
    rng = random.Random(9)
    arriving = []
    for day in range(1, 9):
        items = [
            samples.series(f"s{i}.energy", "energy", "wind", "GWh", f"2023-12-{20 + rng.randrange(5)}", [rng.choice([None, 1.0 * day]) for _ in range(12)])
            for i in range(2)
        ]
        arriving.append((samples.fetched(day), {"data": [*items, samples.series("x.temperature", "t", None, "C", "2024-01-01", [1.0])]}))
    rng.shuffle(arriving)
    raw = samples.raw(spark, *arriving)
    table = upsert.SeriesTable(str(tmp_path / "series"))
    for run in range(2):
        part = raw.where(F.xxhash64("source_file") % 2 == 0) if run == 0 else raw.where(F.xxhash64("source_file") % 2 != 0)
        part.repartition(3).write.mode("append").parquet(str(tmp_path / "raw"))
        stream = fetched_points(ingest.stream_raw(spark, str(tmp_path / "raw"), 1), False)
        upsert.run_upsert(stream, table, str(tmp_path / "cp"))
    assert rows(with_groups(table.read(spark))) == rows(generation_daily_by_fueltech(raw))
    assert table.rejected(spark).count() == 8
    assert {part for part in table.live(spark)} == {("2023",), ("2024",)}


def point(unit, value, seq, instant=dt.datetime(2024, 1, 1), interval="1d"):
    return (unit, instant, "energy", interval, value, "MWh", dt.datetime(2024, 2, 1) + dt.timedelta(seconds=seq))


POINT = "unit_code string, interval_ts_utc timestamp, metric string, interval string, value double, uom string, ingested_at timestamp"


def points(spark, *lines):
    return spark.createDataFrame([point(*line) if not isinstance(line[1], dt.datetime) else line for line in lines], POINT)


def test_replayed_and_older_batches_change_nothing(spark, tmp_path, rows):
    table = upsert.PointTable(str(tmp_path / "t"))
    table.merge(points(spark, ("U1", 1.0, 1), ("U2", 2.0, 1)), 0)
    table.merge(points(spark, ("U1", 5.0, 9)), 1)
    before = versions.current(spark, table.root)
    table.merge(points(spark, ("U1", 77.0, 99)), 1)
    table.merge(points(spark, ("U1", 78.0, 99)), 0)
    assert versions.current(spark, table.root) == before
    table.merge(points(spark, ("U1", 3.0, 4)), 2)  # late arrival of an older fetch
    assert rows(table.read(spark), "unit_code", "value") == [("U1", 5.0), ("U2", 2.0)]


def test_a_batch_that_dies_before_its_manifest_is_redone(spark, tmp_path, rows, monkeypatch):
    table = upsert.PointTable(str(tmp_path / "t"))
    table.merge(points(spark, ("U1", 1.0, 1)), 0)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", dies)
        with pytest.raises(RuntimeError):
            table.merge(points(spark, ("U1", 2.0, 2)), 1)
    assert rows(table.read(spark), "value") == [(1.0,)]
    table.merge(points(spark, ("U1", 2.0, 2)), 1)
    assert rows(table.read(spark), "value") == [(2.0,)]


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    table = upsert.PointTable(str(tmp_path / "t"))
    february = dt.datetime(2024, 2, 10)
    table.merge(points(spark, ("U1", 1.0, 1), ("U1", 1.0, 1, february), ("U1", 1.0, 1, february, "5m")), 0)
    table.merge(points(spark, ("U1", 2.0, 2, february)), 1)
    live = versions.current(spark, table.root).live
    assert {part: [f.dir.split("/")[1][-1] for f in own] for part, own in live.items()} == {
        ("1d", "2024-01"): ["1"], ("1d", "2024-02"): ["1", "2"], ("5m", "2024-02-10"): ["1"],
    }
    assert versions.superseded(spark, table.root) == []


def test_what_a_batch_writes_follows_the_batch(spark, tmp_path, rows):
    table = upsert.PointTable(str(tmp_path / "t"))
    table.merge(points(spark, *[(f"U{i}", 0.0, 0) for i in range(200)]), 0)
    written = []
    for batch in range(1, 22):
        table.merge(points(spark, (f"U{batch}", float(batch), batch)), batch)
        written.append(spark.read.parquet(f"{table.root}/data/table_version={batch + 1}").count())
    # the base is written again only when its level is full, not with every batch
    assert sum(written) < 21 + 2 * 200 + 40 and sorted(written)[10] == 1
    [own] = table.live(spark).values()
    assert len(own) <= 3 * upsert.FAN
    assert rows(table.read(spark), "unit_code", "value") == sorted((f"U{i}", float(i) if i < 22 else 0.0) for i in range(200))
    gone = versions.expire(spark, table.root)
    assert gone and versions.superseded(spark, table.root) == []
    assert table.read(spark).count() == 200


def test_tables_do_not_need_success_markers(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        root = str(tmp_path / "t")
        assert write_table(spark.range(5), root).count() == 5
        assert write_table(spark.range(9), root).count() == 9
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_batch_without_a_good_row(spark, tmp_path):
    table = upsert.PointTable(str(tmp_path / "t"))
    table.merge(points(spark, (None, 1.0, 1)), 0)
    assert table.read(spark).isEmpty() and table.rejected(spark).count() == 1
    assert versions.current(spark, table.root).batch_id == 0


def test_points_without_an_interval_survive(spark, tmp_path, rows):
    table = upsert.PointTable(str(tmp_path / "t"))
    for batch, value in enumerate((1.0, 2.0)):
        table.merge(points(spark, ("U1", value, batch, dt.datetime(2024, 1, 1), None)), batch)
    assert rows(table.read(spark), "interval", "value") == [(None, 2.0)]


def test_a_new_checkpoint_is_not_taken_for_a_replay(spark, tmp_path, rows):
    table = upsert.PointTable(str(tmp_path / "t"))
    for run in range(3):
        source = tmp_path / f"in{run}"
        points(spark, ("U1", float(run), run), (f"V{run}", 1.0, run)).write.parquet(str(source))
        stream = spark.readStream.schema(POINT).parquet(str(source))
        upsert.run_upsert(stream, table, str(tmp_path / f"cp{run}"))
    assert rows(table.read(spark), "unit_code", "value") == [("U1", 2.0), ("V0", 1.0), ("V1", 1.0), ("V2", 1.0)]


def test_an_unfinished_manifest_does_not_count(spark, tmp_path, rows):
    table = upsert.PointTable(str(tmp_path / "t"))
    table.merge(points(spark, ("U1", 1.0, 1)), 0)
    half = tmp_path / "t" / "manifests" / "version=2"
    half.mkdir()
    (half / "part-0.json").write_text('{"stream": "", "batch_id": 7, "live": []}')
    assert versions.current(spark, table.root).number == 1
    table.merge(points(spark, ("U1", 2.0, 2)), 1)
    assert versions.current(spark, table.root).number == 2 and rows(table.read(spark), "value") == [(2.0,)]


def test_odd_part_names_survive(spark, tmp_path, rows):
    table = upsert.PointTable(str(tmp_path / "a folder" / "t"))
    odd = "1 h/2=3:%41"
    for batch, value in enumerate((1.0, 2.0)):
        table.merge(points(spark, ("U1", value, batch, dt.datetime(2024, 1, 1), odd)), batch)
    assert rows(table.read(spark), "interval", "value") == [(odd, 2.0)]


def test_warnings_show_in_the_progress(spark, tmp_path):
    source = tmp_path / "in"
    points(spark, ("U1", -1.0, 1), ("U2", 2.0, 1), (None, 2.0, 1)).write.parquet(str(source))
    stream = spark.readStream.schema(POINT).parquet(str(source))
    query = upsert.run_upsert(stream, upsert.PointTable(str(tmp_path / "t")), str(tmp_path / "cp"))
    seen = [p["observedMetrics"]["points"] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p["observedMetrics"]]
    assert seen[0]["rows"] == 3 and seen[0]["non_negative_value"] == 1 and seen[0]["valid_unit_code"] == 1


def test_unit_files_are_made_in_one_deal(spark, tmp_path):
    """Lines are dealt to their files once, before metrics unfold; a landed file holds one payload and takes less room than its text."""
    raw = star.unit_files_raw(spark, "/root/testdata/sf0.001")
    first = raw._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    deals = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", first)
    assert sum("chunk#" in keys for keys in deals) == 1
    star.land(raw, str(tmp_path / "landing"), "interval", "chunk", "year", "fetched_at")
    landed = landing.read_files(spark, str(tmp_path / "landing"))
    texts = [r.raw_json for r in raw.collect()]
    # one text is one file; the order of points in a file is left open
    assert landed.count() == len(texts)
    assert sorted(len(r.raw_json.strip()) for r in landed.collect()) == sorted(map(len, texts))
    assert sum(f.stat().st_size for f in (tmp_path / "landing").rglob("part-*")) < sum(map(len, texts)) / 2


def test_many_small_files_go_to_many_cores_and_few_tasks(spark, tmp_path):
    """Files of one folder are written by more than one task, and taken in by few; the session keeps its settings."""
    path = "/landing/facilities/fetched_at=2002-01-01T000000Z/part-{:04d}.json"
    raw = samples.raw(spark, *[(path.format(i), {"data": [{"code": f"F{i}"}]}) for i in range(600)])
    star.land(raw, str(tmp_path / "landing"), "fetched_at")
    files = list((tmp_path / "landing").rglob("part-*"))
    assert len(files) == 600 and len({re.match(r"part-(\d+)", f.name)[1] for f in files}) >= cores(spark)
    assert not list((tmp_path / "landing").rglob(".part-*.crc"))
    before = spark.conf.getAll
    ingest.ingest(spark, str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "cp"))
    assert spark.conf.getAll == before
    # one file of each task
    assert len(list((tmp_path / "raw").rglob("part-*.parquet"))) <= 2 * cores(spark)
    texts = {json.loads(r.raw_json)["data"][0]["code"] for r in ingest.read_raw(spark, str(tmp_path / "raw")).collect()}
    assert texts == {f"F{i}" for i in range(600)}


def test_unit_files_hold_every_point_and_unfold_none_to_be_made(spark, rows):
    """A line stays one row until its file is made, and the files hold a point for each metric of each line, missing values included."""
    sf_dir = "/root/testdata/sf0.001"
    raw = star.unit_files_raw(spark, sf_dir)
    assert "Generate" not in raw._jdf.queryExecution().optimizedPlan().toString()
    point = ("unit_code", "interval_ts_utc", "metric", "interval", "value", "uom")
    assert rows(upsert.points_of(raw), *point) == rows(star.daily_points(spark, sf_dir), *point)


def test_metrics_cross_the_merge_in_one_row(spark, tmp_path):
    """Both shuffles of a merge carry the metrics of an instant in one row, and go when the merge is written."""
    metrics = ("energy", "emissions", "market_value", "power")
    rows = [(f"U{u}", dt.datetime(2024, 1, 1), m, "1d", float(v), "MWh", dt.datetime(2024, 2, v)) for u in range(50) for m in metrics for v in (1, 3, 2)]
    fetched = spark.createDataFrame(rows, POINT)
    table = upsert.PointTable(str(tmp_path / "t"))
    kept = fetched.withColumn("source_id", F.lit(None).cast("bigint")).withColumns(table.derived()).select(*table.stored.names)
    dealt = table._laid_out(kept)
    from pyspark.sql import DataFrame

    plan = dealt._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "RebalancePartitions":
        plan = plan.children().apply(0)
    through = DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan.children().apply(0)), spark)
    assert through.count() == 50 * 2 and dealt.count() == 50 * 4
    before = spark.conf.getAll
    table.merge(fetched, 0)
    assert spark.conf.getAll == before
    assert {r.value for r in table.read(spark).collect()} == {3.0} and table.read(spark).count() == 200
    assert all(".zstd." in f.name for f in (tmp_path / "t" / "data").rglob("part-*"))
