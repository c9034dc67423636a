import datetime as dt

import pytest
import samples

from wattmill.sources import serving, tables, versions

SCHEMA = "k string, nem_date date, v double, g array<string>"
D = [dt.date(2024, 1, d) for d in range(1, 11)]


def table(spark, *lines):
    return spark.createDataFrame([(*line, ["a", "b"]) for line in lines], SCHEMA)


def test_publish_drops_null_keys_and_reconciles(spark, tmp_path, rows):
    df = table(spark, ("x", D[0], 1.0), ("x", D[1], 2.0), (None, D[0], 3.0), ("y", None, 4.0))
    report = serving.publish_snapshot(df, str(tmp_path / "s"), ["k", "nem_date"])
    assert report == {"source_rows": 4, "null_key_rows": 2, "copy_rows": 2, "ok": True}
    assert rows(tables.read_table(spark, str(tmp_path / "s"), df.schema), "k", "v") == [("x", 1.0), ("x", 2.0)]


def test_duplicate_keys_leave_the_old_copy(spark, tmp_path, rows):
    root = str(tmp_path / "s")
    good = table(spark, ("x", D[0], 1.0))
    serving.publish_snapshot(good, root, ["k"])
    with pytest.raises(serving.DuplicateKeys):
        serving.publish_snapshot(table(spark, ("x", D[0], 8.0), ("x", D[1], 9.0)), root, ["k"])
    assert rows(tables.read_table(spark, root, good.schema), "v") == [(1.0,)]
    serving.publish_snapshot(table(spark, ("x", D[0], 2.0)), root, ["k"])
    assert rows(tables.read_table(spark, root, good.schema), "v") == [(2.0,)]
    assert versions.current(spark, root).number == 2


def test_a_snapshot_can_be_rebuilt_from_itself(spark, tmp_path, rows):
    root = str(tmp_path / "s")
    df = table(spark, ("x", D[0], 1.0))
    serving.publish_snapshot(df, root, ["k"])
    again = tables.read_table(spark, root, df.schema).selectExpr("k", "nem_date", "v + 1 AS v", "g")
    serving.publish_snapshot(again, root, ["k"])
    assert rows(tables.read_table(spark, root, df.schema), "v") == [(2.0,)]


def test_arrays_as_json(spark, tmp_path):
    df = table(spark, ("x", D[0], 1.0))
    serving.publish_snapshot(df, str(tmp_path / "s"), ["k"], as_json=True)
    copy = tables.read_table(spark, str(tmp_path / "s"), serving.flatten_for_serving(df).schema)
    assert copy.first().g == '["a","b"]'


def test_lookups(spark, rows):
    df = table(spark, *[("x", d, float(d.day)) for d in D], *[("y", d, -1.0) for d in D[:3]])
    assert serving.lookup(df, k="y", nem_date=D[1]).count() == 1
    assert rows(serving.last_rows(df, 3, k="x"), "nem_date") == [(D[7],), (D[8],), (D[9],)]
    assert rows(serving.last_rows_each(df, ["k"], 2), "k", "nem_date") == [("x", D[8]), ("x", D[9]), ("y", D[1]), ("y", D[2])]
    assert serving.containing(df, "g", "b").count() == 13 and serving.containing(df, "g", "z").isEmpty()


def test_last_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("concat('k', id % 2) AS k", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS nem_date")
    plan = serving.last_rows_each(df, ["k"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def opened_rows(df):
    """Rows that came out of the files' row groups, whatever a filter made of them afterwards."""
    return sum(scan.metrics().apply("numOutputRows").value() for scan in samples.scans(df))


def test_an_absent_key_opens_no_row_group(spark, tmp_path):
    lines = spark.range(50_000).selectExpr("concat('K', md5(CAST(id AS STRING))) AS k", "id AS v")
    blooms, plain = str(tmp_path / "blooms"), str(tmp_path / "plain")
    serving.publish_snapshot(lines, blooms, ["k"])
    tables.write_table(lines, plain, order_by=["k"])
    read = lambda root: tables.read_table(spark, root, lines.schema)
    absent = "K7777777777777777777777777777777"  # inside the range of the keys, so that statistics do not exclude it
    assert opened_rows(serving.lookup(read(blooms), k=absent)) == 0
    assert opened_rows(serving.lookup(read(plain), k=absent)) > 0
    there = read(blooms).first()
    assert serving.lookup(read(blooms), k=there.k).first() == there and opened_rows(serving.lookup(read(blooms), k=there.k)) > 0
