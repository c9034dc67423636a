import datetime as dt

import pytest
from pyspark.sql import types as T

from wattmill.operators import quality
from wattmill.sources import evolution, tables, versions
from wattmill.streaming import upsert

RULES = quality.POINT_RULES[:3]


def shape(ddl):
    return T.StructType.fromDDL(ddl)


def test_changes_by_column(spark):
    old = shape("a int, b string, c struct<x: int, y: array<struct<z: float>>>, d decimal(10,2), e map<string, int>, gone date")
    new = shape("a bigint, b string, c struct<x: string, y: array<struct<z: double, more: int>>>, d decimal(12,3), e map<string, bigint>, fresh int")
    found = {c.path: (c.kind, c.before, c.after) for c in evolution.changes(old, new)}
    assert found == {
        "a": ("widened", "int", "bigint"),
        "c.x": ("changed", "int", "string"),
        "c.y[].z": ("widened", "float", "double"),
        "c.y[].more": ("added", None, "int"),
        "d": ("widened", "decimal(10,2)", "decimal(12,3)"),
        "e{}": ("widened", "int", "bigint"),
        "gone": ("dropped", "date", None),
        "fresh": ("added", None, "int"),
    }
    assert not evolution.widens(T.DecimalType(10, 2), T.DecimalType(10, 3)) and not evolution.widens(T.LongType(), T.IntegerType())


def test_every_listed_widening_reads(spark, tmp_path):
    """What the list calls wider must come out with the same values from files of the narrower type."""
    value = {T.ByteType: 7, T.ShortType: -300, T.IntegerType: 70_000, T.FloatType: 0.5, T.DateType: dt.date(2024, 2, 29)}
    for narrow, wider in evolution.WIDER.items():
        for i, wide in enumerate(wider):
            root = str(tmp_path / f"{narrow.__name__}-{i}")
            old, new = T.StructType().add("k", T.StringType()).add("v", narrow()), T.StructType().add("k", T.StringType()).add("v", wide())
            tables.write_table(spark.createDataFrame([("a", value[narrow]), ("b", None)], old), root)
            found = {r.k: r.v for r in tables.read_table(spark, root, new).collect()}
            want = dt.datetime(2024, 2, 29) if narrow is T.DateType else value[narrow]
            assert found == {"a": want, "b": None}


def test_added_columns_are_null_and_narrower_ones_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([("x", 5)], "k string, n int"), root)
    assert [tuple(r) for r in tables.read_table(spark, root, shape("k string, n bigint, more array<string>")).collect()] == [("x", 5, None)]
    for narrower in ("k string, n smallint", "k string, n string", "k int, n int"):
        with pytest.raises(evolution.ReplayNeeded, match="n: int|k: string"):
            tables.read_table(spark, root, shape(narrower))


class Older(upsert.PointTable):
    stored = T.StructType([T.StructField(f.name, T.IntegerType() if f.name == "value" else f.dataType) for f in upsert.PointTable.stored.fields if f.name != "uom"])


POINT = "unit_code string, interval_ts_utc timestamp, metric string, interval string, value double, uom string, ingested_at timestamp"
DAY = dt.datetime(2024, 1, 1)


def points(spark, *lines):
    return spark.createDataFrame([(u, DAY, "energy", "1d", v, "MWh", DAY + dt.timedelta(days=seq)) for u, v, seq in lines], POINT)


def test_merges_go_on_over_a_changed_shape(spark, tmp_path, rows):
    root = str(tmp_path / "points")
    Older(root, RULES).merge(points(spark, ("U1", 1.0, 1), ("U2", 2.0, 5)).selectExpr("* except (uom, value)", "int(value) AS value"), 0)
    table = upsert.PointTable(root, RULES)
    for batch in range(1, 6):  # enough for folders of the old shape to be merged into one of the new
        table.merge(points(spark, ("U1", batch + 0.5, 1 + batch), ("U2", 9.5, 4)), batch)
    assert rows(table.read(spark), "unit_code", "value", "uom") == [("U1", 5.5, "MWh"), ("U2", 2.0, None)]
    assert {f.shape for f in versions.current(spark, root).folders()} == {table.stored.json()}


def test_changed_drop_rules_ask_for_a_replay(spark, tmp_path):
    root = str(tmp_path / "points")
    upsert.PointTable(root, RULES).merge(points(spark, ("U1", 1.0, 1)), 0)
    warned = upsert.PointTable(root, (*RULES, quality.Rule("large", "value > 5", "warn")))
    assert not warned.rules_changed(spark)
    warned.merge(points(spark, ("U1", 2.0, 2)), 1)
    strict = upsert.PointTable(root, (*RULES, quality.Rule("large", "value > 5")))
    assert strict.rules_changed(spark)
    with pytest.raises(evolution.ReplayNeeded):
        strict.merge(points(spark, ("U1", 3.0, 3)), 2)


def test_expired_tables_keep_their_rows(spark, tmp_path, rows):
    root = str(tmp_path / "points")
    table = upsert.PointTable(root, RULES)
    for batch in range(5):
        table.merge(points(spark, (f"U{batch % 2}", float(batch), batch), (None, 1.0, batch)), batch)
    before = rows(table.read(spark))
    gone = table.expire(spark)
    assert rows(table.read(spark)) == before and table.rejected(spark).count() == 5
    assert not versions.subfolders(spark, root, "batches/stream=*/batch=*/outcome=kept") and len(gone) > 5
    assert versions.subfolders(spark, root, "manifests/version=*") == [f"manifests/version={versions.current(spark, root).number}"]
    table.merge(points(spark, ("U0", 77.0, 9)), 5)
    assert ("U0", 77.0) in rows(table.read(spark), "unit_code", "value")
