import samples
from pyspark.sql import functions as F

from wattmill.sources import drift, payloads


def raw(spark, *texts):
    return samples.raw(spark, *[(f"file:/landing/x/part-{i}.json", t) for i, t in enumerate(texts)])


def found(df):
    return sorted(tuple(r)[1:] for r in df.collect())


def test_unknown_and_changed_fields(spark):
    first = {"success": True, "extra": {"a": 1}, "data": [{"code": "F1", "units": [{"code": "U1", "tag": 1}, {"code": "U2", "tag": "x", "capacity_registered": "9"}]}]}
    second = {"success": None, "data": [{"code": 7, "o'dd key": [1], "units": [{"capacity_registered": 3.5, "tag": None}]}, {"location": [1, 2]}]}
    got = found(drift.unknown_fields(raw(spark, first, second, "no json", "", {"data": None}), payloads.REGISTRY, "facilities"))
    assert got == [
        ("data[].location", "object", "array", 1, 1),
        ("data[].o'dd key", None, "array", 1, 1),
        ("data[].units[].capacity_registered", "number", "text", 1, 1),
        ("data[].units[].tag", None, "number", 1, 1),
        ("data[].units[].tag", None, "text", 1, 1),
        ("extra", None, "object", 1, 1),
    ]


def test_the_declared_shape_reports_nothing(spark):
    plain = {k: v for k, v in samples.REGISTRY.items() if k != "extra_field"}
    assert found(drift.unknown_fields(raw(spark, plain, plain), payloads.REGISTRY, "facilities")) == []
    assert found(drift.unknown_fields(raw(spark, "nothing"), payloads.STATS, "stats")) == []
    assert found(drift.unknown_fields(raw(spark, plain).where(F.lit(False)), payloads.STATS, "stats")) == []


def test_points_of_any_kind_are_declared_as_text(spark):
    got = found(drift.unknown_fields(raw(spark, samples.UNIT_METRICS), payloads.UNIT_METRICS, "facility_data"))
    assert got == [("data[].results[].columns.x", None, "number", 1, 3)]
