import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from wattmill.operators import quality
from wattmill.sources import tables

RULES = (quality.Rule("has_a", "a IS NOT NULL"), quality.Rule("positive", "b > 0"), quality.Rule("small", "b < 10", "warn"))


@pytest.fixture
def data(spark):
    return spark.createDataFrame([("x", 1), ("y", 50), (None, -1), ("z", None), ("w", -5)], "a string, b int")


def test_kept_and_rejected_are_the_input(data, rows):
    kept, rejected = quality.apply_rules(data, RULES)
    assert rows(kept) == [("x", 1), ("y", 50)]
    assert rows(rejected, "a", "b", F.array_join("broken_rules", ",")) == [
        (None, -1, "has_a,positive"),
        ("w", -5, "positive"),
        ("z", None, "positive"),
    ]


def test_observation_counts_on_the_side(data):
    seen = Observation("seen")
    kept, _ = quality.apply_rules(data, RULES, observe_as=seen)
    kept.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 5, "kept": 2, "has_a": 1, "positive": 3, "small": 2}


def test_rule_counts(data, rows):
    assert rows(quality.rule_counts(data, RULES)) == [("has_a", "drop", 4, 1), ("positive", "drop", 2, 3), ("small", "warn", 3, 2)]


def test_keys(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3)], "k string, d int")
    assert rows(quality.pk_violations(df, ["k"])) == [(None, 1), ("a", 3)]
    assert rows(quality.pk_violations(df, ["k", "d"])) == [(None, 3, 1), ("a", 1, 2)]
    counts = quality.key_counts({"t": (df, ["k", "d"])})
    assert rows(counts) == [("t", 4, 1)]
    same = spark.createDataFrame([("t", 3)], "tbl string, n long")
    less = spark.createDataFrame([("t", 2)], "tbl string, n long")
    none = spark.createDataFrame([], "tbl string, n long")
    assert [quality.reconcile(counts, c).first().ok for c in (same, less, none)] == [True, False, False]


def test_reports(spark, rows):
    df = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-05')) AS nem_date, 'a' AS s")
    report = quality.coverage({"m": df}).first()
    assert (report.n, str(report.first_day), str(report.last_day)) == (5, "2024-01-01", "2024-01-05")
    assert rows(quality.distribution(df, "s")) == [("a", 5)]
    assert rows(quality.column_report(df, "t"), "column_name", "data_type") == [("nem_date", "date"), ("s", "string")]
    types = {f.name: quality.serving_type(f.dataType) for f in tables.declared("dim_facility").fields}
    assert (types["fueltech_groups"], types["unit_count"], types["lat"]) == ("jsonb", "bigint", "double precision")


def test_conform(spark):
    df = spark.sql("SELECT 1.0D AS value, DATE'2024-01-01' AS nem_date, 'SA1' AS network_region, 'energy' AS metric, 'GWh' AS uom")
    assert tables.conform(df, "demand_daily").columns == ["nem_date", "network_region", "metric", "value", "uom"]
    with pytest.raises(ValueError, match="undeclared"):
        tables.conform(df.withColumn("x", F.lit(1)), "demand_daily")
    with pytest.raises(ValueError, match="uom"):
        tables.conform(df.drop("uom"), "demand_daily")


def test_catalog_tables_carry_comments(spark):
    tables.create_namespaces(spark)
    df = spark.sql("SELECT DATE'2024-01-01' AS nem_date, 'SA1' AS network_region, 'wind' AS fueltech_group, 1.0D AS generated_mwh")
    tables.save_to_catalog(df, "gold", "generation_mix_daily")
    columns = {r.col_name: r.comment for r in spark.sql("DESCRIBE gold.generation_mix_daily").collect()}
    assert "NULL" in columns["generated_mwh"]
    text = " ".join(str(r) for r in spark.sql("DESCRIBE EXTENDED gold.generation_mix_daily").collect())
    assert tables.TABLE_COMMENTS["generation_mix_daily"] in text


def test_csv_keeps_quotes_and_commas(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'a "b", c', ["x", "y"]), (2, None, [])], "i int, t string, g array<string>")
    tables.export_csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert rows(back) == [("1", 'a "b", c', '["x","y"]'), ("2", None, "[]")]
