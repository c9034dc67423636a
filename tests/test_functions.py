import datetime as dt

from pyspark.sql import functions as F

from wattmill import session
from wattmill.functions import calendar, numbers, regions, taxonomy, units


def test_taxonomy_is_three_valued(spark, rows):
    codes = spark.createDataFrame([("wind",), ("coal_black",), ("nuclear",), ("brand_new",), (None,)], "c string")
    group = taxonomy.group_of(F.col("c"))
    assert rows(codes.select("c", group, taxonomy.renewable_flag(group))) == [
        (None, None, None),
        ("brand_new", None, None),
        ("coal_black", "coal", False),
        ("nuclear", None, None),
        ("wind", "wind", True),
    ]


def test_taxonomy_table_lists_every_code(spark):
    table = taxonomy.taxonomy_table(spark)
    assert table.count() == 25
    assert table.where("fueltech_group IS NULL").count() == 6
    assert table.where("is_renewable").select("fueltech_group").distinct().count() == 4


def test_only_energy_is_converted(spark, rows):
    df = spark.createDataFrame([("energy", "GWh"), ("energy", "MWh"), ("energy", "TJ"), ("emissions", "t")], "m string, u string")
    assert rows(df.select("m", "u", units.to_mart_factor(F.col("m"), F.col("u")))) == [
        ("emissions", "t", 1.0),
        ("energy", "GWh", 1000.0),
        ("energy", "MWh", 1.0),
        ("energy", "TJ", None),
    ]


def test_market_day_ignores_the_session_zone(spark):
    instants = [("2024-01-01 13:59:59", "2024-01-01"), ("2024-01-01 14:00:00", "2024-01-02"), ("1969-12-31 13:00:00", "1969-12-31")]
    df = spark.createDataFrame(
        [(dt.datetime.fromisoformat(t).replace(tzinfo=dt.UTC), d) for t, d in instants], "t timestamp, d string"
    )
    try:
        for zone in ("UTC", "Australia/Sydney", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = df.select(calendar.market_date(F.col("t")).cast("string").alias("g"), "d").collect()
            assert all(r.g == r.d for r in got), zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_midnight_is_the_inverse(spark):
    day = spark.sql("SELECT explode(sequence(DATE'1998-12-01', DATE'2024-12-31', INTERVAL 17 DAY)) AS d")
    assert day.where(calendar.market_date(calendar.market_midnight(F.col("d"))) != F.col("d")).isEmpty()


def test_relative_periods_are_inclusive(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2023-12-30', DATE'2025-01-02')) AS d")
    as_of = dt.date(2025, 1, 2)
    assert days.where(calendar.in_last_days("d", as_of, 30)).count() == 31
    assert days.where(calendar.in_last_full_year("d", as_of)).count() == 366
    assert days.where(calendar.in_years("d", 2023, 2023)).count() == 2
    assert days.where(calendar.in_last_days("d", None, 1)).isEmpty()


def test_region_spellings(spark, rows):
    df = spark.createDataFrame([("SA1",), (" south  AUSTRALIA ",), ("nsw",), ("Atlantis",), (None,)], "t string")
    assert rows(regions.canonicalise(df, "t")) == [
        (None, None),
        (" south  AUSTRALIA ", "SA1"),
        ("Atlantis", None),
        ("SA1", "SA1"),
        ("nsw", "NSW1"),
    ]


def test_ratio_over_zero_is_null(spark):
    row = spark.sql("SELECT 1.0D AS n, 0.0D AS z").select(numbers.ratio(F.col("n"), F.col("z")).alias("r")).first()
    assert row.r is None


def test_tidy_doubles_drops_negative_zero(spark):
    row = numbers.tidy_doubles(spark.sql("SELECT -0.0D AS a, 0.0776875D AS b, CAST(NULL AS DOUBLE) AS c")).first()
    assert (str(row.a), row.b, row.c) == ("0.0", 0.077688, None)


def test_shuffles_follow_the_input(spark, tmp_path, monkeypatch):
    (tmp_path / "x").write_bytes(b"0" * 10_000)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert session.size_shuffles(spark, str(tmp_path)) == 4
        monkeypatch.setattr(session, "INPUT_PER_PARTITION", 100)
        assert session.size_shuffles(spark, str(tmp_path)) == 100
        assert session.size_shuffles(spark, str(tmp_path), most=50) == 50
        assert spark.conf.get(key) == "50"
    finally:
        spark.conf.unset(key)


def test_a_shuffle_partition_gets_no_more_input_than_a_task_can_sort(spark, tmp_path):
    """A gigabyte of packed lines in two partitions would be sorted on disk."""
    with (tmp_path / "x").open("wb") as f:
        f.truncate(1024**3)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert session.size_shuffles(spark, str(tmp_path)) >= 32
        assert session.size_shuffles(spark, str(tmp_path), per=128 * 1024**2) == 8
    finally:
        spark.conf.unset(key)


def test_scans_are_cut_to_what_a_task_can_sort(spark):
    key = "spark.sql.files.maxPartitionBytes"
    try:
        for asked, used in (("128MB", str(16 * 1024**2)), ("1m", "1m")):
            spark.conf.set(key, asked)
            session.size_scans(spark)
            assert spark.conf.get(key) == used
    finally:
        spark.conf.unset(key)
