"""Registered queries: every operator over the bundled star-schema tables.

Each entry takes a session and a folder of tables and returns a DataFrame. Doubles are rounded,
arrays joined to text and instants given without zone, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.functions.numbers import tidy_doubles
from wattmill.functions.regions import REGIONS, canonicalise, unmatched
from wattmill.operators import compare, conversations, dimensions, facility_marts, metrics, plausibility, quality, region_marts, spans
from wattmill.operators.latest import latest_by
from wattmill.plans import questions, sql_functions, variants
from wattmill.plans.marts import Marts, StarMarts
from wattmill.session import pin_settings, shared_dir, size_scans, size_shuffles
from wattmill.sources import drift, landing, payloads, serving, star, tables
from wattmill.sources.evolution import ReplayNeeded
from wattmill.streaming import counters, ingest, stateful, upsert

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(f.name))
    return tidy_doubles(df.select(*columns))


def _as_of(spark: SparkSession, sf_dir: str) -> Column:
    """Last day of the data, as a scalar subquery."""
    return star.table(spark, sf_dir, "lineitem").agg(F.max(F.to_date("l_shipdate"))).scalar()


def _mart(name: str) -> Query:
    return lambda spark, sf_dir: getattr(StarMarts(spark, sf_dir), name)


def _question(key: str) -> Query:
    params = QUESTION_PARAMS.get(key, {})

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return questions.QUESTIONS[key](StarMarts(spark, sf_dir), _as_of(spark, sf_dir), **params)

    return run


def publish(spark: SparkSession, sf_dir: str, key: str) -> SimpleNamespace:
    """The published copy of the mart that a lookup reads."""
    mart, keys = PUBLISHED[key]
    root = shared_dir(spark, "serving")
    frame = getattr(StarMarts(spark, sf_dir), mart)
    serving.publish_snapshot(frame, root, keys)
    return SimpleNamespace(**{mart: tables.read_table(spark, root, frame.schema)})


def look_up(spark: SparkSession, sf_dir: str, key: str, copy: SimpleNamespace) -> DataFrame:
    return questions.QUESTIONS[key](copy, _as_of(spark, sf_dir), **QUESTION_PARAMS.get(key, {}))


def _published(key: str) -> Query:
    """A lookup on the published copy of a mart."""
    return lambda spark, sf_dir: look_up(spark, sf_dir, key, publish(spark, sf_dir, key))


def _variant(fn: Callable) -> Query:
    return lambda spark, sf_dir: fn(StarMarts(spark, sf_dir), _as_of(spark, sf_dir))


# Parameters that fit the bundled data, which covers 1995 to 2001.
QUESTION_PARAMS = {
    "q03": {"first": 1996, "last": 2000},
    "q07": {"first": 1996, "last": 2000},
    "q09": {"first": 1997, "last": 2001},
    "q15": {"min_days": 5},
    "e06": {"name": "Supplier#000000003"},
    "l1": {"code": "F3"},
    "l2": {"code": "F3"},
    "l4": {"first": 1996, "last": 2000},
}


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.table(spark, sf_dir, "events")


def registry_roundtrip(spark, sf_dir):
    """Registry files of two fetches in a raw table by day of fetch; the units come from the newest day alone."""
    target = shared_dir(spark, "registry")
    ingest.write_raw(star.registry_raw(spark, sf_dir), target)
    return dimensions.dim_unit(ingest.read_raw(spark, target))


def registry_codes(spark, sf_dir):
    return dimensions.registry_codes(star.registry_raw(spark, sf_dir))


def stats_roundtrip(spark, sf_dir):
    return region_marts.generation_daily_by_fueltech(star.stats_raw(spark, sf_dir))


def demand_daily_roundtrip(spark, sf_dir):
    return region_marts.demand_daily(star.stats_raw(spark, sf_dir))


def unit_metrics_roundtrip(spark, sf_dir):
    return facility_marts.facility_generation(upsert.points_of(star.unit_metrics_raw(spark, sf_dir)))


def stats_ingest_stream(spark, sf_dir):
    """Payload files on shared storage, taken in by a file stream, then parsed into the mix mart."""
    base = shared_dir(spark, "ingest")
    star.land_stats(star.stats_raw(spark, sf_dir), f"{base}/landing")
    ingest.ingest(spark, f"{base}/landing/stats", f"{base}/raw", f"{base}/checkpoint")
    series = region_marts.generation_daily_by_fueltech(ingest.read_raw(spark, f"{base}/raw"))
    return region_marts.generation_mix_daily(region_marts.generation_daily_wide(series))


def registry_ingest_stream(spark, sf_dir):
    """Registry files taken in by the file stream, then the unit dimension from the newest fetch."""
    base = shared_dir(spark, "ingest")
    star.land(star.registry_raw(spark, sf_dir), f"{base}/landing/facilities", "fetched_at")
    ingest.ingest(spark, f"{base}/landing/facilities", f"{base}/raw", f"{base}/checkpoint")
    return dimensions.dim_unit(ingest.read_raw(spark, f"{base}/raw"))


def unit_files_ingest_stream(spark, sf_dir):
    """Unit files taken in by the file stream, parsed and reduced to the latest value of each point."""
    base = shared_dir(spark, "ingest")
    star.land(star.unit_files_raw(spark, sf_dir), f"{base}/landing/facility_data", "interval", "chunk", "year", "fetched_at")
    ingest.ingest(spark, f"{base}/landing/facility_data", f"{base}/raw", f"{base}/checkpoint")
    return facility_marts.facility_generation(upsert.points_of(ingest.read_raw(spark, f"{base}/raw")))


def series_restart(spark, sf_dir):
    """Stats files in two arrivals, the corrected fetch before the older one, drained by a stream that stops in between,
    then drained once more under a new checkpoint: the table is that of one batch over all files."""
    base = shared_dir(spark, "restart")
    raw = star.stats_raw(spark, sf_dir)
    table = upsert.SeriesTable(f"{base}/series")

    def drain(checkpoint: str) -> None:
        stream = region_marts.fetched_points(ingest.stream_raw(spark, f"{base}/raw"), False)
        upsert.run_upsert(stream, table, f"{base}/{checkpoint}")

    older = landing.path_key("fetched_at") == star.FIRST_FETCH
    for some in (~older, older):
        raw.where(some).write.mode("append").parquet(f"{base}/raw")
        drain("checkpoint")
    drain("checkpoint-2")
    return region_marts.with_groups(table.read(spark))


def quarantined_files(spark, sf_dir):
    """Texts that are no payload, among stats files: listed with a reason, and no file lost."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.when(F.col("doc_id") % 10 == 0, "  ").otherwise(F.col("text")).alias("raw_json"),
        F.concat(F.lit("/landing/stats/doc="), "doc_id", F.lit(".json")).alias("source_file"),
        F.timestamp_seconds("doc_id").alias("ingested_at"),
    )
    mixed = texts.unionByName(star.stats_raw(spark, sf_dir).select(*texts.columns))
    return payloads.quarantine(mixed, payloads.STATS).select("source_file", "ingested_at", "reason")


def stored_mix(spark, sf_dir):
    """The mix mart written as a version of a sorted table and read back."""
    root = shared_dir(spark, "stored")
    return tables.write_table(StarMarts(spark, sf_dir).generation_mix_daily, root, order_by=("nem_date", "network_region", "fueltech_group"))


def unmatched_regions(spark, sf_dir):
    return unmatched(star.customer_regions(spark, sf_dir), "region_text")


def scd1_batch(spark, sf_dir):
    return facility_marts.facility_generation(star.unit_points(spark, sf_dir))


def scd1_stream(spark, sf_dir):
    """The events table as a stream, upserted into a table on shared storage."""
    base = shared_dir(spark, "upsert")
    # as a pattern, the path may be a folder of part files or a single file
    stream = spark.readStream.schema(star.SCHEMAS["events"]).parquet(f"{sf_dir}/events.parque[t]")
    table = upsert.PointTable(f"{base}/points")
    upsert.run_upsert(star.subdaily_points(stream), table, f"{base}/checkpoint")
    return table.read(spark)


def _two_arrivals(spark, sf_dir, folder: str):
    """Events as files in two arrivals: the newer half, then the older one with a third of the newer ones again."""
    events = _events(spark, sf_dir)
    half = events.agg(F.max("event_id") / 2).scalar()
    newer = F.col("event_id") > half
    for arrival in (events.where(newer), events.where(~newer | (F.col("event_id") % 3 == 0))):
        arrival.write.mode("append").parquet(folder)
        yield star.subdaily_points(spark.readStream.schema(star.SCHEMAS["events"]).option("maxFilesPerTrigger", 100).parquet(folder))


def scd1_stateful(spark, sf_dir):
    """The events as a stateful stream that stops between two arrivals and goes on from its checkpoint; late and repeated events change nothing."""
    base = shared_dir(spark, "stateful")
    table = upsert.PointTable(f"{base}/points")
    for points in _two_arrivals(spark, sf_dir, f"{base}/events"):
        stateful.run_stateful(points, table, f"{base}/checkpoint")
    return table.read(spark)


BASIC_RULES = quality.POINT_RULES[:3]


class PointsBeforeUnits(upsert.PointTable):
    """The point table as it once was: whole values, and no unit."""

    stored = T.StructType(
        [T.StructField(f.name, T.IntegerType() if f.name == "value" else f.dataType) for f in upsert.PointTable.stored.fields if f.name != "uom"]
    )


def evolved_points(spark, sf_dir):
    """Points written before units were kept and by today's job, in one table: the older folders read under the new shape, without a replay."""
    root = shared_dir(spark, "evolved")
    points = star.subdaily_points(_events(spark, sf_dir))
    # the two halves touch the same days, so every part has folders of both shapes
    older = F.unix_seconds("ingested_at") % 2 == 0
    whole = points.where(older).withColumn("value", F.floor("value").cast("int")).drop("uom")
    PointsBeforeUnits(root, BASIC_RULES).merge(whole, 0)
    table = upsert.PointTable(root, BASIC_RULES)
    table.merge(points.where(~older), 1)
    return table.read(spark)


def replayed_points(spark, sf_dir):
    """A table whose drop rules have changed refuses new rows; history is replayed into a new target under the new rules."""
    base = shared_dir(spark, "replayed")
    points = star.subdaily_points(_events(spark, sf_dir))
    upsert.PointTable(f"{base}/points-g0", BASIC_RULES).merge(points, 0)
    strict = (*BASIC_RULES, quality.Rule("large_value", "value >= 10"))
    table = upsert.PointTable(f"{base}/points-g0", strict)
    try:
        table.merge(points, 1)
    except ReplayNeeded:
        table = upsert.PointTable(f"{base}/points-g1", strict)
        table.merge(points, 0)
    return table.read(spark)


def expired_points(spark, sf_dir):
    """The upserted table after superseded folders and folded-in batches are deleted: the same rows."""
    root = shared_dir(spark, "expired")
    points = star.subdaily_points(_events(spark, sf_dir))
    table = upsert.PointTable(root)
    for batch in range(5):
        table.merge(points.where(F.unix_seconds("ingested_at") % 5 == batch), batch)
    table.expire(spark)
    return table.read(spark)


def stream_rule_totals(spark, sf_dir):
    """Counters that a stream observed batch by batch, kept as a table: passed and failed rows of every rule over the events."""
    base = shared_dir(spark, "counted")
    _events(spark, sf_dir).write.parquet(f"{base}/events")
    stream = spark.readStream.schema(star.SCHEMAS["events"]).option("maxFilesPerTrigger", 1).parquet(f"{base}/events")
    with counters.CounterTable(spark, f"{base}/counters") as kept:
        table = upsert.PointTable(f"{base}/points")
        kept.catch_up(upsert.run_upsert(star.subdaily_points(stream), table, f"{base}/checkpoint"))
    return counters.rule_totals(kept.read(), "points")


def unknown_fields(spark, sf_dir):
    """What a registry that has moved on holds beyond the declared shape."""
    return drift.unknown_fields(star.registry_drifted(spark, sf_dir), payloads.REGISTRY, "facilities")


def units_listed_twice(spark, sf_dir):
    """A registry in which another facility lists every fifth unit again: the rows of these units."""
    raw = star.registry_raw(spark, sf_dir)
    number = F.regexp_extract("source_file", "part-U([0-9]+)", 1).cast("bigint")
    again = raw.where(number % 5 == 0).select(
        F.regexp_replace("raw_json", '"code":"F', '"code":"G').alias("raw_json"), F.regexp_replace("source_file", "part-U", "part-V").alias("source_file"), "ingested_at"
    )
    target = shared_dir(spark, "registry")
    ingest.write_raw(raw.unionByName(again), target)
    twice = dimensions.units_listed_twice(ingest.read_raw(spark, target))
    return twice.select("unit_code", "facility_code", "capacity_registered_mw")


def spans_covering_days(spark, sf_dir):
    """Open orders of each region and day: days joined with the spans that cover them."""
    days = StarMarts(spark, sf_dir).renewable_share_daily.select("network_region", "nem_date", "total_mwh")
    covered = spans.in_spans(days, star.order_spans(spark, sf_dir), "nem_date", "opened", "closed", on=["network_region"])
    return covered.groupBy("network_region", "nem_date").agg(F.count(F.lit(1)).alias("open_orders"), F.sum("o_totalprice").alias("open_price"))


def implausible_days(spark, sf_dir):
    """Region days whose energy lies outside the band of all earlier months."""
    return plausibility.implausible_days(StarMarts(spark, sf_dir).renewable_share_daily, ["network_region"], "total_mwh")


def metric_layer_from_parts(spark, sf_dir):
    """The metric layer by region and year, from sums stored by region, group and month."""
    parts = _stored_parts(spark, sf_dir)
    return metrics.roll_up(parts, list(metrics.MEASURES), ["network_region", F.year("month").alias("yr")])


def metric_layer_total_from_parts(spark, sf_dir):
    """The metric layer by technology group, from the same stored sums."""
    return metrics.roll_up(_stored_parts(spark, sf_dir), list(metrics.MEASURES), ["fueltech_group"])


def _stored_parts(spark, sf_dir):
    parts = metrics.measure_parts(StarMarts(spark, sf_dir).generation_daily_wide)
    return tables.write_table(parts, shared_dir(spark, "parts"), order_by=("month", "network_region"))


def _sql(text: str) -> Query:
    """A question in SQL that calls the registered table functions."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql_functions.register(spark, StarMarts(spark, sf_dir))
        return spark.sql(text)

    return run


SQL_CALLS = {
    "capacity_factor_sql": "SELECT * FROM capacity_factor_between('F5', DATE'1997-03-01', DATE'1997-12-31')",
    "region_mix_sql": "SELECT * FROM region_mix('TAS1', DATE'1996-07-01', DATE'1999-06-30')",
    "region_measures_sql": "SELECT * FROM region_measures(NULL, DATE'1997-01-15', DATE'1998-12-02')",
}


def result_compare_numbers(spark, sf_dir):
    """Line prices against copies that differ by less than the tolerance on an edge of rounding, by a cent on every seventh line, and by one in a
    whole number beyond the reach of doubles."""
    lines = star.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") + F.lit(1 << 53)).alias("big"),
        "l_linenumber",
        (F.col("l_quantity") + F.lit(5e-7)).alias("edge"),
        F.col("l_extendedprice").cast("decimal(25,10)").alias("price"),
    )
    odd = F.col("l_linenumber") % 2 == 1
    seventh = F.col("l_linenumber") == 7
    cases = {
        "edge": lines.withColumn("edge", F.col("edge") + F.when(odd, 1e-9).otherwise(-1e-9)),
        "cent": lines.withColumn("edge", F.col("edge") + F.when(seventh, 0.01).otherwise(0.0)),
        "big": lines.withColumn("big", F.col("big") + F.when(seventh, 1).otherwise(0)),
        "decimal": lines.withColumn("price", F.col("price") + F.when(seventh, F.lit("1E-10").cast("decimal(11,10)")).otherwise(F.lit(0))),
    }
    verdicts = [compare.compare_results(lines, actual).select(F.lit(case).alias("answer"), "*") for case, actual in cases.items()]
    return reduce(DataFrame.unionByName, verdicts)


def run_results(spark, sf_dir):
    """Questions of stored runs, from their files."""
    found = compare.run_results(star.run_files(star.table(spark, sf_dir, "labels")))
    return found.select("eval_run_id", "created_timestamp", "result_id", "benchmark_question_id", "status", "assessment", "manual_assessment")


def message_details(spark, sf_dir):
    return conversations.message_details(star.messages(star.table(spark, sf_dir, "conversations")))


def column_profile(spark, sf_dir):
    """Columns of the facility days with their types, rows and NULLs."""
    return quality.column_profile(StarMarts(spark, sf_dir).facility_daily, "facility_daily").drop("about_distinct")


def catalog_table(spark, sf_dir):
    """The facility dimension saved below a layer's own location and read by name."""
    tables.create_namespaces(spark, ["gold"], shared_dir(spark, "layers"))
    tables.save_to_catalog(StarMarts(spark, sf_dir).dim_facility, "gold", "dim_facility")
    return spark.table("gold.dim_facility")


def stats_stream(spark, sf_dir):
    """Stats payloads in a raw table, streamed into the upserted series, then read as the long table."""
    base = shared_dir(spark, "series")
    star.stats_raw(spark, sf_dir).write.parquet(f"{base}/raw")
    table = upsert.SeriesTable(f"{base}/series")
    stream = ingest.stream_raw(spark, f"{base}/raw")
    upsert.run_upsert(region_marts.fetched_points(stream, False), table, f"{base}/checkpoint")
    return region_marts.with_groups(table.read(spark))


def unit_metrics_stream(spark, sf_dir):
    """Unit payloads in a raw table, streamed through parsing and rules into the upserted table."""
    base = shared_dir(spark, "points")
    # payloads are mostly names: row groups of which a task parses a few, packed
    packed = star.unit_metrics_raw(spark, sf_dir).write.option("compression", "zstd").option("parquet.block.size", 32 * 1024**2)
    packed.parquet(f"{base}/raw")
    table = upsert.PointTable(f"{base}/points")
    stream = ingest.stream_raw(spark, f"{base}/raw")
    upsert.run_upsert(upsert.points_of(stream), table, f"{base}/checkpoint")
    return table.read(spark)


def latest_price_by_part(spark, sf_dir):
    """Latest line of every part, on a key that the marts do not use."""
    lines = star.table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return latest_by(lines, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"])


def rules_kept(spark, sf_dir):
    kept, _ = quality.apply_rules(star.subdaily_points(_events(spark, sf_dir)), quality.POINT_RULES)
    return kept


def rules_rejected(spark, sf_dir):
    _, rejected = quality.apply_rules(star.subdaily_points(_events(spark, sf_dir)), quality.POINT_RULES)
    return rejected


def rules_rejected_counts(spark, sf_dir):
    return quality.rule_counts(star.unit_points(spark, sf_dir), quality.POINT_RULES)


def series_rule_counts(spark, sf_dir):
    """Points of the stats files that belong to no technology, which the series table must not keep."""
    return quality.rule_counts(payloads.stats_points(star.stats_raw(spark, sf_dir), False), quality.SERIES_RULES)


def _key_tables(m: Marts) -> dict:
    return {
        "dim_facility": (m.dim_facility, ["facility_code"]),
        "facility_capacity_factor": (m.facility_capacity_factor, ["facility_code", "nem_date"]),
    }


def pk_violations(spark, sf_dir):
    frame, keys = _key_tables(StarMarts(spark, sf_dir))["facility_capacity_factor"]
    return quality.pk_violations(frame, keys)


def key_counts(spark, sf_dir):
    return quality.key_counts(_key_tables(StarMarts(spark, sf_dir)))


def reconcile_counts(spark, sf_dir):
    base = shared_dir(spark, "serving")
    sources = _key_tables(StarMarts(spark, sf_dir))
    copies, counts = {}, []
    for name, (frame, keys) in sources.items():
        # the counts of the source come from the run that publishes it
        report = serving.publish_snapshot(frame, f"{base}/{name}", keys)
        counts.append((name, report["source_rows"], report["null_key_rows"]))
        copies[name] = (tables.read_table(spark, f"{base}/{name}", frame.schema), keys)
    published = spark.createDataFrame(counts, "tbl string, n bigint, null_key_rows bigint")
    return quality.reconcile(published, quality.key_counts(copies))


def snapshot_publish(spark, sf_dir):
    root = shared_dir(spark, "serving")
    frame, keys = _key_tables(StarMarts(spark, sf_dir))["facility_capacity_factor"]
    serving.publish_snapshot(frame, root, keys)
    return tables.read_table(spark, root, frame.schema)


def snapshot_lookup(spark, sf_dir):
    """Technology lookup on the published facility dimension, arrays stored as JSON text."""
    root = shared_dir(spark, "serving")
    frame, keys = _key_tables(StarMarts(spark, sf_dir))["dim_facility"]
    serving.publish_snapshot(frame, root, keys, as_json=True)
    stored = tables.read_table(spark, root, tables.flatten_for_serving(frame).schema)
    found = serving.containing(stored, "fueltech_groups", "wind")
    return found.select("facility_code", "fueltech_groups", "unit_count")


def csv_export(spark, sf_dir):
    """Facility dimension written as CSV and read back with its declared types."""
    path = shared_dir(spark, "csv")
    frame = StarMarts(spark, sf_dir).dim_facility.select("facility_code", "facility_name", "fueltech_groups", "unit_count")
    tables.export_csv(frame, path)
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .schema(tables.flatten_for_serving(frame).schema)
        .csv(path)
    )


def last_rows_each(spark, sf_dir):
    m = StarMarts(spark, sf_dir)
    rows = serving.last_rows_each(serving.keyed_rows(m.facility_capacity_factor, ["facility_code"]), ["facility_code"], 7)
    return rows.select("facility_code", "nem_date", "energy_mwh", "capacity_factor")


def coverage_report(spark, sf_dir):
    m = StarMarts(spark, sf_dir)
    names = (
        "generation_mix_daily",
        "renewable_share_daily",
        "emissions_intensity_daily",
        "facility_daily",
        "facility_capacity_factor",
    )
    return quality.coverage({n: getattr(m, n) for n in names})


def status_distribution(spark, sf_dir):
    return quality.distribution(star.dim_unit(spark, sf_dir), "status_id")


def unattributed_days(spark, sf_dir):
    return facility_marts.unattributed_days(StarMarts(spark, sf_dir).facility_daily)


def landing_gaps(spark, sf_dir):
    """Region-years that the landed stats files do not cover."""
    # from two years before the first order to two years after the last delivery
    first = star.table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")) - 2).scalar()
    last = star.table(spark, sf_dir, "lineitem").agg(F.max(F.year("l_shipdate")) + 2).scalar()
    grid = landing.region_year_grid(spark, REGIONS, first, last)
    return landing.coverage_gaps(star.stats_raw(spark, sf_dir), grid)


def chunk_gaps(spark, sf_dir):
    """Chunks of the registry's facilities without unit files, by interval."""
    grid = landing.chunk_grid(registry_codes(spark, sf_dir))
    return landing.coverage_gaps(star.unit_metrics_raw(spark, sf_dir), grid)


def metric_layer(spark, sf_dir):
    wide = StarMarts(spark, sf_dir).generation_daily_wide
    return metrics.measure(wide, list(metrics.MEASURES), ["network_region", F.year("nem_date").alias("yr")])


def metric_layer_total(spark, sf_dir):
    return metrics.measure(StarMarts(spark, sf_dir).generation_daily_wide, list(metrics.MEASURES), ["fueltech_group"])


def facility_metric_layer(spark, sf_dir):
    factors = StarMarts(spark, sf_dir).facility_capacity_factor
    return metrics.measure(factors, list(metrics.FACILITY_MEASURES), ["network_region"], metrics.FACILITY_MEASURES)


def capacity_factor_between(spark, sf_dir):
    factors = StarMarts(spark, sf_dir).facility_capacity_factor
    return metrics.facility_capacity_factor_between(factors, "F5", "1997-03-01", "1997-12-31")


def region_mix(spark, sf_dir):
    return metrics.region_mix(StarMarts(spark, sf_dir).generation_mix_daily, "TAS1", "1996-07-01", "1999-06-30")


def renewable_share_strict(spark, sf_dir):
    return region_marts.renewable_share_daily(StarMarts(spark, sf_dir).generation_daily_wide, strict_nulls=True)


def record_days(spark, sf_dir):
    """Days whose total ranks third or better, ties included."""
    mix = StarMarts(spark, sf_dir).generation_mix_daily
    days = mix.groupBy("nem_date").agg(F.sum("generated_mwh").alias("total_mwh"))
    return questions.days_of_rank(days, "total_mwh", 3)


def canonicalise_region(spark, sf_dir):
    return canonicalise(star.customer_regions(spark, sf_dir), "region_text")


def result_compare(spark, sf_dir):
    """The mix mart against the same answer in another shape, and against one without unmapped rows."""
    mix = StarMarts(spark, sf_dir).generation_mix_daily
    reshaped = mix.select(
        F.col("generated_mwh").alias("mwh"),
        F.lit("extra").alias("note"),
        F.col("fueltech_group").alias("technology"),
        F.col("network_region").alias("region"),
        F.col("nem_date").alias("day"),
    )
    cases = {"reshaped": reshaped, "mapped_only": mix.where(F.col("fueltech_group").isNotNull())}
    verdicts = [
        compare.compare_results(mix, actual).select(F.lit(case).alias("answer"), "*") for case, actual in cases.items()
    ]
    return verdicts[0].unionByName(verdicts[1])


def score_run(spark, sf_dir):
    labels = star.table(spark, sf_dir, "labels")
    both = star.run_assessments(labels, "baseline").unionByName(star.run_assessments(labels, "curated"))
    return compare.score_run(both)


def score_delta(spark, sf_dir):
    labels = star.table(spark, sf_dir, "labels")
    return compare.score_delta(star.run_assessments(labels, "baseline"), star.run_assessments(labels, "curated"))


def turn_pairs(spark, sf_dir):
    return conversations.pair_turns(star.table(spark, sf_dir, "conversations"))


def conversation_usage(spark, sf_dir):
    return conversations.conversation_usage(star.messages(star.table(spark, sf_dir, "conversations")))


def usage_summary(spark, sf_dir):
    return conversations.usage_summary(conversation_usage(spark, sf_dir))


def stale_conversations(spark, sf_dir):
    events = _events(spark, sf_dir)
    now = events.agg(F.max(F.col("ts").cast("timestamp"))).scalar()
    return conversations.mark_stale(star.conversation_times(events), now, 24)


MARTS = (
    "dim_unit",
    "generation_daily_by_fueltech",
    "demand_daily",
    "generation_daily_wide",
    "generation_mix_daily",
    "renewable_share_daily",
    "emissions_intensity_daily",
    "facility_daily",
    "facility_capacity_factor",
    "dim_facility",
    "demand_vs_generation",
)

OPERATORS = (
    registry_roundtrip,
    registry_codes,
    stats_roundtrip,
    demand_daily_roundtrip,
    unit_metrics_roundtrip,
    stats_ingest_stream,
    registry_ingest_stream,
    unit_files_ingest_stream,
    series_restart,
    quarantined_files,
    stored_mix,
    scd1_batch,
    scd1_stream,
    unit_metrics_stream,
    stats_stream,
    latest_price_by_part,
    rules_kept,
    rules_rejected,
    rules_rejected_counts,
    series_rule_counts,
    pk_violations,
    key_counts,
    reconcile_counts,
    snapshot_publish,
    snapshot_lookup,
    csv_export,
    last_rows_each,
    coverage_report,
    status_distribution,
    unattributed_days,
    landing_gaps,
    chunk_gaps,
    metric_layer,
    metric_layer_total,
    facility_metric_layer,
    capacity_factor_between,
    region_mix,
    renewable_share_strict,
    record_days,
    canonicalise_region,
    unmatched_regions,
    result_compare,
    score_run,
    score_delta,
    turn_pairs,
    conversation_usage,
    usage_summary,
    stale_conversations,
    scd1_stateful,
    evolved_points,
    replayed_points,
    expired_points,
    stream_rule_totals,
    unknown_fields,
    units_listed_twice,
    spans_covering_days,
    implausible_days,
    metric_layer_from_parts,
    metric_layer_total_from_parts,
    result_compare_numbers,
    run_results,
    message_details,
    column_profile,
    catalog_table,
)


# lookups that run on a published copy: mart and key
PUBLISHED = {
    "l0": ("dim_facility", ["facility_code"]),
    "l1": ("dim_facility", ["facility_code"]),
    "l2": ("facility_capacity_factor", ["facility_code", "nem_date"]),
    "l3": ("dim_facility", ["facility_code"]),
}


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {name: _mart(name) for name in MARTS}
    found.update({fn.__name__: fn for fn in OPERATORS})
    found.update({name: _sql(text) for name, text in SQL_CALLS.items()})
    found.update({name: _question(name) for name in questions.QUESTIONS})
    found.update({key: _published(key) for key in PUBLISHED})
    found.update({fn.__name__: _variant(fn) for fn in variants.VARIANTS})
    return {name: _finished(query) for name, query in found.items()}


def _finished(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_settings(spark)
        size_shuffles(spark, sf_dir)
        size_scans(spark)
        return portable(query(spark, sf_dir))

    return run
