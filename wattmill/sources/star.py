"""The bundled star-schema tables read as an electricity market.

Parts are units, suppliers are facilities, line items are daily unit points, events are sub-daily
unit points, customers' orders are region demand. Everything stays a lazy plan over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattmill.functions.calendar import market_midnight
from wattmill.functions.regions import REGION_SYNONYMS
from wattmill.functions.taxonomy import FUELTECH_GROUPS, UNGROUPED_FUELTECHS, group_of, renewable_flag
from wattmill.operators.conversations import pair_turns
from wattmill.session import cores
from wattmill.sources.landing import FETCHED_AT_FORMAT, chunk_name, path_key
from wattmill.sources.tables import conform

# Fixture region name to market region, event type to metric.
REGION_OF = {"AFRICA": "NSW1", "AMERICA": "QLD1", "ASIA": "SA1", "EUROPE": "TAS1", "MIDDLE EAST": "VIC1"}
METRIC_OF_EVENT = {"view": "energy", "click": "power", "purchase": "market_value", "signup": "emissions"}
UNIT_OF_METRIC = {"energy": "MWh", "power": "MW", "market_value": "AUD", "emissions": "t"}

FUELTECH_OF_BRAND = (*FUELTECH_GROUPS, *UNGROUPED_FUELTECHS)


# Declared, so that building a plan reads no file footers.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _lookup(entries: dict[str, str], key: Column | str) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for e in entries.items() for x in e]), key)


def _fueltech() -> Column:
    number = F.substring("p_brand", 7, 2).cast("int")
    return F.element_at(F.array(*map(F.lit, FUELTECH_OF_BRAND)), number)


def _join_facility(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add supplier, nation and region of a part. Left-deep over base tables, whose sizes Spark knows.

    The slot is a column of its own: a subquery inside a join key fails when that side is broadcast.
    """
    supplier = table(spark, sf_dir, "supplier")
    slots = supplier.agg(F.max("s_suppkey") + 1).scalar()
    return (
        df.withColumn("slot", F.col("p_partkey") % slots)
        .join(supplier, F.col("slot") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def _network() -> Column:
    return F.when(F.col("s_acctbal") < 0, "WEM").otherwise("NEM")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All units of all networks, in the source's names."""
    joined = _join_facility(table(spark, sf_dir, "part"), spark, sf_dir)
    code = _fueltech()
    retired = (F.col("s_suppkey") % 10 == 7) | (F.col("p_type") == "SMALL")
    return joined.select(
        F.concat(F.lit("U"), "p_partkey").alias("unit_code"),
        F.concat(F.lit("F"), "s_suppkey").alias("facility_code"),
        F.col("s_name").alias("facility_name"),
        _network().alias("network_id"),
        _lookup(REGION_OF, "r_name").alias("network_region"),
        (F.lit(-20.0) - F.col("n_nationkey")).alias("lat"),
        (F.lit(115.0) + F.col("n_nationkey")).alias("lng"),
        code.alias("fueltech_id"),
        F.when(retired, "retired").when(F.col("p_type") == "PROMO", "committed").otherwise("operating").alias("status_id"),
        F.when(code.isin("battery_charging", "pumps"), "LOAD").otherwise("GENERATOR").alias("dispatch_type"),
        F.col("p_size").cast("double").alias("capacity_registered"),
        (F.col("p_size") * F.lit(1.1)).alias("capacity_maximum"),
        (F.col("p_retailprice") / 1000).alias("emissions_factor_co2"),
    )


def dim_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = registry(spark, sf_dir).where(F.col("network_id") == "NEM")
    group = group_of(F.col("fueltech_id"))
    return conform(
        units.withColumnsRenamed(
            {"capacity_registered": "capacity_registered_mw", "capacity_maximum": "capacity_maximum_mw"}
        ).withColumns({"fueltech_group": group, "is_renewable": renewable_flag(group)}),
        "dim_unit",
    )


def _line_metrics() -> dict[str, Column]:
    """Energy, emissions and revenue of a line item; energy is unknown where no tax is given."""
    energy = F.when(F.col("l_tax") != 0, F.col("l_quantity"))
    return {
        "energy": F.when(_fueltech() == "battery_charging", -energy).otherwise(energy),
        "emissions": F.col("l_quantity") * F.col("l_discount"),
        "market_value": F.col("l_extendedprice"),
    }


def _long(metrics: dict[str, Column], units: dict[str, str]) -> Column:
    rows = [
        F.struct(F.lit(m).alias("metric"), v.alias("value"), F.lit(units[m]).alias("uom")) for m, v in metrics.items()
    ]
    return F.inline(F.array(*rows))


def series_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day, region, fuel technology, metric, value and unit; energy in GWh as the source gives it."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    sums = (
        _join_facility(lines, spark, sf_dir)
        .where(_network() == "NEM")
        .select(
            F.to_date("l_shipdate").alias("nem_date"),
            _lookup(REGION_OF, "r_name").alias("network_region"),
            _fueltech().alias("fueltech_id"),
            *[v.alias(m) for m, v in _line_metrics().items()],
        )
        .groupBy("nem_date", "network_region", "fueltech_id")
        .agg(*[F.sum(m).alias(m) for m in _line_metrics()])
    )
    metrics = {"energy": F.col("energy") / 1000, "emissions": F.col("emissions"), "market_value": F.col("market_value")}
    return sums.select("nem_date", "network_region", "fueltech_id", _long(metrics, {**UNIT_OF_METRIC, "energy": "GWh"}))


def generation_daily_by_fueltech(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = group_of(F.col("fueltech_id"))
    series = series_daily(spark, sf_dir).withColumnRenamed("value", "generated")
    return conform(
        series.withColumns({"fueltech_group": group, "is_renewable": renewable_flag(group)}),
        "generation_daily_by_fueltech",
    )


def demand_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily demand of the customers' regions: energy in GWh and its market value."""
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    sums = orders.groupBy(
        F.to_date("o_orderdate").alias("nem_date"), _lookup(REGION_OF, "r_name").alias("network_region")
    ).agg(F.sum("o_totalprice").alias("price"))
    metrics = {"energy": F.col("price") / 1000, "market_value": F.col("price")}
    long = sums.select("nem_date", "network_region", _long(metrics, {**UNIT_OF_METRIC, "energy": "GWh"}))
    return conform(long, "demand_daily")


def _daily_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(
        F.concat(F.lit("U"), "l_partkey").alias("unit_code"),
        market_midnight(F.to_date("l_shipdate")).alias("interval_ts_utc"),
        F.lit("1d").alias("interval"),
        F.timestamp_seconds(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingested_at"),
        F.to_date("l_shipdate").alias("day"),
        *[v.alias(m) for m, v in _line_metrics().items()],
    )


def daily_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily unit points, several fetches of the same point included."""
    metrics = {m: F.col(m) for m in _line_metrics()}
    return _daily_lines(spark, sf_dir).select(
        "unit_code", "interval_ts_utc", "interval", "ingested_at", _long(metrics, UNIT_OF_METRIC)
    )


def subdaily_points(events: DataFrame) -> DataFrame:
    """Sub-daily unit points from an events table, batch or stream. Error events have no metric."""
    metric = _lookup(METRIC_OF_EVENT, "event_type")
    return events.select(
        F.concat(F.lit("U"), "user_id").alias("unit_code"),
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("interval_ts_utc"),
        F.lit("5m").alias("interval"),
        F.timestamp_seconds("event_id").alias("ingested_at"),
        metric.alias("metric"),
        "value",
        _lookup(UNIT_OF_METRIC, metric).alias("uom"),
    )


def unit_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_points(spark, sf_dir).unionByName(subdaily_points(table(spark, sf_dir, "events")))


def unit_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of ``unit_points`` by fetch: the metrics of a line item side by side, as structs, and an event as a single one of ``points``."""
    point = "struct<value: double, uom: string>"
    points = "array<struct<metric: string, value: double, uom: string>>"
    lines = _daily_lines(spark, sf_dir).select(
        "unit_code", "interval_ts_utc", "interval", "ingested_at",
        *[F.struct(F.col(m).alias("value"), F.lit(UNIT_OF_METRIC[m]).alias("uom")).alias(m) for m in _line_metrics()],
        F.lit(None).cast(points).alias("points"),
    )
    events = subdaily_points(table(spark, sf_dir, "events")).select(
        "unit_code", "interval_ts_utc", "interval", "ingested_at",
        *[F.lit(None).cast(point).alias(m) for m in _line_metrics()],
        F.array(F.struct("metric", "value", "uom")).alias("points"),
    )
    return lines.unionByName(events)


# --- the same data written back as raw payload files ---------------------------------------------

FIRST_FETCH = "2002-01-01T000000Z"
SECOND_FETCH = "2002-02-01T000000Z"


def _raw(df: DataFrame, payload: Column, path: Column) -> DataFrame:
    """A raw-file table: payload text, path, and the time of the file."""
    return df.select(
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("raw_json"),
        path.alias("source_file"),
        F.lit("2002-03-01 00:00:00").cast("timestamp").alias("ingested_at"),
    )


def registry_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fetches of the registry, one unit per file; the older one gives every unit twice its capacity."""
    fetches = F.explode(F.array(F.lit(FIRST_FETCH), F.lit(SECOND_FETCH)))
    units = registry(spark, sf_dir).withColumn("fetch", fetches)
    stale = F.when(F.col("fetch") == FIRST_FETCH, 2.0).otherwise(1.0)
    unit = F.struct(
        F.col("unit_code").alias("code"),
        "fueltech_id",
        "status_id",
        "dispatch_type",
        (F.col("capacity_registered") * stale).alias("capacity_registered"),
        "capacity_maximum",
        "emissions_factor_co2",
    )
    facility = F.struct(
        F.col("facility_code").alias("code"),
        F.col("facility_name").alias("name"),
        "network_id",
        "network_region",
        F.struct("lat", "lng").alias("location"),
        F.array(unit).alias("units"),
    )
    path = F.concat(F.lit("/landing/facilities/fetched_at="), "fetch", F.lit("/part-"), "unit_code", F.lit(".json"))
    return _raw(units, F.struct(F.lit(True).alias("success"), F.array(facility).alias("data")), path)


def registry_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry files of a source that has moved on: new fields on some facilities and units, and some capacities as text."""
    capacity = F.col("capacity_registered")
    unit = F.struct(
        F.col("unit_code").alias("code"),
        "fueltech_id",
        "capacity_registered",
        F.when(capacity > 40, capacity * 2).alias("storage_mwh"),
    )
    facility = F.struct(
        F.col("facility_code").alias("code"),
        F.when(F.col("network_id") == "WEM", F.struct(F.col("facility_name").alias("name"))).alias("owner"),
        "network_id",
        F.array(unit).alias("units"),
    )
    files = F.to_json(F.struct(F.array(facility).alias("data")))
    quoted = F.regexp_replace(files, '"capacity_registered":([0-9.]+)', '"capacity_registered":"$1"')
    return registry(spark, sf_dir).select(
        F.when(capacity % 7 == 0, quoted).otherwise(files).alias("raw_json"),
        F.concat(F.lit("/landing/facilities/fetched_at="), F.lit(SECOND_FETCH), F.lit("/part-"), "unit_code", F.lit(".json")).alias("source_file"),
        F.lit("2002-03-01 00:00:00").cast("timestamp").alias("ingested_at"),
    )


def _positional(values: DataFrame, key: list[str]) -> DataFrame:
    """Dated values as one array per key and year, gaps as NULL. An array holds at most 366 values."""
    yearly = values.groupBy(*key, F.year("nem_date").alias("year")).agg(
        F.min("nem_date").alias("first"),
        F.max("nem_date").alias("last"),
        F.map_from_entries(F.collect_list(F.struct("nem_date", "value"))).alias("by_day"),
    )
    days = F.transform(F.sequence("first", "last"), lambda d: F.try_element_at("by_day", d))
    start, last = (F.concat(F.col(c).cast("string"), F.lit("T00:00:00+10:00")) for c in ("first", "last"))
    history = F.struct(start.alias("start"), last.alias("last"), F.lit("1d").alias("interval"), days.alias("data"))
    return yearly.select(*key, "year", history.alias("history"))


def stats_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region-year files with generation and demand series, each fetched twice.

    A file has a fixed number of series (25 technologies by 3 metrics, and 2 of demand), so its size
    does not grow with the data. The older fetch gives every value one more.
    """
    made = _positional(series_daily(spark, sf_dir), ["network_region", "fueltech_id", "metric", "uom"])
    used = _positional(demand_daily(spark, sf_dir), ["network_region", "metric", "uom"])
    used = used.withColumn("fueltech_id", F.lit(None).cast("string"))
    both = made.unionByName(used)
    family = F.coalesce(F.concat(F.lit("fuel_tech."), "fueltech_id"), F.lit("demand"))
    fetched = both.select(
        "*",
        F.concat_ws(".", F.lit("au.nem"), F.lower("network_region"), family, "metric").alias("id"),
        F.explode(F.array(F.lit(FIRST_FETCH), F.lit(SECOND_FETCH))).alias("fetch"),
    )
    older = F.col("fetch") == FIRST_FETCH
    values = F.transform("history.data", lambda v: F.when(older, v + 1).otherwise(v))
    series = F.struct(
        "id",
        F.col("metric").alias("type"),
        F.col("fueltech_id").alias("fuel_tech"),
        F.col("network_region").alias("region"),
        F.col("uom").alias("units"),
        F.col("history").withField("data", values).alias("history"),
    )
    files = fetched.groupBy("network_region", "year", "fetch").agg(F.collect_list(series).alias("data"))
    payload = F.struct(
        F.lit("energy").alias("type"), F.lit("nem").alias("network"), F.col("network_region").alias("region"), "data"
    )
    path = F.concat(
        F.lit("/landing/stats/region="), "network_region", F.lit("/year="), "year",
        F.lit("/fetched_at="), "fetch", F.lit("/part-000.json"),
    )
    return _raw(files, payload, path)


def unit_metrics_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per line item with its three metrics, fetched at the time its sequence stands for.

    Its chunk is that of its facility, thirty to a chunk.
    """
    slots = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey") + 1).scalar()
    slot = F.substring("unit_code", 2, 20).cast("bigint") % slots
    chunk = chunk_name(F.floor(slot / 30))
    lines = _daily_lines(spark, sf_dir)
    when = F.concat(F.col("day").cast("string"), F.lit("T00:00:00+10:00"))

    def block(metric: str) -> Column:
        result = F.struct(
            F.concat(F.lit(f"{metric}_"), "unit_code").alias("name"),
            F.struct("unit_code").alias("columns"),
            F.array(F.array(when, F.col(metric).cast("string"))).alias("data"),
        )
        return F.struct(
            F.lit(metric).alias("metric"),
            F.lit(UNIT_OF_METRIC[metric]).alias("unit"),
            "interval",
            F.array(result).alias("results"),
        )

    path = F.concat(
        F.lit("/landing/facility_data/interval="), "interval", F.lit("/chunk="), chunk, F.lit("/unit="), "unit_code",
        F.lit("/fetched_at="), F.date_format("ingested_at", FETCHED_AT_FORMAT), F.lit("/part-000.json"),
    )
    blocks = F.array(*[block(m) for m in _line_metrics()])
    return _raw(lines, F.struct(F.lit(True).alias("success"), blocks.alias("data")), path)


def unit_files_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points as a real fetch holds them: one file per interval, chunk of facilities, year and fetch, with a block per metric.

    The n-th value of a point comes with the n-th fetch. A file is bounded by its chunk and year.
    """
    slots = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey") + 1).scalar()
    chunk = chunk_name(F.floor(F.substring("unit_code", 2, 20).cast("bigint") % slots / 30))
    nth = F.row_number().over(Window.partitionBy("unit_code", "day").orderBy("ingested_at"))
    # numbered and dealt to their files: the groups below lie within a file and shuffle no more, and a line is one row of them for all its
    # metrics. The interval is left out, since Spark drops a constant from the groups and would no longer see that they are dealt
    file = ["interval", "chunk", "year", "fetch"]
    lines = _daily_lines(spark, sf_dir).withColumn("nth", nth).select(
        "interval",
        chunk.alias("chunk"),
        F.year("day").alias("year"),
        F.date_format(F.timestamp_seconds(F.col("nth") * 86_400), FETCHED_AT_FORMAT).alias("fetch"),
        "unit_code",
        "day",
        *_line_metrics(),
    ).repartition("chunk", "year", "fetch")
    when = F.concat(F.col("day").cast("string"), F.lit("T00:00:00+10:00"))
    metrics = list(_line_metrics())
    points = [F.collect_list(F.array(when, F.col(m).cast("string"))).alias(m) for m in metrics]
    series = lines.groupBy(*file, "unit_code").agg(*points)
    results = [
        F.collect_list(F.struct(F.concat_ws("_", F.lit(m), "unit_code").alias("name"), F.struct("unit_code").alias("columns"), F.col(m).alias("data"))).alias(m)
        for m in metrics
    ]
    block = [F.struct(F.lit(m).alias("metric"), F.lit(UNIT_OF_METRIC[m]).alias("unit"), "interval", F.col(m).alias("results")) for m in metrics]
    files = series.groupBy(*file).agg(*results).withColumn("data", F.array(*block))
    path = F.concat(
        F.lit("/landing/facility_data/interval="), "interval", F.lit("/chunk="), "chunk", F.lit("/year="), "year",
        F.lit("/fetched_at="), "fetch", F.lit("/part-000.json"),
    )
    return _raw(files, F.struct(F.lit(True).alias("success"), "data"), path)


# Payloads repeat the same names, which the fastest level of gzip packs nearly as well.
FAST_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

# On a local disk Hadoop puts a checksum file beside each file, and starts a process for either to set its mode. Gzip has a checksum of its own.
NO_SIDE_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def land(raw: DataFrame, folder: str, *keys: str) -> None:
    """Write payloads as packed files below ``folder``, in one subfolder per value of each path key."""
    spark = raw.sparkSession
    # a file costs far more than the text in it, so files are dealt one by one to all cores, however few folders they go to
    own = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions")
    dealt = raw.repartition(max(int(own), 4 * cores(spark)), "source_file")
    keyed = dealt.select("raw_json", *[path_key(k).alias(k) for k in keys])
    # a file holds one payload: a reader of whole files sees what lies in a file as one text
    files = keyed.write.mode("append").option("maxRecordsPerFile", 1).options(**FAST_GZIP, **NO_SIDE_FILES)
    files.partitionBy(*keys).text(folder)


def land_stats(raw: DataFrame, landing: str) -> None:
    """Write region-year payloads as files in the landing layout, one file per region, year and fetch."""
    land(raw, f"{landing}/stats", "region", "year", "fetched_at")


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their region as people write it: code, name, short form, odd case and spaces, or unknown."""
    joined = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    code = _lookup(REGION_OF, "r_name")
    names = {c: n[0] for c, n in REGION_SYNONYMS.items()}
    shorts = {c: n[1] for c, n in REGION_SYNONYMS.items()}
    shouted = F.upper(F.concat(F.lit("  "), _lookup(names, code)))
    forms = F.array(code, _lookup(names, code), _lookup(shorts, code), shouted, F.lit("Territory"))
    return joined.select("c_custkey", F.get(forms, (F.col("c_custkey") % 5).cast("int")).alias("region_text"))


# --- conversations and evaluation runs -----------------------------------------------------------


def messages(turns: DataFrame) -> DataFrame:
    """User turns as messages in the service's shape; an answer becomes a query or a text attachment."""
    pairs = pair_turns(turns)
    size = F.length("answer")
    is_query = size % 2 == 0
    curated = size % 4 == 0
    query = F.struct(
        F.col("answer").alias("query"),
        F.concat(F.lit("answers "), F.substring("question", 1, 20)).alias("description"),
        F.lit(None).cast("string").alias("title"),
        F.when(curated, F.concat(F.lit("asset-"), "conv_id")).alias("instruction_id"),
        F.when(curated & (size % 8 == 0), F.concat(F.lit("Asset "), "conv_id")).alias("instruction_title"),
        F.lit(None).cast("string").alias("statement_id"),
        F.struct(size.cast("bigint").alias("row_count"), (size > 300).alias("is_truncated")).alias("query_result_metadata"),
    )
    attachment = F.struct(
        F.concat_ws("-", F.lit("a"), "conv_id", "turn").alias("attachment_id"),
        F.when(is_query, query).alias("query"),
        F.when(~is_query, F.struct(F.col("answer").alias("content"))).alias("text"),
        F.when(~is_query, F.struct(F.array("question").alias("questions"))).alias("suggested_questions"),
    )
    created = F.col("conv_id") * 100_000 + F.col("turn") * 1_000
    return pairs.select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.col("conv_id").cast("string").alias("conversation_id"),
        F.concat(F.lit("space-"), F.col("conv_id") % 3).alias("space_id"),
        F.when(F.col("answer").isNull(), F.struct(F.lit("no answer").alias("error"), F.lit("TIMEOUT").alias("type"))).alias("error"),
        F.when(F.col("answer").isNull(), "FAILED").otherwise("COMPLETED").alias("status"),
        F.col("question").alias("content"),
        created.alias("created_timestamp"),
        F.when(F.col("answer").isNotNull(), created + size).alias("last_updated_timestamp"),
        F.when(F.col("answer").isNotNull(), F.array(attachment)).alias("attachments"),
    )


def conversation_times(events: DataFrame) -> DataFrame:
    """Users as conversations: first event as creation, last one as update."""
    at = F.col("ts").cast("timestamp")
    return events.groupBy(F.col("user_id").alias("conversation_id")).agg(
        F.min(at).alias("created"), F.max(at).alias("last_updated")
    )


def run_assessments(labels: DataFrame, run: str) -> DataFrame:
    """Labels as the assessed questions of a run; the second run trusts quality alone."""
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    first = F.when(toxic, "NEEDS_REVIEW").when(good, "GOOD").otherwise("BAD")
    second = F.when(good, "GOOD").otherwise("BAD")
    return labels.select(
        F.lit(run).alias("eval_run_id"),
        F.col("doc_id").cast("string").alias("benchmark_question_id"),
        (first if run == "baseline" else second).alias("assessment"),
    )


def run_files(labels: DataFrame) -> DataFrame:
    """Stored evaluation runs as files: the assessed questions in files of some thousand, so that no file grows with the data."""
    both = run_assessments(labels, "baseline").unionByName(run_assessments(labels, "curated"))
    question = F.struct(
        F.concat_ws("-", "eval_run_id", "benchmark_question_id").alias("result_id"),
        "benchmark_question_id",
        F.lit("DONE").alias("status"),
        "assessment",
        (F.col("assessment") == "NEEDS_REVIEW").alias("manual_assessment"),
    )
    part = F.floor(F.col("benchmark_question_id").cast("bigint") / 1000)
    files = both.groupBy("eval_run_id", part.alias("part")).agg(F.collect_list(question).alias("results"))
    run = F.struct(F.lit("space-1").alias("space_id"), "eval_run_id", F.lit("DONE").alias("eval_run_status"), (F.col("part") + 1).alias("created_timestamp"), "results")
    return files.select(F.to_json(run).alias("raw_json"))


def order_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders by region as spans of days: some of a day, some of weeks, and every two-hundredth of years."""
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    opened = F.to_date("o_orderdate")
    days = F.when(F.col("o_orderkey") % 200 == 0, 1000).otherwise(F.col("o_orderkey") % 10).cast("int")
    return orders.select(
        _lookup(REGION_OF, "r_name").alias("network_region"), opened.alias("opened"), F.date_add(opened, days).alias("closed"), "o_totalprice"
    )
