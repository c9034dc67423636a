"""One refresh: new files to raw tables, raw tables to silver, silver to gold."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.operators import dimensions, facility_marts, quality, region_marts
from wattmill.plans.marts import Marts, SilverMarts
from wattmill.session import require_utc, size_shuffles
from wattmill.sources import versions
from wattmill.sources.payloads import REGISTRY, STATS, UNIT_METRICS, empty_series, quarantine, stats_points
from wattmill.sources.tables import conform, declared, read_table, write_table
from wattmill.streaming.ingest import append, ingest, read_raw, stream_raw
from wattmill.streaming.upsert import PointTable, SeriesTable, points_of, run_upsert

FAMILIES = {"facilities": REGISTRY, "stats": STATS, "facility_data": UNIT_METRICS}

# One shuffle partition for this much of the warehouse: a refresh moves what is new, not all that is stored.
HISTORY_PER_PARTITION = 512 * 1024**2

# Marts that are stored whole, with their sort keys.
GOLD_LAYOUT = {"dim_facility": ("facility_code",)}

# Marts that are stored by period: the first characters of the day that name it (a year, a month), and the
# sort keys. The second key splits a date that holds very many rows.
PERIODS = {
    "generation_daily_wide": (4, ("nem_date", "network_region", "fueltech_id")),
    "generation_mix_daily": (4, ("nem_date", "network_region", "fueltech_group")),
    "renewable_share_daily": (4, ("nem_date", "network_region")),
    "emissions_intensity_daily": (4, ("nem_date", "network_region")),
    "facility_daily": (7, ("nem_date", "facility_code")),
    "facility_capacity_factor": (7, ("nem_date", "facility_code")),
}

# Region marts and the stored one that each is made from.
REGION_MARTS = {
    "generation_mix_daily": ("generation_daily_wide", region_marts.generation_mix_daily),
    "renewable_share_daily": ("generation_daily_wide", region_marts.renewable_share_daily),
    "emissions_intensity_daily": ("generation_daily_wide", region_marts.emissions_intensity_daily),
}


@dataclass(frozen=True)
class Warehouse:
    """Where everything lives. ``generation`` changes when history is replayed into a new target.

    ``archive`` takes finished files out of the landing folder, which bounds what the file stream lists and remembers.
    """

    landing: str
    base: str
    generation: int = 0
    archive: str | None = None

    def raw(self, family: str) -> str:
        return f"{self.base}/bronze/{family}_raw"

    def checkpoint(self, job: str) -> str:
        return f"{self.base}/checkpoints/{job}-g{self.generation}"

    def points(self) -> PointTable:
        return PointTable(f"{self.base}/silver/facility_generation-g{self.generation}")

    def series(self) -> SeriesTable:
        return SeriesTable(f"{self.base}/silver/generation_series-g{self.generation}", quality.SERIES_RULES)

    def demand(self) -> SeriesTable:
        return SeriesTable(f"{self.base}/silver/demand_series-g{self.generation}", quality.DEMAND_RULES)

    def table(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}"


def ingest_all(spark: SparkSession, w: Warehouse) -> None:
    for family in FAMILIES:
        archive = f"{w.archive}/{family}" if w.archive else None
        ingest(spark, f"{w.landing}/{family}", w.raw(family), f"{w.base}/checkpoints/raw-{family}", archive=archive)


def quarantined(spark: SparkSession, w: Warehouse) -> dict[str, DataFrame]:
    """Files of each family that hold no readable payload."""
    return {family: quarantine(read_raw(spark, w.raw(family)), shape) for family, shape in FAMILIES.items()}


def rule_report(spark: SparkSession, w: Warehouse) -> DataFrame:
    """Passed and failed rows of every rule over the raw tables, and how many files were unreadable."""
    raw = {family: read_raw(spark, w.raw(family)) for family in FAMILIES}
    checks = {
        "dim_unit": quality.rule_counts(dimensions.unit_rows(raw["facilities"]), quality.UNIT_RULES),
        "generation_daily_by_fueltech": quality.rule_counts(stats_points(raw["stats"], False), quality.SERIES_RULES),
        "demand_daily": quality.rule_counts(stats_points(raw["stats"], True), quality.DEMAND_RULES),
        "facility_generation": quality.rule_counts(points_of(raw["facility_data"]), quality.POINT_RULES),
    }
    for family, shape in FAMILIES.items():
        readable = quality.Rule("readable_payload", "parsed.data IS NOT NULL")
        parsed = raw[family].select(F.from_json("raw_json", shape).alias("parsed"))
        checks[f"{family}_raw"] = quality.rule_counts(parsed, [readable])
    return reduce(
        DataFrame.unionByName, [counts.select(F.lit(name).alias("tbl"), "*") for name, counts in checks.items()]
    )


def _fingerprint(df: DataFrame) -> str:
    """Order-free checksum of a table; one row comes back."""
    return str(df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()[0])


def refresh_periods(spark: SparkSession, w: Warehouse, name: str, wanted: dict[tuple[str, str, str], object], build) -> DataFrame:
    """Recompute a daily mart only for periods that changed.

    ``wanted`` has a key (period, what the period is made of, what else it depends on) for every period, and what ``build`` needs for it.
    The key is the stored period's name, so a period with all unchanged is carried over; a new registry, say, rebuilds all.
    """
    root = w.table("gold", name)
    length, layout = PERIODS[name]
    now = versions.current(spark, root)
    live = {part: own for part, own in now.live.items() if part in wanted}
    changed = {part[0]: (part, made_of) for part, made_of in wanted.items() if part not in live}
    if changed or len(live) != len(now.live):
        number = now.number + 1
        if changed:
            dated = build([m for _, m in changed.values()]).withColumn("period", F.substring(F.col("nem_date").cast("string"), 1, length))
            laid_out = dated.repartitionByRange("period", *layout).sortWithinPartitions("period", *layout)
            laid_out.write.mode("overwrite").partitionBy("period").parquet(f"{root}/data/table_version={number}")
            written = versions.written_parts(spark, root, number, ["period"])
            shape = _with_period(name).json()
            # a period whose rows were all dropped leaves no folder
            live.update({changed[period][0]: [versions.Folder(folder, shape=shape)] for (period,), folder in written.items()})
        versions.commit(spark, root, versions.Version(number, live=live))
    return read_periods(spark, w, name)


def _with_period(name: str) -> T.StructType:
    return T.StructType([*declared(name).fields]).add("period", T.StringType())


def _read(spark: SparkSession, w: Warehouse, name: str, folders: list[versions.Folder]) -> DataFrame:
    return conform(versions.read(spark, w.table("gold", name), _with_period(name), folders).drop("period"), name)


def read_periods(spark: SparkSession, w: Warehouse, name: str) -> DataFrame:
    return _read(spark, w, name, versions.current(spark, w.table("gold", name)).folders())


def refresh_wide(spark: SparkSession, w: Warehouse) -> DataFrame:
    """The wide region mart follows the folders with the year's series."""
    series = w.series()
    parts = series.live(spark)
    wanted = {(part[0], ";".join(f"{series.root}/{f.dir}" for f in own), ""): {part: own} for part, own in parts.items()}

    def build(years: list) -> DataFrame:
        chosen = {part: own for year in years for part, own in year.items()}
        return region_marts.generation_daily_wide(region_marts.with_groups(series.read_parts(spark, chosen)))

    return refresh_periods(spark, w, "generation_daily_wide", wanted, build)


def refresh_from(spark: SparkSession, w: Warehouse, name: str, source: str, make) -> DataFrame:
    """A mart that follows the stored periods of another."""
    live = versions.current(spark, w.table("gold", source)).live
    wanted = {(part[0], own[0].dir, ""): own[0] for part, own in live.items()}
    return refresh_periods(spark, w, name, wanted, lambda folders: make(_read(spark, w, source, folders)))


def refresh_facility_daily(spark: SparkSession, w: Warehouse, units: DataFrame, names: str) -> DataFrame:
    """Facility days follow the folders with the month's daily points."""
    points = w.points()
    parts = points.live_of(spark, ["1d"])
    wanted = {
        (part[1], ";".join(f"{points.root}/{f.dir}" for f in own), names): {part: own} for part, own in parts.items()
    }

    def build(months: list) -> DataFrame:
        chosen = {part: own for month in months for part, own in month.items()}
        return facility_marts.facility_daily(points.read_parts(spark, chosen), units)

    return refresh_periods(spark, w, "facility_daily", wanted, build)


def refresh_capacity_factor(spark: SparkSession, w: Warehouse, units: DataFrame, names: str) -> DataFrame:
    """Capacity factors follow the stored months of facility days."""
    live = versions.current(spark, w.table("gold", "facility_daily")).live
    wanted = {(part[0], own[0].dir, names): own[0] for part, own in live.items()}

    def build(folders: list) -> DataFrame:
        return facility_marts.facility_capacity_factor(_read(spark, w, "facility_daily", folders), units)

    return refresh_periods(spark, w, "facility_capacity_factor", wanted, build)


def keep_rejects(spark: SparkSession, w: Warehouse) -> None:
    """Unreadable files and series without values, added as they come in; registry rows that break a rule, as of now."""
    found = {f"{family}_quarantine": (family, lambda raw, shape=shape: quarantine(raw, shape)) for family, shape in FAMILIES.items()}
    found["stats_empty_series"] = ("stats", empty_series)
    for name, (family, pick) in found.items():
        append(pick(stream_raw(spark, w.raw(family))), w.table("silver", name), w.checkpoint(name))
    registry = read_raw(spark, w.raw("facilities"))
    _, rejected = quality.apply_rules(dimensions.unit_rows(registry), quality.UNIT_RULES)
    write_table(rejected, w.table("silver", "dim_unit_rejected"))
    write_table(dimensions.units_listed_twice(registry), w.table("silver", "dim_unit_listed_twice"))


def refresh(spark: SparkSession, w: Warehouse) -> Marts:
    """Bring every table up to date; safe to run again, also after a crash.

    Raw files, rejects, unit points and series advance by what is new, and region and facility marts by the years and months
    that it touches. Each stored table feeds the next, so no plan reaches back over two layers.
    """
    require_utc(spark)
    ingest_all(spark, w)
    size_shuffles(spark, w.base, per=HISTORY_PER_PARTITION)
    keep_rejects(spark, w)
    run_upsert(points_of(stream_raw(spark, w.raw("facility_data"))), w.points(), w.checkpoint("points"))
    for table, demand, job in ((w.series(), False, "series"), (w.demand(), True, "demand")):
        stats = stream_raw(spark, w.raw("stats"))
        run_upsert(region_marts.fetched_points(stats, demand), table, w.checkpoint(job))
    units = write_table(dimensions.dim_unit(read_raw(spark, w.raw("facilities"))), w.table("silver", "dim_unit"))
    series = region_marts.with_groups(w.series().read(spark))
    demand = region_marts.as_demand(w.demand().read(spark))
    marts = SilverMarts(units, series, w.points().read(spark, intervals=["1d"]), demand)
    names = _fingerprint(units)
    marts.facility_daily = refresh_facility_daily(spark, w, units, names)
    marts.facility_capacity_factor = refresh_capacity_factor(spark, w, units, names)
    marts.generation_daily_wide = refresh_wide(spark, w)
    for name, (source, make) in REGION_MARTS.items():
        setattr(marts, name, refresh_from(spark, w, name, source, make))
    for name, layout in GOLD_LAYOUT.items():
        setattr(marts, name, write_table(getattr(marts, name), w.table("gold", name), order_by=layout))
    return marts


def replay(spark: SparkSession, w: Warehouse) -> tuple[Warehouse, Marts]:
    """Rebuild the upserted tables from all raw files, for a changed rule or a shape that older files do not read under.

    The replay fills new targets under new checkpoints; the old ones stay readable meanwhile.
    """
    fresh = replace(w, generation=w.generation + 1)
    return fresh, refresh(spark, fresh)


def refresh_or_replay(spark: SparkSession, w: Warehouse) -> tuple[Warehouse, Marts]:
    """A refresh, or a replay where drop rules have changed since the tables were filled.

    Changed columns need none: older folders read under the new shape, unless a type became narrower or another.
    """
    changed = any(table.rules_changed(spark) for table in (w.points(), w.series(), w.demand()))
    return replay(spark, w) if changed else (w, refresh(spark, w))


def expire(spark: SparkSession, w: Warehouse) -> dict[str, int]:
    """Delete what no current version needs: superseded folders of every table, and the kept rows of batches that are folded in.

    Returns how many folders went, by table. Nobody may be reading an earlier version meanwhile.
    """
    gone = {table.root: len(table.expire(spark)) for table in (w.points(), w.series(), w.demand())}
    marts = [w.table("gold", name) for name in (*GOLD_LAYOUT, *PERIODS)]
    silver = [w.table("silver", name) for name in ("dim_unit", "dim_unit_rejected", "dim_unit_listed_twice")]
    return gone | {root: len(versions.expire(spark, root)) for root in (*marts, *silver)}


def stored_marts(spark: SparkSession, w: Warehouse) -> dict[str, DataFrame]:
    stored = {name: read_table(spark, w.table("gold", name), declared(name)) for name in GOLD_LAYOUT}
    return stored | {name: read_periods(spark, w, name) for name in PERIODS}
