"""Latest value per key, kept up to date by a stream.

Parquet has no MERGE. A micro-batch is written as new folders, one for each calendar part it touches, and named
in a manifest; reading a part takes the latest row per key over its folders. Once a part has ``FAN`` folders
of one level, the batch at hand merges them into a folder of the next level. So what a batch writes follows
the batch: over time a row is written again once per level, and a part of n batches has some log(n) folders.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.functions.calendar import market_date
from wattmill.functions.units import METRICS
from wattmill.operators.facility_marts import POINT_KEYS
from wattmill.operators.latest import latest_by, newest_abreast, unfold_abreast
from wattmill.operators.quality import POINT_RULES, SERIES_RULES, Rule, flag
from wattmill.operators.region_marts import SERIES_KEYS
from wattmill.session import settings
from wattmill.sources import versions
from wattmill.sources.evolution import ReplayNeeded
from wattmill.sources.landing import fetch_time
from wattmill.sources.payloads import unit_points
from wattmill.sources.tables import conform

STRING, DOUBLE, LONG = T.StringType(), T.DoubleType(), T.LongType()


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


FAN = 4

# A task keeps so many folders open before it sorts its rows by folder; a shuffle goes when the rows behind it are written.
WRITING = {"spark.sql.maxConcurrentOutputFileWriters": "8", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def to_merge(own: Sequence[versions.Folder]) -> tuple[list[versions.Folder], int]:
    """Folders of a part that a new one merges with, and the level of the result."""
    gone: list[versions.Folder] = []
    level = 0
    while len(same := [f for f in own if f.level == level]) + 1 >= FAN:
        gone += same
        level += 1
    return gone, level


class UpsertTable:
    """A table below ``root`` that keeps the latest row per key, in folders by ``parts``.

    A part column must follow from the key alone, so that all versions of a row meet in one folder.
    """

    stored: T.StructType
    parts: Sequence[str]
    keys: Sequence[str]
    sequence: Sequence[str] = ("ingested_at", "source_id")
    rules: Sequence[Rule]

    def __init__(self, root: str, rules: Sequence[Rule] | None = None):
        self.root = root
        self.rules = rules if rules is not None else self.rules

    def derived(self) -> dict[str, Column]:
        """Part columns that the input does not carry."""
        return {}

    def merge(self, points: DataFrame, batch_id: int, stream: str = "") -> None:
        """Fold one batch in. A batch that its stream has brought before changes nothing.

        Batch numbers only count within a stream. One that starts over under a new checkpoint is
        merged in full, which gives the same table again.
        """
        spark = points.sparkSession
        now = versions.current(spark, self.root)
        self.require_same_rules(now)
        if stream == now.stream and batch_id <= now.batch_id:
            return
        staged = self._stage(points, f"{self.root}/batches/stream={stream or 'direct'}/batch={batch_id}")
        kept = staged.where(F.col("outcome") == "kept").select(*self.stored.names)
        # Bounded by the calendar: one row per folder, a day, month or year each.
        touched = [tuple(r) for r in kept.select(*self.parts).distinct().collect()]
        number = now.number + 1
        live = dict(now.live)
        shape = self.stored.json()
        if touched:
            merging = {part: to_merge(live.get(part, [])) for part in touched}
            before = versions.read(spark, self.root, self.stored, [f for own, _ in merging.values() for f in own])
            laid_out = self._laid_out(before.unionByName(kept))
            self._write(laid_out, f"{self.root}/data/table_version={number}", *self.parts)
            written = versions.written_parts(spark, self.root, number, self.parts)
            for part, (gone, level) in merging.items():
                live[part] = [f for f in live.get(part, []) if f not in gone] + [versions.Folder(written[part], level, shape)]
        versions.commit(spark, self.root, versions.Version(number, stream, batch_id, live, self.rules_print()))

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        """The latest row per key, dealt to tasks by part. The hint lets Spark split a hot folder over several files and join small ones."""
        return latest_by(rows, self.keys, self.sequence).hint("rebalance", *self.parts)

    def _write(self, rows: DataFrame, path: str, *by: str) -> None:
        """Write folders by ``by`` without a sort where a task has few of them, and drop the shuffles behind what is written."""
        with settings(rows.sparkSession, WRITING):
            rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*by).parquet(path)

    def rules_print(self) -> str:
        """Tells apart sets of drop rules; a warning keeps every row."""
        return json.dumps(sorted([r.name, r.condition] for r in self.rules if r.action == "drop"))

    def require_same_rules(self, now: versions.Version) -> None:
        """Rows that went through other rules would mix with new ones; only a replay brings back what was dropped."""
        if now.rules is not None and now.rules != self.rules_print():
            raise ReplayNeeded(f"{self.root} was filled under other rules; replay it into a new target")

    def rules_changed(self, spark: SparkSession) -> bool:
        stored = versions.current(spark, self.root).rules
        return stored is not None and stored != self.rules_print()

    def _stage(self, points: DataFrame, path: str) -> DataFrame:
        """Parse the batch once into a table of its own, rejected rows beside the kept ones.

        The merge reads this table instead of the source, so a lost executor costs no second parse,
        and it stays as the record of what the batch brought.
        """
        outcome = F.when(F.size("broken_rules") > 0, "rejected").otherwise("kept")
        if "source_id" not in points.columns:
            points = points.withColumn("source_id", F.lit(None).cast("bigint"))
        marked = flag(points.withColumns(self.derived()), self.rules)
        marked = marked.select(*self.stored.names, "broken_rules", outcome.alias("outcome"))
        self._write(marked, path, "outcome")
        return points.sparkSession.read.schema(marked.schema).parquet(path)

    def rejected(self, spark: SparkSession) -> DataFrame:
        """Rows of all batches that broke a drop rule. ``source_id`` is the hash of the file's path."""
        schema = T.StructType([*self.stored.fields]).add("broken_rules", T.ArrayType(STRING))
        schema = schema.add("stream", STRING).add("batch", LONG).add("outcome", STRING)
        return spark.read.schema(schema).parquet(f"{self.root}/batches").where(F.col("outcome") == "rejected").drop("outcome")

    def expire(self, spark: SparkSession) -> list[str]:
        """Delete superseded folders, and the kept rows of every batch that a version has folded in; rejected rows stay.

        A batch is folded in before its number is committed, and one that comes again is not read again.
        """
        now = versions.current(spark, self.root)
        staged = versions.subfolders(spark, self.root, "batches/stream=*/batch=*/outcome=kept")
        number = lambda path: int(path.split("/batch=")[1].split("/")[0])
        done = [p for p in staged if f"stream={now.stream or 'direct'}/" not in p or number(p) <= now.batch_id]
        versions.delete(spark, self.root, done)
        return [*versions.expire(spark, self.root), *done]

    def live(self, spark: SparkSession) -> dict[tuple, list[versions.Folder]]:
        """Part values and the folders that hold them."""
        return versions.current(spark, self.root).live

    def read_parts(self, spark: SparkSession, parts: dict[tuple, list[versions.Folder]]) -> DataFrame:
        """The latest row per key. A part of one folder is read as it is, without a shuffle."""
        single = [own[0] for own in parts.values() if len(own) == 1]
        several = [f for own in parts.values() if len(own) > 1 for f in own]
        rows = versions.read(spark, self.root, self.stored, single)
        if not several:
            return rows
        newest = latest_by(versions.read(spark, self.root, self.stored, several), self.keys, self.sequence)
        return rows.unionByName(newest) if single else newest


class PointTable(UpsertTable):
    """Unit points: by interval, then market months for daily points and market days for finer ones.

    A re-fetched window touches few of these.
    """

    stored = _columns(
        unit_code=STRING, interval_ts_utc=T.TimestampType(), metric=STRING, value=DOUBLE, uom=STRING,
        ingested_at=T.TimestampType(), source_id=LONG, interval=STRING, period=STRING,
    )
    parts = ("interval", "period")
    keys = POINT_KEYS
    rules = POINT_RULES

    def derived(self) -> dict[str, Column]:
        day = market_date(F.col("interval_ts_utc")).cast("string")
        return {"period": F.when(F.col("interval") == "1d", F.substring(day, 1, 7)).otherwise(day)}

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        """The metrics of a unit and instant cross both shuffles in one row, the part once, since it follows from the key."""
        own = rows.drop(*self.derived())
        groups = newest_abreast(own, self.keys, self.sequence, "metric", METRICS).withColumns(self.derived())
        keys = [*self.keys, *self.derived()]
        return unfold_abreast(groups.hint("rebalance", *self.parts), keys, "metric", METRICS, self.stored.names)

    def live_of(self, spark: SparkSession, intervals: Sequence[str] | None = None) -> dict[tuple, list[versions.Folder]]:
        """Live parts (interval, period). Naming intervals leaves out the others' folders."""
        return {part: own for part, own in self.live(spark).items() if intervals is None or part[0] in intervals}

    def read_parts(self, spark: SparkSession, parts: dict[tuple, list[versions.Folder]]) -> DataFrame:
        return conform(super().read_parts(spark, parts).drop("source_id", "period"), "facility_generation")

    def read(self, spark: SparkSession, intervals: Sequence[str] | None = None) -> DataFrame:
        return self.read_parts(spark, self.live_of(spark, intervals))


class SeriesTable(UpsertTable):
    """Dated series points of the stats files, by year."""

    stored = _columns(
        series_id=STRING, network_region=STRING, fueltech_id=STRING, metric=STRING, nem_date=T.DateType(),
        value=DOUBLE, uom=STRING, ingested_at=T.TimestampType(), source_id=LONG, year=STRING,
    )
    parts = ("year",)
    keys = SERIES_KEYS
    rules = SERIES_RULES

    def derived(self) -> dict[str, Column]:
        return {"year": F.year("nem_date").cast("string")}

    def read(self, spark: SparkSession) -> DataFrame:
        return self.read_parts(spark, self.live(spark))


def run_upsert(points: DataFrame, table: UpsertTable, checkpoint: str, mode: str = "append"):
    """Drain a stream of points into the table, then stop. Returns the finished query.

    Counters of the rules, warnings included, are in the query's progress under "points".
    """
    counters = [F.count_if(~r.holds()).alias(r.name) for r in table.rules]
    watched = points.observe("points", F.count(F.lit(1)).alias("rows"), *counters)

    def fold(batch: DataFrame, batch_id: int) -> None:
        # The checkpoint names its stream before the first batch runs.
        written = batch.sparkSession.read.text(f"{checkpoint}/metadata").first().value
        table.merge(batch, batch_id, json.loads(written)["id"])

    query = (
        watched.writeStream.outputMode(mode)
        .foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def points_of(raw: DataFrame) -> DataFrame:
    """Unit points of raw files, batch or stream, sequenced by fetch time."""
    return unit_points(raw.withColumn("ingested_at", fetch_time())).drop("value_text")
