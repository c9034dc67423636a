"""Row rules and table checks.

A rule is a condition that a good row meets; a row for which it is FALSE or NULL breaks it.
Nothing vanishes: kept rows plus rejected rows are the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    action: str = "drop"

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


# Names and conditions of the rules.
KNOWN_ENERGY_UNIT = Rule("known_energy_unit", "metric IS NULL OR metric <> 'energy' OR uom IN ('GWh', 'MWh')")

UNIT_RULES = (Rule("valid_unit_code", "unit_code IS NOT NULL"),)

SERIES_RULES = (
    Rule("valid_key", "nem_date IS NOT NULL AND network_region IS NOT NULL AND fueltech_id IS NOT NULL"),
    KNOWN_ENERGY_UNIT,
)

DEMAND_RULES = (Rule("valid_key", "nem_date IS NOT NULL AND network_region IS NOT NULL"), KNOWN_ENERGY_UNIT)

POINT_RULES = (
    Rule("valid_unit_code", "unit_code IS NOT NULL"),
    Rule("valid_ts", "interval_ts_utc IS NOT NULL"),
    Rule("valid_metric", "metric IS NOT NULL"),
    KNOWN_ENERGY_UNIT,
    Rule("non_negative_value", "value IS NULL OR value >= 0", action="warn"),
)


def flag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``broken_rules``, the names of the drop rules a row breaks. Narrow, fine on a stream."""
    drops = [F.when(~r.holds(), F.lit(r.name)) for r in rules if r.action == "drop"]
    return df.withColumn("broken_rules", F.array_compact(F.array(*drops)) if drops else F.array().cast("array<string>"))


def apply_rules(
    df: DataFrame, rules: Sequence[Rule], observe_as: str | Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split into (kept, rejected). Rejected rows carry ``broken_rules``.

    ``observe_as`` attaches the counters to the kept branch, so that the job which writes it also
    counts: pass an Observation on a batch, or a name to find in a stream's progress.
    """
    drops = [r.holds() for r in rules if r.action == "drop"]
    keep = reduce(lambda a, b: a & b, drops, F.lit(True))
    source = df
    if observe_as is not None:
        broken = [F.count_if(~r.holds()).alias(r.name) for r in rules]
        source = df.observe(observe_as, F.count(F.lit(1)).alias("rows"), F.count_if(keep).alias("kept"), *broken)
    return source.where(keep), flag(df, rules).where(F.size("broken_rules") > 0)


def kept_abreast(df: DataFrame, rules: Sequence[Rule], across: Mapping[str, Column], columns: Sequence[str], name: str) -> DataFrame:
    """Rows whose struct ``columns`` hold a point each, with NULL for points that break a drop rule; rows without any point left are dropped.

    ``across`` gives what the rules know as ``name`` for each of the columns; its fields go by their own names.
    """
    drops = [r.holds() for r in rules if r.action == "drop"]
    keep = reduce(lambda a, b: a & b, drops, F.lit(True))
    kept = df
    for c in columns:
        seen = {f: F.col(c)[f] for f in df.schema[c].dataType.names}
        kept = kept.withColumns({**seen, name: across[c]}).withColumn(c, F.when(keep, F.col(c)))
    return kept.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])).select(*df.columns)


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Passed and failed rows of each rule, one pass for all of them."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(~r.holds()).alias(f"r{i}") for i, r in enumerate(rules)]
    )
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            (F.col("rows") - F.col(f"r{i}")).alias("passed"),
            F.col(f"r{i}").alias("failed"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that repeat or hold a NULL, with their row count. Empty means the key is sound."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.col("n") > 1) | any_null(keys))


def key_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows and NULL-key rows of each table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n"), F.count_if(any_null(keys)).alias("null_key_rows")).select(
            F.lit(name).alias("tbl"), "n", "null_key_rows"
        )
        for name, (df, keys) in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def reconcile(source_counts: DataFrame, copy_counts: DataFrame) -> DataFrame:
    """Check that each copy holds its source less the NULL-key rows. One line per table."""
    copies = copy_counts.select("tbl", F.col("n").alias("copy_rows"))
    joined = source_counts.withColumnRenamed("n", "source_rows").join(copies, "tbl", "full")
    expected = F.col("source_rows") - F.col("null_key_rows")
    return joined.withColumn("ok", F.coalesce(F.col("copy_rows") == expected, F.lit(False)))


def coverage(marts: Mapping[str, DataFrame], day: str = "nem_date") -> DataFrame:
    """Row count, first and last day of each mart."""
    spans = [
        df.agg(F.count(F.lit(1)).alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day")).select(
            F.lit(name).alias("mart"), "n", "first_day", "last_day"
        )
        for name, df in marts.items()
    ]
    return reduce(DataFrame.unionByName, spans)


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def column_report(df: DataFrame, table: str) -> DataFrame:
    """Name, type and nullability of the columns, as a table."""
    rows = [(table, i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = "table_name string, position int, column_name string, data_type string, is_nullable boolean"
    return df.sparkSession.createDataFrame(rows, schema)


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """The column report with what the rows hold: rows, NULLs and estimated distinct values of each column, in one pass."""
    counts = [f for c in df.columns for f in (F.count(f"`{c}`"), F.approx_count_distinct(F.col(f"`{c}`").cast("string")))]
    counted = df.agg(F.count(F.lit(1)).alias("n"), *(f.alias(f"f{i}") for i, f in enumerate(counts)))
    lines = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.lit(serving_type(field.dataType)).alias("serving_type"),
            F.col("n").alias("n_rows"),
            (F.col("n") - F.col(f"f{2 * i}")).alias("n_null"),
            F.col(f"f{2 * i + 1}").alias("about_distinct"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return counted.select(F.inline(F.array(*lines)))


def serving_type(data_type: T.DataType) -> str:
    """Type a relational serving copy gives the column."""
    names = {
        T.StringType: "text",
        T.BooleanType: "boolean",
        T.LongType: "bigint",
        T.IntegerType: "integer",
        T.DoubleType: "double precision",
        T.DateType: "date",
        T.TimestampType: "timestamp with time zone",
    }
    return names.get(type(data_type), "jsonb")
