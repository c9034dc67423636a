"""Days that lie outside what earlier months of their series lead to expect.

Values are summed up in KLL sketches, one per group and month. Sketches merge, so the distribution of all earlier months is a merge of theirs and
history is never sorted again; a sketch has a fixed size, whatever it has seen. Ranks are exact for up to ``k`` values and within
some 1.7 / k of the number of values beyond.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 4096


def monthly_sketches(days: DataFrame, group: Sequence[str], value: str, day: str = "nem_date", k: int = K) -> DataFrame:
    """(group, month, sketch, n) of the known values; keep it and add new months as they come."""
    month = F.trunc(day, "month").alias("month")
    known = days.where(F.col(value).isNotNull())
    return known.groupBy(*group, month).agg(F.kll_sketch_agg_double(value, k).alias("sketch"), F.count(F.lit(1)).alias("n"))


def earlier_bands(sketches: DataFrame, group: Sequence[str], least: int = 60, k: int = K) -> DataFrame:
    """(group, month, low, high, n_earlier): quartiles of all earlier months, widened by three times their distance.

    A month with fewer than ``least`` earlier values has no band. The window holds a row per month, each a sketch of bounded size.
    """
    before = Window.partitionBy(*group).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    merged = sketches.select(
        *group, "month", F.kll_merge_agg_double("sketch", k).over(before).alias("earlier"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_earlier")
    )
    at = lambda rank: F.kll_sketch_get_quantile_double("earlier", F.lit(rank))
    quartiles = merged.where(F.col("n_earlier") >= least).select(*group, "month", "n_earlier", at(0.25).alias("q25"), at(0.75).alias("q75"))
    spread = F.col("q75") - F.col("q25")
    return quartiles.select(*group, "month", "n_earlier", (F.col("q25") - 3 * spread).alias("low"), (F.col("q75") + 3 * spread).alias("high"))


def implausible_days(days: DataFrame, group: Sequence[str], value: str, day: str = "nem_date", least: int = 60, k: int = K) -> DataFrame:
    """Days with their value and the band it lies outside of."""
    bands = earlier_bands(monthly_sketches(days, group, value, day, k), group, least, k)
    dated = days.withColumn("month", F.trunc(day, "month"))
    joined = dated.join(bands, [*group, "month"])
    return joined.where(~F.col(value).between(F.col("low"), F.col("high"))).select(*group, day, value, "low", "high", "n_earlier")
