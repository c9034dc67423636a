"""Units of measure of the source series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# MWh per energy unit. An energy series in any other unit is rejected, not guessed.
MWH_PER_UNIT = {"GWh": 1000.0, "MWh": 1.0}

METRICS = ("energy", "emissions", "market_value")


def to_mart_factor(metric: Column, uom: Column) -> Column:
    """Factor that takes a value to the mart's unit: MWh for energy, unchanged for the rest."""
    lookup = F.create_map(*[F.lit(item) for entry in MWH_PER_UNIT.items() for item in entry])
    return F.when(metric == "energy", F.try_element_at(lookup, uom)).otherwise(F.lit(1.0))


def sum_of(metric: str, value: Column) -> Column:
    """SUM over the rows of one metric: NULL when there are none or all are NULL."""
    return F.sum(F.when(F.col("metric") == metric, value))
