"""Arithmetic shared by marts and answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL over zero, where plain division raises under ANSI."""
    return F.try_divide(numerator, denominator)


def tidy_doubles(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Round every double and turn -0.0 into 0.0, so that results compare across engines.

    Engines disagree on exact halves, which short decimals over powers of two do hit; a nudge far
    below the last digit moves them off.
    """
    return df.select(
        *[
            (F.round(F.col(f.name) + F.lit(3e-10), decimals) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
