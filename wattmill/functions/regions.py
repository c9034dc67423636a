"""Spellings of the market regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Region code and the spellings people use for it.
REGION_SYNONYMS = {
    "NSW1": ("New South Wales", "NSW"),
    "QLD1": ("Queensland", "QLD"),
    "SA1": ("South Australia", "SA"),
    "TAS1": ("Tasmania", "TAS"),
    "VIC1": ("Victoria", "VIC"),
}

REGIONS = tuple(REGION_SYNONYMS)


def region_code(text: Column, synonyms: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Code for a free-text region name, NULL when the spelling is unknown."""
    spelled = {}
    for code, names in (synonyms or REGION_SYNONYMS).items():
        for name in (code, *names):
            spelled[" ".join(name.lower().split())] = code
    lookup = F.create_map(*[F.lit(item) for entry in spelled.items() for item in entry])
    tidy = F.regexp_replace(F.lower(F.trim(text)), r"\s+", " ")
    return F.try_element_at(lookup, tidy)


def unmatched(df: DataFrame, column: str) -> DataFrame:
    """Unknown spellings and how many rows have each."""
    unknown = df.where(region_code(F.col(column)).isNull())
    return unknown.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def canonicalise(df: DataFrame, column: str, synonyms: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Add ``network_region`` for the free text in ``column``; unknown spellings stay, with NULL."""
    return df.withColumn("network_region", region_code(F.col(column), synonyms))
