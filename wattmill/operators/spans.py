"""Join of dated rows with spans of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_bin(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / days)


def in_spans(points: DataFrame, spans: DataFrame, day: str, first: str, last: str, on: Sequence[str] = (), days: int = 32) -> DataFrame:
    """Every point with every span (closed at both ends) that covers its day and agrees with it in ``on``.

    The day axis is cut into bins of ``days`` days. A span is a row for each bin it touches and a point a row for its own, so this is
    an equi-join on (``on``, bin) that keeps what lies inside: Spark shuffles or broadcasts it like any other, and no nested loop
    is needed. A span over many years is spread over as many bins as it is long, and a bin never holds more points than its days.
    No pair comes twice, since a point has one bin. ``days`` near the usual length of a span makes a span some two rows.

    Null days, ends and ``on`` values match nothing; a span that ends before it begins covers no day. Columns of the two sides other
    than ``on`` must differ in name.
    """
    both = (set(points.columns) & set(spans.columns)) - set(on)
    if both:
        raise ValueError(f"columns on both sides: {sorted(both)}")
    name = "bin"
    while name in {*points.columns, *spans.columns}:
        name += "_"
    touched = F.explode(F.sequence(day_bin(F.col(first), days), day_bin(F.col(last), days)))
    covering = spans.where(F.col(first) <= F.col(last)).withColumn(name, touched)
    binned = points.where(F.col(day).isNotNull()).withColumn(name, day_bin(F.col(day), days))
    joined = binned.join(covering, [*on, name])
    return joined.where(F.col(day).between(F.col(first), F.col(last))).drop(name)
