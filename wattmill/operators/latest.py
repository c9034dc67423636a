"""Latest value per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The row with the greatest ``seq`` for every key, same columns as the input.

    One MAX over a struct that leads with the sequence, so every map task already reduces its copies
    of a key to one before the shuffle: a key with very many versions costs no more than others.
    Equal sequences fall back to the remaining columns, which makes the result independent of order.

    Spark sorts for a maximum of structs, since it can only hash-aggregate values of fixed width. The groups
    therefore lead with a hash of the keys: the sort compares one number per row instead of several texts.
    """
    rest = [c for c in df.columns if c not in keys and c not in seq]
    newest = df.groupBy(F.xxhash64(*keys), *keys).agg(F.max(F.struct(*seq, *rest)).alias("newest"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"newest.{c}").alias(c) for c in df.columns])


def newest_abreast(df: DataFrame, keys: Sequence[str], seq: Sequence[str], across: str, names: Sequence[str]) -> DataFrame:
    """One row for all rows that differ only in the key ``across``, with the newest of each value in ``names`` side by side.

    ``newest_<i>`` holds sequence and other columns of the newest row of ``names[i]``, NULL without one. A row of any other value,
    NULL included, is in a group of its own value, ``other_<across>``, as ``newest_<len(names)>``, so that a group stays as narrow as
    ``names`` whatever the rows hold.
    """
    shared = [c for c in keys if c != across]
    rest = [c for c in df.columns if c not in keys and c not in seq]
    other = f"other_{across}"
    named = F.coalesce(F.col(across).isin(list(names)), F.lit(False))
    members = [*[F.col(across) == n for n in names], ~named]
    newest = [F.max(F.when(own, F.struct(*seq, *rest))).alias(f"newest_{i}") for i, own in enumerate(members)]
    return df.withColumn(other, F.when(~named, F.col(across))).groupBy(*shared, other).agg(*newest)


def rows_of_fetches(fetches: DataFrame, across: str, names: Sequence[str], points: str) -> DataFrame:
    """Fetches as rows for ``newest_of_rows``: one with what they hold side by side, and one for each single point in the array ``points``.

    A fetch has a struct column for each of ``names``, NULL where it lacks that value. A point is a struct of ``across`` and the same fields; its
    row holds it in the column of its name, or in ``other`` next to ``other_<across>``, its own value.
    """
    fields = fetches.schema[names[0]].dataType
    none, no_name = F.lit(None).cast(fields.simpleString()), F.lit(None).cast("string")

    def row(other_name: Column, held: Sequence[Column]) -> Column:
        return F.struct(other_name.alias(f"other_{across}"), *[h.alias(n) for n, h in zip([*names, "other"], held)])

    def single(point: Column) -> Column:
        held = F.struct(*[point[f].alias(f) for f in fields.names])
        named = F.coalesce(point[across].isin(list(names)), F.lit(False))
        return row(F.when(~named, point[across]), [*[F.when(point[across] == n, held) for n in names], F.when(~named, held)])

    together = F.array(row(no_name, [*map(F.col, names), none]))
    rows = F.concat(together, F.coalesce(F.transform(points, single), F.slice(together, 1, 0)))
    return fetches.select(*[c for c in fetches.columns if c not in (*names, points)], F.inline(rows))


def newest_of_rows(rows: DataFrame, shared: Sequence[str], seq: Sequence[str], across: str, names: Sequence[str]) -> DataFrame:
    """``newest_abreast`` of rows that hold several values side by side already, so that a task sorts one row for each fetch and not one for each value."""
    def newest(name: str) -> Column:
        fields = [F.col(name)[f].alias(f) for f in rows.schema[name].dataType.names]
        return F.max(F.when(F.col(name).isNotNull(), F.struct(*seq, *fields)))

    return rows.groupBy(*shared, f"other_{across}").agg(*[newest(n).alias(f"newest_{i}") for i, n in enumerate([*names, "other"])])


def latest_abreast(df: DataFrame, keys: Sequence[str], seq: Sequence[str], across: str, names: Sequence[str]) -> DataFrame:
    """``latest_by``, with rows that differ only in the key ``across`` in one row on their way through the shuffle, common columns once."""
    return unfold_abreast(newest_abreast(df, keys, seq, across, names), keys, across, names, df.columns)


def unfold_abreast(groups: DataFrame, keys: Sequence[str], across: str, names: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows that ``newest_abreast`` holds side by side, one for each value of ``across``."""
    values = [*map(F.lit, names), F.col(f"other_{across}")]

    def row(i: int, value: Column) -> Column:
        newest = F.col(f"newest_{i}")
        return F.when(newest.isNotNull(), F.struct(value.alias(across), newest.alias("newest")))

    rows = F.array_compact(F.array(*[row(i, value) for i, value in enumerate(values)]))
    found = groups.select(*[c for c in keys if c != across], F.inline(rows))
    return found.select(*[F.col(c) if c in keys else F.col(f"newest.{c}").alias(c) for c in columns])
