"""Proportional stratified interleaving: every shard gets each source in the share that the corpus has.

Rows of a source are shuffled by a seeded hash and ranked; rank r of n gets the fraction (r + 1/2) / n. Sorted by fraction, any
run of consecutive rows holds the sources in proportion, so the sorted order is cut into ``shards`` equal runs.
Counts of shards differ by one at most (law ``rows``).

Both rankings are range sorts with counts per partition added up afterwards, so a source with a third of all rows is spread
over many tasks. Fractions are IEEE doubles; equal ones go by (hash, source, doc_id, size, crc).

Nulls: a null source is a source, a null doc_id sorts first, a null text has no bytes. Repeated rows are ranked one after
another; which is which cannot be told. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattmill.llm.common import same, saved

TIES = ("shuffled", "source", "doc_id", "size", "text_crc32")


def seeded(seed: int, column: str):
    """60 bits of an MD5 over seed and value."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit("")))), 1, 15), 16, 10).cast("bigint")


def numbered(df: DataFrame, order: tuple[str, ...], name: str) -> DataFrame:
    """``df`` sorted over all partitions and written, with the partition (``part``) and the place in it (``pos``)."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    return saved(ordered.withColumn("part", F.shiftright("id", 33)).withColumn("pos", F.col("id").bitwiseAND(F.lit((1 << 33) - 1))).drop("id"), name)


def fractions(rows: DataFrame) -> DataFrame:
    """Adds ``fraction``, the place of a row within its shuffled source as a number between 0 and 1."""
    placed = numbered(rows, ("source", *(c for c in TIES if c != "source")), "ranks")
    counts = placed.groupBy("source", "part").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    by_source = Window.partitionBy("source")  # as many rows as partitions that hold the source
    before = F.coalesce(F.sum("n").over(by_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("source", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(by_source).alias("total")).alias("o")
    p = placed.alias("p")
    joined = p.join(offsets, (F.col("p.part") == F.col("o.part")) & same(F.col("p.source"), F.col("o.source")))
    fraction = (2 * (F.col("p.pos") + F.col("o.shift")) + 1).cast("double") / (2 * F.col("o.total")).cast("double")
    return joined.select(*(f"p.{c}" for c in TIES), fraction.alias("fraction"))


def interleave(docs: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """doc_id, size, text_crc32, source, law, shard, slot, grown_shard of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        "source",
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    ).withColumn("shuffled", seeded(seed, "doc_id"))
    placed = numbered(fractions(rows), ("fraction", *TIES), "interleaved")
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    whole = Window.partitionBy(F.lit(1))  # one row per partition of the sort
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("part", before.alias("before"), F.sum("n").over(whole).alias("total"))
    at = F.col("pos") + F.col("before")
    return (
        placed.join(offsets, "part")
        .withColumn("at", at)
        .withColumn("shard", F.expr(f"(at * {shards}) div total"))
        .withColumn("slot", F.expr(f"at - (shard * total + {shards - 1}) div {shards}"))
        .select("doc_id", "size", "text_crc32", "source", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
    )
