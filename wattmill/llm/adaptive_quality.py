"""Quality rules whose limits come from the data: quantile sketches per language and source give the fences.

Measures of a document are whole numbers (per mille or per cent). A sketch is a histogram over the buckets of ``bucket``:
values below 64 exactly, above that 32 buckets a power of two (at most 3 % wide). Sketches merge by adding counts, so
tasks, groups and whole corpora combine in any order to the same result, and a group has at most some 2,000 buckets
however many rows it holds.

A document passes a measure if it lies between ``q25 - k * spread`` and ``q75 + k * spread`` of its (language, source), where
spread is the distance of the quartiles, but at least the measure's own floor. Groups of under ``least`` documents merge
into their language's sketch, languages of under ``least`` into that of the corpus. Documents that fail the base rules
neither pass nor count in a sketch.

Nulls: a null text has no words and fails the base rule; null language or source is a group of its own. Repeated rows are
judged alike and each counts. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattmill.llm.common import arrow_schema, raw_texts, same, saved, struct

SPACE = bytes([0x20, *range(0x09, 0x0E)])
NOT_A_LETTER = SPACE + bytes(range(0x80, 0xC0))  # white space and the bytes that continue a code point
SYMBOLS = b"#*$%&|<>"

MEASURED = struct(
    doc_id="long", lang="string", source="string", n_words="long", word_chars="long", n_symbols="long", n_lines="long", n_dup_lines="long", n_repeat_words="long"
)

# measure: (numerator, factor, denominator, least spread); a fence below applies to two-sided measures only
MEASURES = {
    "word_length": ("word_chars", 100, "n_words", 50),
    "symbols": ("n_symbols", 1000, "n_words", 20),
    "dup_lines": ("n_dup_lines", 1000, "n_lines", 100),
    "repeats": ("n_repeat_words", 1000, "n_words", 100),
}
TWO_SIDED = ("word_length",)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """How many words lie in a window of ``width`` words that the text has twice or more."""
    n = len(words)
    if n <= width:
        return 0
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    at = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=n)
    codes = at[: n - width + 1]
    for k in range(1, width):
        if codes.max() >= (1 << 62) // len(numbers):
            codes = np.unique(codes, return_inverse=True)[1]
        codes = codes * len(numbers) + at[k : n - width + 1 + k]
    _, where, counts = np.unique(codes, return_inverse=True, return_counts=True)
    hit = np.zeros(n, dtype=bool)
    starts = np.flatnonzero(counts[where] > 1)
    for k in range(width):
        hit[starts + k] = True
    return int(hit.sum())


def measure_text(text: bytes) -> tuple[int, int, int, int, int, int]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    return (
        len(words),
        len(text.translate(None, NOT_A_LETTER)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def measure(docs: DataFrame) -> DataFrame:
    """Counts of every whole text."""
    schema = arrow_schema(MEASURED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure_text(t) for t in raw_texts(batch.column(3))]
            columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)] if found else [pa.array([], pa.int64())] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *columns], schema=schema)

    return docs.select(F.col("doc_id").cast("bigint"), "lang", "source", "text").mapInArrow(run, MEASURED)


def bucket(value: Column) -> Column:
    """The bucket of a whole number of at least 0, in whole-number arithmetic only."""
    extra = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return (extra * 32 + F.floor(value / F.pow(F.lit(2.0), extra))).cast("bigint")


def lower_end(number: Column) -> Column:
    """The least value of a bucket."""
    extra = F.greatest(F.floor(number / 32) - 1, F.lit(0))
    return ((number - extra * 32) * F.pow(F.lit(2.0), extra)).cast("bigint")


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the sketches of all groups."""
    per_row = F.array(
        *(
            F.struct(F.lit(name).alias("measure"), bucket(F.floor(F.col(top) * times / F.col(low)).cast("bigint")).alias("bucket"))
            for name, (top, times, low, _) in MEASURES.items()
        )
    )
    return measured.select("lang", "source", F.inline(per_row)).groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n"))


def quartiles(sketches: DataFrame, *keys: str) -> DataFrame:
    """First and third quartile and row count of the merged sketches of each group."""
    merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    upto = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("total", F.sum("n").over(group))
    at = lambda part: F.min(F.when(F.col("upto") * 4 >= F.col("total") * part, lower_end(F.col("bucket"))))
    return upto.groupBy(*keys, "measure").agg(at(1).alias("q25"), at(3).alias("q75"), F.max("total").alias("total"))


def fences(sketches: DataFrame, least: int = 100, k: int = 3) -> DataFrame:
    """One row per (lang, source) with the limits of every measure."""
    groups = sketches.select("lang", "source").distinct()
    own, by_lang, overall = quartiles(sketches, "lang", "source"), quartiles(sketches, "lang"), quartiles(sketches)
    names = sketches.sparkSession.createDataFrame([(m, f[3]) for m, f in MEASURES.items()], "measure string, floor bigint")
    # a handful of constant rows: one per measure
    wanted = groups.withColumn("measure", F.explode(F.array(*map(F.lit, MEASURES)))).join(F.broadcast(names), "measure")
    w, o, b, a = wanted.alias("w"), own.alias("o"), by_lang.alias("b"), overall.alias("a")
    joined = (
        w.join(o, same(F.col("w.lang"), F.col("o.lang")) & same(F.col("w.source"), F.col("o.source")) & (F.col("w.measure") == F.col("o.measure")))
        .join(b, same(F.col("w.lang"), F.col("b.lang")) & (F.col("w.measure") == F.col("b.measure")))
        .join(a, F.col("w.measure") == F.col("a.measure"))
    )

    def pick(q: str) -> Column:
        return F.when(F.col("o.total") >= least, F.col(f"o.{q}")).when(F.col("b.total") >= least, F.col(f"b.{q}")).otherwise(F.col(f"a.{q}"))

    spread = F.greatest(pick("q75") - pick("q25"), F.col("w.floor"))
    limits = joined.select("w.lang", "w.source", "w.measure", (pick("q25") - spread * k).alias("low"), (pick("q75") + spread * k).alias("high"))
    each = [F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{m}_{side}") for m in MEASURES for side in ("low", "high")]
    return limits.groupBy("lang", "source").agg(*each)


def adaptive_quality(docs: DataFrame, least: int = 100, k: int = 3) -> DataFrame:
    """Counts, base verdict, the limits that applied and the final verdict of every document."""
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = saved(measure(docs).withColumn("base_failed", base_failed), "quality")
    limits = fences(sketch(measured.where(~F.col("base_failed"))), least, k)
    m, f = measured.alias("m"), limits.alias("f")
    within = F.lit(True)
    for name, (top, times, low, _) in MEASURES.items():
        value = F.floor(F.col(f"m.{top}") * times / F.when(F.col(f"m.{low}") > 0, F.col(f"m.{low}")))
        within &= value <= F.col(f"f.{name}_high")
        if name in TWO_SIDED:
            within &= value >= F.col(f"f.{name}_low")
    joined = m.join(f, same(F.col("m.lang"), F.col("f.lang")) & same(F.col("m.source"), F.col("f.source")), "left")
    kept = F.when(F.col("m.base_failed"), False).otherwise(F.coalesce(within, F.lit(False)))
    columns = [f"m.{c}" for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]
    return joined.select(*columns, kept.alias("kept"), *(f"f.{name}_high" for name in MEASURES), *(f"f.{name}_low" for name in TWO_SIDED))
