"""Language identification by Bayesian fusion of four kinds of evidence.

* **Text**: log-likelihood of the text's byte trigrams under each language (multinomial, hashed to ``SLOTS`` slots, add-half smoothing), and under an
  unknown language that makes all slots equally likely. Trigrams overlap and repeat, so a text counts as ``EFFECTIVE``
  independent trigrams at most.
* **Declared language** of the markup or record: P(declared | language).
* **Address suffix** (top-level domain): P(suffix | language).
* **Host prior**: P(language | host), smoothed towards the host's domain, and that towards the whole corpus.

The last three come from grouped counts over all rows of what the text alone says; only sums reach the joins, so a host
with a third of all rows is one entry. The posterior is the normalised product. A row is kept if the best language is a known one
with a posterior of at least ``least``; text without letters says nothing and is rejected.

A declared language counts by its primary subtag in lower case (``en-GB`` and ``EN`` are ``en``). Codes that say "undetermined", "several" or
"none", and texts that are no code, are no declaration.

The text model is fitted on at most about ``PER_LANGUAGE`` labelled rows of each declared language, drawn by hash of text and id.
Every declared language is modelled, however rare; their number is that of language codes. Everything else uses all rows.

Nulls: a null text has no letters; null declaration, suffix or host is no evidence. Repeated rows are judged alike. With no labelled
row at all, nothing is kept. Empty table: empty result. Columns of ``docs`` besides the named ones are carried along by
``identify`` and never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.llm.common import arrow_schema, emit, fresh, saved, struct, text_key, texts_in_blocks

SLOTS = 1 << 16
EFFECTIVE = 60
PER_LANGUAGE = 2000
WEIGHT = 20.0  # rows that a parent's prior counts for
BLOCK_BYTES = 2 << 20  # text taken at a time: its trigrams need some 25 times as much
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
UNKNOWN = "und"
# Codes for undetermined, several, uncoded and no languages.
NO_LANGUAGE = ("und", "mul", "mis", "zxx")

COUNTS = struct(label="string", slots="binary", counts="binary")


def trigram_slots(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all trigrams of the texts' letter runs, and where each text begins. The two places at each text's end get slot SLOTS."""
    spelt = [b" " + b" ".join(t.translate(LETTERS).split()) + b" " for t in texts]
    data = np.frombuffer(b"".join(spelt), dtype=np.uint8).astype(np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in spelt])])
    slots = np.full(len(data), SLOTS, dtype=np.uint32)
    if len(data) > 2:
        code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
        slots[:-2] = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    for k in (1, 2):
        slots[bounds[1:] - k] = SLOTS
    return slots, bounds


def fit(docs: DataFrame, text: str, declared: str, key: Column) -> tuple[list[str], list[tuple[float, np.ndarray, np.ndarray]]]:
    """Known languages, and for each the log-probability of a slot that it lacks, the slots it has and their log-probabilities."""
    drawn = F.pmod(F.xxhash64(key, text_key(F.col(text)), F.lit("fit")), F.lit(1 << 20))
    labelled = docs.select(F.col(text).alias("text"), F.col(declared).alias("label"), drawn.alias("draw")).where("label IS NOT NULL AND text IS NOT NULL")
    # one row per declared language; its first draw is in any case taken
    sizes = labelled.groupBy("label").agg(F.count("*").alias("count"), F.min("draw").alias("first")).collect()
    if not sizes:
        return [], []
    limits = [(r["label"], max(int(min(1.0, PER_LANGUAGE / r["count"]) * (1 << 20)), r["first"] + 1)) for r in sizes]
    limit = F.element_at(F.map_from_arrays(F.array(*(F.lit(x) for x, _ in limits)), F.array(*(F.lit(n) for _, n in limits))), F.col("label"))
    schema = arrow_schema(COUNTS)

    def row(slots: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
        found, place = np.unique(slots, return_inverse=True)
        return found.astype("<u4").tobytes(), np.bincount(place, counts, len(found)).astype("<i8").tobytes()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for part, texts in texts_in_blocks(batch, 0, 2 * BLOCK_BYTES):
                by_label: dict[str, list[bytes]] = {}
                for label, spelt in zip(part.column(1).to_pylist(), texts, strict=True):
                    by_label.setdefault(label, []).append(spelt)
                for label, own in by_label.items():
                    slots = trigram_slots(own)[0]
                    slots = slots[slots < SLOTS]
                    yield label, *row(slots, np.ones(len(slots)))

    def add(key: tuple, table: pa.Table) -> pa.Table:
        # the slots of at most about PER_LANGUAGE texts
        slots, counts = (np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=d) for c, d in (("slots", "<u4"), ("counts", "<i8")))
        slots, counts = row(slots, counts)
        return pa.table({"label": [key[0].as_py()], "slots": [slots], "counts": [counts]}, schema=schema)

    counted = labelled.where(F.col("draw") < limit).select("text", "label").mapInArrow(lambda batches: emit(schema, count(batches)), COUNTS)
    model = {}
    for r in counted.groupBy("label").applyInArrow(add, COUNTS).toLocalIterator():
        counts = np.frombuffer(bytes(r["counts"]), dtype="<i8")
        total = counts.sum() + 0.5 * SLOTS
        model[r["label"]] = math.log(0.5 / total), np.frombuffer(bytes(r["slots"]), dtype="<u4"), np.log((counts + 0.5) / total).astype(np.float32)
    labels = sorted(model)
    return labels, [model[x] for x in labels]


def with_likelihoods(docs: DataFrame, text: str, model: list[tuple[float, np.ndarray, np.ndarray]], column: str) -> DataFrame:
    """``docs`` with an array of tempered log-likelihoods, languages in order and the unknown one last; null without letters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the slots that occur in each declared language
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.ArrayType(T.DoubleType()))])
    at = docs.columns.index(text)

    def weights() -> Iterator[np.ndarray]:
        for absent, slots, present in [*shared.value, (-math.log(SLOTS), np.zeros(0, dtype=np.int64), 0.0)]:
            row = np.full(SLOTS + 1, absent, dtype=np.float32)
            row[slots] = present
            row[SLOTS] = 0.0
            yield row

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in texts_in_blocks(batch, at, BLOCK_BYTES):
                slots, bounds = trigram_slots(texts)
                grams = np.maximum(np.diff(bounds) - 2, 0)
                sums = np.stack([np.add.reduceat(row[slots], bounds[:-1], dtype=np.float64) for row in weights()], axis=1)
                sums *= np.minimum(1.0, EFFECTIVE / np.maximum(grams, 1))[:, None]
                values = [s if g else None for s, g in zip(sums.tolist(), grams.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.list_(pa.float64()))], names=[*part.schema.names, column])

    return docs.mapInArrow(score, schema)


def language_code(declared: Column) -> Column:
    """The primary subtag of a language code in lower case; null for anything else."""
    code = F.lower(F.regexp_extract(F.trim(declared), r"^([A-Za-z0-9]{1,8})(?:[-_].*)?$", 1))
    return F.when((code != "") & ~code.isin(*NO_LANGUAGE), code)


def identify(
    docs: DataFrame, text: str = "text", declared: str | None = "lang", host: str | None = "source", suffix: str | None = None, key: str = "doc_id", least: float = 0.5
) -> DataFrame:
    """``docs`` with columns ``language``, ``posterior``, ``text_language`` and ``kept`` (underscores added where such names are taken)."""
    label = language_code(F.col(declared).cast("string")) if declared else F.lit(None).cast("string")
    names = {n: fresh(docs, n) for n in ("language", "posterior", "text_language", "kept", "_likelihood", "_host", "_label", "_suffix")}
    base = docs.withColumn(names["_host"], F.col(host).cast("string") if host else F.lit(None).cast("string"))
    base = base.withColumn(names["_label"], label).withColumn(names["_suffix"], F.col(suffix).cast("string") if suffix else F.lit(None).cast("string"))
    labels, model = fit(base, text, names["_label"], F.col(key))
    if not labels:
        empty = base.withColumn(names["language"], F.lit(None).cast("string")).withColumn(names["posterior"], F.lit(None).cast("double"))
        empty = empty.withColumn(names["text_language"], F.lit(None).cast("string")).withColumn(names["kept"], F.lit(False))
        return empty.drop(names["_host"], names["_label"], names["_suffix"])
    scored = with_likelihoods(base, text, model, names["_likelihood"])
    every = [*labels, UNKNOWN]
    best = lambda a: F.element_at(F.array(*map(F.lit, every)), F.array_position(a, F.array_max(a)).cast("int"))
    like = F.col(names["_likelihood"])
    facts = scored.where(like.isNotNull()).select(
        F.col(names["_host"]).alias("host"), F.col(names["_label"]).alias("label"), F.col(names["_suffix"]).alias("suffix"), best(like).alias("best")
    )
    # every row's verdict by text alone, as counts
    counts = saved(facts.groupBy("host", "label", "suffix", "best").agg(F.count("*").alias("n")), "evidence")
    seen = {r["best"]: float(r["n"]) for r in counts.groupBy("best").agg(F.sum("n").alias("n")).collect()}
    kinds = counts.agg(F.count_distinct("label").alias("label"), F.count_distinct("suffix").alias("suffix")).first()
    sums = [seen.get(v, 0.0) for v in every]
    whole = [(s + 1) / (sum(sums) + len(every)) for s in sums]
    array = lambda values: F.array(*map(F.lit, values))

    def told(rows: DataFrame, column: str) -> DataFrame:
        """``column`` and how many of its rows have each language."""
        by = rows.where(F.col(column).isNotNull()).groupBy(column, "best").agg(F.sum("n").cast("double").alias("n"))
        # one entry per language
        by = by.groupBy(column).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("by"))
        return by.select(column, F.transform(array(every), lambda v: F.coalesce(F.element_at("by", v), F.lit(0.0))).alias("n"))

    def given_language(column: str, name: str) -> DataFrame:
        """log P(column | language): each value's share of the language's rows that have one, add-one smoothed over all values."""
        having = counts.where(F.col(column).isNotNull()).groupBy("best").agg(F.sum("n").alias("n")).collect()
        rows_with = {r["best"]: float(r["n"]) for r in having}
        totals = array([rows_with.get(v, 0.0) + kinds[column] for v in every])
        return told(counts, column).select(F.col(column).alias(f"{name}_key"), F.zip_with("n", totals, lambda c, s: F.log((c + 1) / s)).alias(name))

    parent = F.when(F.size(F.split("host", r"\.")) > 2, F.substring_index("host", ".", -2))
    size = F.aggregate("n", F.lit(0.0), lambda a, c: a + c)
    smoothed = lambda up: F.zip_with("n", up, lambda c, w: c + WEIGHT * w)
    domains = told(counts.withColumn("domain", parent), "domain").withColumn("size", size + WEIGHT)
    domains = domains.select("domain", F.transform(smoothed(array(whole)), lambda c: c / F.col("size")).alias("up"))
    hosts = told(counts, "host").withColumn("size", size + WEIGHT).withColumn("domain", parent).join(domains, "domain", "left")
    hosts = hosts.withColumn("up", F.coalesce("up", array(whole)))
    priors = hosts.select(F.col("host").alias("prior_key"), F.transform(smoothed(F.col("up")), lambda c: F.log(c / F.col("size"))).alias("prior"))

    s, h = scored.alias("s"), priors.alias("h")
    d, x = given_language("label", "declared").alias("d"), given_language("suffix", "address").alias("x")
    at = lambda c: F.col(f"s.{names[c]}")
    joined = s.join(h, at("_host") == F.col("h.prior_key"), "left").join(d, at("_label") == F.col("d.declared_key"), "left").join(x, at("_suffix") == F.col("x.address_key"), "left")
    no_evidence = array([0.0] * len(every))
    add = lambda a, b: F.zip_with(a, b, lambda p, q: p + q)
    logs = add(at("_likelihood"), F.coalesce(F.col("h.prior"), array([math.log(w) for w in whole])))
    logs = add(add(logs, F.coalesce(F.col("d.declared"), no_evidence)), F.coalesce(F.col("x.address"), no_evidence))
    top = fresh(docs, "_top")
    fused = joined.select(*(F.col(f"s.`{c}`") for c in docs.columns), at("_likelihood"), logs.alias(top))
    share = F.lit(1.0) / F.aggregate(F.transform(F.col(top), lambda v: F.exp(v - F.array_max(F.col(top)))), F.lit(0.0), lambda a, b: a + b)
    out = fused.withColumn(names["language"], best(F.col(top))).withColumn(names["posterior"], share).withColumn(names["text_language"], best(like))
    kept = F.coalesce((F.col(names["language"]) != UNKNOWN) & (F.col(names["posterior"]) >= least), F.lit(False))
    return out.withColumn(names["kept"], kept).drop(names["_likelihood"], top)


def pages_as_documents(pages: DataFrame) -> DataFrame:
    """page_id, visible text, declared language, host and suffix of web pages.

    A null page has a null text, a page without a declaration a null language, and a url that is null or relative a null host and suffix.
    Repeated pages stay repeated. Other columns are ignored; an empty table gives an empty one.
    """
    markup = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
    declared = F.regexp_extract("html", r"""(?is)<html\b[^>]*\blang\s*=\s*["']?([A-Za-z]+)""", 1)
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    none = lambda c: F.when(c != "", c)
    return pages.select(
        F.col("page_id").cast("bigint"),
        F.regexp_replace("html", markup, " ").alias("text"),
        F.lower(none(declared)).alias("lang"),
        none(host).alias("host"),
        none(F.substring_index(host, ".", -1)).alias("suffix"),
    )
