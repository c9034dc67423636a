"""Quality classifier: ridge regression on random Fourier features, calibrated by isotonic regression.

Each whole text becomes ``STATISTICS``, standardised over the labelled rows. ``FEATURES`` random cosines of them approximate a Gaussian kernel.
Every task sums the normal equations of its rows; the sums travel in blocks of matrix rows, each added up as a stream, and the
driver solves one system of ``FEATURES`` + 1 unknowns. The raw scores of labelled rows that were set aside are counted in bins of equal width,
and pooling adjacent violators over the bins gives the calibrated probability, linear between the pools.

Labels are those of documents whose crc32(doc_id as text) mod 5 is 1 to 3 for the fit and 4 for the calibration; remainder 0 is
held out. No sample is drawn: all labelled rows count. Language, source and id are no inputs.

Nulls: a null text is empty, and an empty text has all statistics 0 and gets a score like any other; a null doc_id is held out. Null labels are ignored, several
labels of one document are averaged; rows of equal doc_id each count and are scored by their own text. Without labels every score is 0.5,
without rows to calibrate on the raw score is cut to 0..1. Other columns are ignored. An empty table gives an empty result.

What reaches the driver is bounded by ``FEATURES`` and ``BINS``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.llm.common import arrow_schema, emit, raw_texts, saved, struct

STATISTICS = (
    "log_bytes", "log_words", "log_word_length", "upper", "digits", "symbols", "exclamations", "marks", "not_ascii", "lines_per_word",
    "distinct", "log_distinct", "top_word", "word_again", "distinct_pairs", "lines_again", "words_without_letters", "log_words_per_line",
    "log_longest_word",
)
FEATURES = 256
RIDGE = 1e-4
BINS = 2048
LOW, HIGH = -0.5, 1.5
ROWS_PER_BLOCK = 16
FOLDS = 5
THRESHOLD = 0.3

ALL = bytes(range(256))
UPPERS = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#*$%&|<>@^~_{}[]\\=+"
EXCLAMATIONS = b"!?"
MARKS = b".,;:'\"()-/`"
NOT_ASCII = bytes(range(128, 256))
NO_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())

STATS = struct(doc_id="long", x=T.ArrayType(T.DoubleType()))
SUMS = struct(block="int", sums="binary")
SCORES = struct(doc_id="long", held_out="bool", score="double", predicted="int")


def statistics_of(text: bytes) -> list[float]:
    size = len(text)
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    share = lambda kind: (size - len(text.translate(None, kind))) / size
    times = Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    pairs = list(zip(words, words[1:], strict=False))
    wordless = sum(c for w, c in times.items() if not w.translate(None, NO_LETTERS))
    return [
        math.log1p(size),
        math.log1p(n),
        math.log1p(sum(map(len, words)) / n),
        share(UPPERS),
        share(DIGITS),
        share(SYMBOLS),
        share(EXCLAMATIONS),
        share(MARKS),
        share(NOT_ASCII),
        len(lines) / n,
        len(times) / n,
        math.log(len(times)) / math.log(n + 1),
        max(times.values()) / n,
        sum(a == b for a, b in pairs) / n,
        len(set(pairs)) / n,
        1 - len(set(lines)) / len(lines),
        wordless / n,
        math.log1p(n / len(lines)),
        math.log1p(max(map(len, times))),
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of every whole text."""
    schema = arrow_schema(STATS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), strict=True):
                yield doc_id, statistics_of(text)

    rows_in = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows_in.mapInArrow(lambda batches: emit(schema, rows(batches), 10_000), STATS)


def fold() -> Column:
    """Remainder of the id's CRC-32; a null id is in the held-out fold."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % FOLDS, F.lit(0)).cast("int")


def labelled(stats: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(fold, y, x) of the rows whose labels may be learned."""
    known = labels.select(F.col("doc_id").cast("bigint"), F.col(label).cast("double").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
    # one row a document, so that the join cannot multiply rows
    known = known.groupBy("doc_id").agg(F.avg("y").alias("y"))
    return stats.withColumn("fold", fold()).where("fold > 0").join(known, "doc_id").select("fold", "y", "x")


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random cosines and a constant."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        cosines = np.cos(z @ self.directions + self.phases) * math.sqrt(2 / len(self.phases))
        return np.concatenate([cosines, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        raw = self.raw(x)
        return np.clip(raw if self.knots is None else np.interp(raw, *self.knots), 0, 1)


def drawn(rows: DataFrame, features: int, seed: int) -> Model:
    """Means and spreads of the statistics (one row to the driver) and the random directions of a kernel as wide as the data."""
    size = len(STATISTICS)
    found = rows.agg(*(f(F.col("x")[i]).alias(f"{f.__name__}{i}") for f in (F.avg, F.stddev_pop) for i in range(size))).first()
    mean, spread = np.array([found[:size], found[size:]], dtype=float)
    draw = np.random.default_rng(seed)
    directions = draw.normal(size=(size, features)) / math.sqrt(size)
    return Model(mean, np.where(spread > 1e-9, spread, 1.0), directions, draw.uniform(0, 2 * math.pi, features))


def normal_equations(rows: DataFrame, model: Model) -> np.ndarray:
    """Sums over all rows of the outer products of features, with label and count in further columns: one matrix to the driver."""
    schema = arrow_schema(SUMS)
    width = len(model.phases) + 2
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        total = np.zeros((width - 1, width))
        for batch in batches:
            if batch.num_rows:
                z = shared.value.features(matrix(batch.column(1)))
                total += z.T @ np.concatenate([z, batch.column(0).to_numpy()[:, None]], axis=1)
        for block, at in enumerate(range(0, width - 1, ROWS_PER_BLOCK)):
            yield block, total[at : at + ROWS_PER_BLOCK].tobytes()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                totals[block] = totals.get(block, 0) + np.frombuffer(sums)
        for block, sums in totals.items():
            yield block, sums.tobytes()

    parts = rows.select("y", "x").mapInArrow(lambda batches: emit(schema, own(batches)), SUMS)
    blocks = parts.repartition("block").mapInArrow(lambda batches: emit(schema, add(batches)), SUMS).collect()
    return np.concatenate([np.frombuffer(r.sums).reshape(-1, width) for r in sorted(blocks, key=lambda r: r.block)]) if blocks else np.zeros((width - 1, width))


def solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    """Weights of features and constant; the constant is not shrunk."""
    products, targets = sums[:, :-1], sums[:, -1]
    penalty = np.full(len(products), ridge * products[-1, -1])
    penalty[-1] = 0
    return np.linalg.solve(products + np.diag(penalty), targets)


def pooled(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of y on ascending x by pooling adjacent violators: the pools' mean places and values."""
    pools: list[list[float]] = []
    for place, value, w in zip(x.tolist(), y.tolist(), weight.tolist(), strict=True):
        pools.append([place * w, value * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    places, values, weights = np.array(pools).T
    return places / weights, values / weights


def calibrated(rows: DataFrame, model: Model) -> Model:
    """The model with the knots of the calibration, from counts by bin of the raw score."""
    schema = arrow_schema(struct(bin="int", y="double", raw="double"))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = np.clip(shared.value.raw(matrix(batch.column(1))), LOW, HIGH)
                bins = np.minimum(((own - LOW) / (HIGH - LOW) * BINS).astype(np.int32), BINS - 1)
                yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(0), pa.array(own)], schema=schema)

    scored = rows.select("y", "x").mapInArrow(raw, struct(bin="int", y="double", raw="double"))
    bins = scored.groupBy("bin").agg(F.avg("y").alias("y"), F.avg("raw").alias("raw"), F.count("*").alias("n")).orderBy("bin").collect()
    if bins:
        model.knots = pooled(*(np.array([r[c] for r in bins], dtype=float) for c in ("raw", "y", "n")))
    return model


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = 13) -> Model:
    """A model of (fold, y, x) rows."""
    learned = rows.where(F.col("fold") < FOLDS - 1)
    model = drawn(learned, features, seed)
    sums = normal_equations(learned, model)
    if not sums[-1, -2]:
        return model
    model.weights = solve(sums, ridge)
    return calibrated(rows.where(F.col("fold") == FOLDS - 1), model)


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    schema = arrow_schema(SCORES)
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = shared.value.score(matrix(batch.column(2)))
                columns = [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return stats.select("doc_id", (fold() == 0).alias("held_out"), "x").mapInArrow(run, SCORES)


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    stats = saved(statistics(docs), "statistics")
    return scored(stats, fit(saved(labelled(stats, labels, label), "labelled")))
