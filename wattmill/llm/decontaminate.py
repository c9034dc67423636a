"""Benchmark decontamination by Wu-Manber multi-pattern search.

A benchmark item gives as patterns all windows of ``width`` consecutive words (an item of fewer words is one pattern). Texts are
reduced to lower-case words with one space around each, so a window occurs where its bytes occur. For patterns of one
class (those of full width, and short ones by their length in words), m is the least length in bytes:

* the *shift table* tells for a hashed block of B bytes how far the search may move on, because no pattern's first m bytes
  have that block nearer to their end; unknown blocks allow m - B + 1;
* where the shift is 0, the hash of the last m bytes selects a *bucket* of test strings;
* a *direct comparison* of bytes confirms each occurrence.

The search keeps one position for every stretch of a batch of texts and moves all of them together, as numpy arrays.
Documents are only scanned, never shuffled. Patterns go out in blocks of at most ``PATTERN_BYTES`` of item text: each block is
one bounded broadcast, and a benchmark of any size becomes more blocks, held one at a time in a task.

Nulls: null or wordless texts have no words and are never contaminated; null or wordless items have no window. An item without an id marks words but
is neither counted nor listed. Items that share an id are one item. Repeated rows are judged alike. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.llm.common import arrow_schema, struct, texts_in_blocks

PATTERN_BYTES = 8 << 20
TEXT_BYTES = 2 << 20  # text scanned at a time, in stretches of ``STRETCH`` bytes
STRETCH = 128
TABLE_BITS = 20
FACTOR = np.uint64(0x9E3779B97F4A7C15)
# everything that is not a word byte becomes a space; A-Z become a-z
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

HITS = struct(
    doc_id="long",
    n_words="long",
    n_hit="long",
    n_items="long",
    items_sha256="string",
    contaminated="bool",
    items=T.ArrayType(T.StringType()),
    spans=T.ArrayType(struct(first="long", last="long")),
)


def words_of(text: bytes) -> bytes:
    """The words with one space before, between and after them."""
    words = text.translate(TO_WORDS).split()
    return b" " + b" ".join(words) + b" " if words else b""


def windows_of(text: bytes, width: int) -> list[bytes]:
    words = words_of(text).split()
    return [b" " + b" ".join(words[i : i + width]) + b" " for i in range(max(1, len(words) - width + 1))] if words else []


def slots(columns: list[np.ndarray] | np.ndarray) -> np.ndarray:
    """Place in the shift table of blocks whose first bytes, second bytes and so on are the columns."""
    code = np.zeros(len(columns[0]), dtype=np.uint64)
    for column in columns:
        code = (code << np.uint64(8)) | column
    return (code * FACTOR >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


@dataclass
class PatternClass:
    """Tables for patterns of which the shortest has ``m`` bytes. Patterns meet a text at the end of their first m bytes."""

    m: int
    block: int
    shift: np.ndarray
    suffix: np.ndarray  # sorted hashes of the first m bytes
    starts: np.ndarray  # where the bucket of each hash begins in ``order``
    order: list[int]
    patterns: list[bytes]
    items: list[list[str | None]]

    @classmethod
    def build(cls, owners: dict[bytes, set[str | None]]) -> PatternClass:
        patterns = sorted(owners)
        m = min(map(len, patterns))
        block = min(8, m)
        shift = np.full(1 << TABLE_BITS, m - block + 1, dtype=np.int32)
        heads = np.array([np.frombuffer(p[:m], dtype=np.uint8) for p in patterns])
        for at in range(m - block + 1):
            np.minimum.at(shift, slots(heads[:, at : at + block].T), m - block - at)
        hashes = head_hashes(heads)
        order = np.argsort(hashes, kind="stable")
        suffix, starts = np.unique(hashes[order], return_index=True)
        return cls(m, block, shift, suffix, np.append(starts, len(order)), order.tolist(), patterns, [sorted(owners[p], key=lambda x: (x is None, x)) for p in patterns])

    def search(self, data: np.ndarray, raw: bytes) -> Iterator[tuple[int, int]]:
        """(start, pattern) of every occurrence in ``data``."""
        last = len(data) - self.block
        if len(data) < self.m:
            return
        first = self.m - self.block  # the block that ends the first m bytes
        pos = np.arange(first, last + 1, STRETCH, dtype=np.int64)
        stop = np.minimum(pos + STRETCH, last + 1)
        while len(pos):
            step = self.shift[slots([data[pos + k] for k in range(self.block)])]
            zero = step == 0
            if zero.any():
                yield from self._confirm(pos[zero] + self.block - self.m, data, raw)
            pos = pos + np.maximum(step, 1)
            left = pos < stop
            if not left.all():
                pos, stop = pos[left], stop[left]

    def _confirm(self, at: np.ndarray, data: np.ndarray, raw: bytes) -> Iterator[tuple[int, int]]:
        hashes = head_hashes(data[at[:, None] + np.arange(self.m)])
        slot = np.searchsorted(self.suffix, hashes)
        known = slot < len(self.suffix)
        known[known] = self.suffix[slot[known]] == hashes[known]
        for start, bucket in zip(at[known].tolist(), slot[known].tolist(), strict=True):
            for p in self.order[self.starts[bucket] : self.starts[bucket + 1]]:
                if raw.startswith(self.patterns[p], start):
                    yield start, p


def head_hashes(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes."""
    out = np.zeros(len(rows), dtype=np.uint64)
    for k in range(rows.shape[1]):
        out = (out ^ rows[:, k]) * FACTOR
        out ^= out >> np.uint64(29)
    return out


def build_tables(items: list[tuple[str | None, bytes]], width: int) -> list[PatternClass]:
    classes: dict[int, dict[bytes, set[str | None]]] = {}
    for item_id, text in items:
        for window in windows_of(text, width):
            classes.setdefault(window.count(b" ") - 1, {}).setdefault(window, set()).add(item_id)
    return [PatternClass.build(owners) for _, owners in sorted(classes.items())]


def pattern_blocks(benchmark: DataFrame, width: int, most_bytes: int = PATTERN_BYTES) -> list[Broadcast]:
    """The query set in blocks, each broadcast as tables of bounded size. Rows stream to the driver one partition at a time."""
    sc = benchmark.sparkSession.sparkContext
    out, block, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    for item_id, text in rows.toLocalIterator():
        block.append((item_id, bytes(text)))
        size += len(text)
        if size >= most_bytes:
            out.append(sc.broadcast(build_tables(block, width)))
            block, size = [], 0
    if block:
        out.append(sc.broadcast(build_tables(block, width)))
    return out


class Scan:
    """Occurrences in a batch of texts, as one buffer."""

    def __init__(self, texts: list[bytes]):
        reduced = [words_of(t) for t in texts]
        self.raw = b"".join(reduced)
        self.data = np.frombuffer(self.raw, dtype=np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum([len(r) for r in reduced])])
        # spaces before each byte
        self.gaps = gaps = np.zeros(len(self.data) + 1, dtype=np.int32 if len(self.data) < 1 << 31 else np.int64)
        np.cumsum(self.data == 32, dtype=gaps.dtype, out=gaps[1:])
        self.n_words = np.maximum(gaps[self.bounds[1:]] - gaps[self.bounds[:-1]] - 1, 0)
        self.spans: dict[int, list[tuple[int, int]]] = {}
        self.items: dict[int, set[str]] = {}

    def look_for(self, tables: list[PatternClass]) -> None:
        for table in tables:
            for start, p in table.search(self.data, self.raw):
                # a window cannot reach over two texts: at a seam there are two spaces
                doc = int(np.searchsorted(self.bounds, start, side="right")) - 1
                first = int(self.gaps[start] - self.gaps[self.bounds[doc]])
                self.spans.setdefault(doc, []).append((first, first + table.patterns[p].count(b" ") - 2))
                self.items.setdefault(doc, set()).update(i for i in table.items[p] if i is not None)

    def result(self, doc: int) -> tuple[int, int, list[str], list[tuple[int, int]]]:
        """n_words, n_hit, sorted items and merged spans (numbers of first and last word)."""
        merged: list[list[int]] = []
        for first, last in sorted(self.spans.get(doc, ())):
            if merged and first <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], last)
            else:
                merged.append([first, last])
        n_hit = sum(last - first + 1 for first, last in merged)
        return int(self.n_words[doc]), n_hit, sorted(self.items.get(doc, ())), [(a, b) for a, b in merged]


def scanner(blocks: list[Broadcast]) -> Callable[[list[bytes]], Scan]:
    def scan(texts: list[bytes]) -> Scan:
        found = Scan(texts)
        for block in blocks:
            found.look_for(block.value)
            if len(blocks) > 1:
                del block._value  # read again from the executor's copy when next needed: one block in memory at a time
        return found

    return scan


def is_contaminated(n_words: int, n_hit: int, least_share: int = 20) -> bool:
    return n_hit > 0 and least_share * n_hit >= n_words


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """Words, hit words, items found and the verdict for every document, with the hit word spans."""
    scan = scanner(pattern_blocks(benchmark, width))
    schema = arrow_schema(HITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in texts_in_blocks(batch, 1, TEXT_BYTES):
                found = scan(texts)
                rows = [found.result(i) for i in range(len(texts))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([n for n, *_ in rows], pa.int64()),
                        pa.array([h for _, h, *_ in rows], pa.int64()),
                        pa.array([len(x) for _, _, x, _ in rows], pa.int64()),
                        pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for _, _, x, _ in rows]),
                        pa.array([is_contaminated(n, h) for n, h, *_ in rows]),
                        pa.array([x for *_, x, _ in rows], schema.field(6).type),
                        pa.array([[{"first": a, "last": b} for a, b in s] for *_, s in rows], schema.field(7).type),
                    ],
                    schema=schema,
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, HITS)


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """``docs`` without the contaminated rows, all columns as they were."""
    scan = scanner(pattern_blocks(benchmark, width))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in texts_in_blocks(batch, at, TEXT_BYTES):
                found = scan(texts)
                keep = [not is_contaminated(*found.result(i)[:2]) for i in range(len(texts))]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
