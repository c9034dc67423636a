"""Texts as blocks: each block lists its distinct words once and holds its documents as numbers into that list.

A word of the corpus then travels once per block instead of once per occurrence, so a word that makes up a third of all
text is a few bytes per block. ``deal`` sends the words of all blocks to partitions by hash, where every occurrence of a word
meets; the answers go back to their block in the order of its list.

Blocks end at ``BLOCK_BYTES`` of text (a longer document is a block of its own). The table of blocks is written to the shared
folder before anything uses it: the numbers of blocks and words never change under a retry.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.llm.common import arrow_schema, bucketed, emit, struct, texts_in_blocks

BLOCK_BYTES = 8 << 20

BLOCKS = struct(block="long", doc_ids=T.ArrayType(T.LongType()), lengths=T.ArrayType(T.IntegerType()), numbers="binary", words="binary")
DEALT = struct(part="int", block="long", payload="binary")


_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def press(data: bytes) -> bytes:
    return _COMPRESSOR.compress(data)


def unpress(data: bytes) -> bytes:
    return _DECOMPRESSOR.decompress(data)


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, byte plane by byte plane, so that the many small ones cost little."""
    flat = np.ascontiguousarray(numbers)
    return bytes([flat.dtype.itemsize]) + press(flat.view(np.uint8).reshape(-1, flat.dtype.itemsize).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(unpress(data[1:]), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()


def text_blocks(docs: DataFrame, reduced: Callable[[bytes], bytes] = bytes) -> DataFrame:
    """The written table of blocks. Words are what ASCII white space separates; a null text has none.

    Words are numbered by how often the block has them, so that frequent words get small numbers.
    """
    schema = arrow_schema(BLOCKS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        task = TaskContext.get().partitionId()
        seq = 0
        for batch in batches:
            for part, texts in texts_in_blocks(batch, 1, BLOCK_BYTES):
                yield (task << 32 | seq, part.column(0).to_pylist(), *_block([reduced(t) for t in texts]))
                seq += 1
                pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    # what returns to its block is dealt to the buckets, and the blocks stay where they are
    return bucketed(rows.mapInArrow(lambda batches: emit(schema, cut(batches), 1), BLOCKS), "blocks", "block", parts_for(docs))


def _block(texts: list[bytes]) -> tuple[list[int], bytes, bytes]:
    """Words in each text, the packed number of each word, and the words by number."""
    # gives an empty word before leading and after trailing white space, and for a text without words
    split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string(), safe=False))
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    at = coded.indices.to_numpy()
    counts = np.bincount(at, minlength=len(words))
    order = np.argsort(-counts, kind="stable")
    if b"" in words:
        order = order[order != words.index(b"")]
    number = np.full(len(words), -1, dtype=np.int64)
    number[order] = np.arange(len(order))
    numbers = number[at]
    kept = numbers >= 0
    ends = np.cumsum(kept)[split.offsets.to_numpy()[1:] - 1]
    lengths = np.diff(ends, prepend=0)
    return lengths.tolist(), pack(numbers[kept].astype(np.uint32)), press(b" ".join([words[i] for i in order.tolist()]))


def words_in(data: bytes) -> list[bytes]:
    raw = unpress(data)
    return raw.split(b" ") if raw else []


def parts_for(docs: DataFrame) -> int:
    """How many partitions the words are dealt to: it grows with the input, whose scan has a partition for each share of bytes."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())


def home(words: list[bytes], parts: int) -> np.ndarray:
    """The partition that each word is dealt to."""
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words)) % parts


def places(words: list[bytes], parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(partition, numbers of the block's words dealt to it), for partitions that get any."""
    at = home(words, parts)
    order = np.argsort(at, kind="stable")
    used, starts = np.unique(at[order], return_index=True)
    for part, own in zip(used.tolist(), np.split(order, starts[1:]), strict=True):
        yield part, own
