"""Token ids as files of range asymmetric numeral system (rANS) blocks.

Ids come from the tokenizers library, one closing id after each document, in ascending doc_id order. One table of
frequencies, counted over the whole corpus and scaled to 2**SCALE with at least 1 for every id that occurs, is shared by all
blocks (*static* model). A block holds whole documents, ``BLOCK_IDS`` ids or the one document that exceeds this, and is coded
by ``LANES`` interleaved states: id i belongs to lane i mod LANES, so coder and decoder handle LANES ids at a time as numpy
arrays. Every ``EVERY`` ids a *checkpoint* keeps the lanes' states and the place in the stream, from which decoding can start;
a CRC-32 of payload and checkpoints and one of the ids guard each block.

The output folder has ``blocks`` (one row a block: where it stands, which documents it holds, checkpoints, payload, checksums) and ``model``
(id, frequency, start). Both are written as Parquet by Spark's committer, so a lost executor leaves no half file; blocks are
independent and are read back by as many tasks as there are splits.

Nulls: a null text is empty (the closing id alone); null doc_ids come first. Repeated rows and rows of equal doc_id each get their place, by
hash of the text. An empty table gives an empty folder and an empty result. Other columns are ignored.

The model has one row per id of the vocabulary and the places of blocks come from one sum per sort partition; only these reach the driver.
"""

from __future__ import annotations

import functools
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from wattmill.llm.common import arrow_schema, emit, saved, struct, text_key, texts_in_blocks
from wattmill.llm.word_blocks import pack, unpack

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCALE = 20
LANES = 1024
EVERY = 1 << 17
BLOCK_IDS = 1 << 19
LOW = np.uint64(1 << 31)
END_ID = 0
# n of the row with which a task tells how often it has met each id
COUNTS = -1
# words kept with their ids in a Python worker
CACHED_WORDS = 800_000
# a run of these is a piece of its own after letters (the apostrophe is not: "'s" is a piece)
MARKS = string.punctuation.replace("'", "")

TOKENS = struct(doc_id="long", key="long", n="long", ids="binary")
BLOCKS = struct(
    part="int",
    seq="int",
    doc_ids=T.ArrayType(T.LongType()),
    lengths=T.ArrayType(T.LongType()),
    n_ids="long",
    checkpoints="binary",
    payload="binary",
    stream_crc32="long",
    ids_crc32="long",
    first="long",
)
DOCUMENTS = struct(part="int", doc_id="long", before="long", n_tokens="long", ids_crc32="long")
COUNTED = struct(id="int", n="long")


def as_bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def byte_letters() -> dict[int, str]:
    """The printable letter that a byte-level vocabulary writes for each byte: itself if printable, else the next from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class Words(dict):
    """Ids of the words between spaces, found when first asked for.

    A word follows a space, or a line feed that it then begins with. Letters are one piece of the pattern and go straight to the
    library's BPE model; the marks that end a word are a piece of their own, so words are kept without them; anything else takes the
    library's whole way. When half of ``CACHED_WORDS`` are new, those not asked for since the half before are dropped.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.letters = byte_letters()
        self.space = self.letters[0x20]
        self.feed = as_bytes(self.library("\n"))
        self.older: dict[str, bytes] = {}

    def library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word) or self.found(word)
        if len(self) >= CACHED_WORDS // 2:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def found(self, word: str) -> bytes:
        after_feed = word[0] == "\n"
        body = word[1:] if after_feed else word
        if body.isalpha():
            spelt = body if body.isascii() else body.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [t.id for t in self.model.tokenize(spelt if after_feed else self.space + spelt)]).tobytes()
        else:
            ids = as_bytes(self.library(body if after_feed else " " + body))
        return self.feed + ids if after_feed else ids

    def of_all(self, words: list[str]) -> list[bytes]:
        out = []
        for word in words:
            bare = word.rstrip(MARKS)
            if len(bare) < len(word) and bare.lstrip("\n").isalpha():
                out.append(self[bare] + self["\n" + word[len(bare) :]][len(self.feed) :])
            else:
                out.append(self[word])
        return out


class CachedTokenizer:
    """The library's ids, with the ids of words remembered.

    A byte-level tokenizer with the usual pattern starts a new piece at every single space, and before and after every single line
    feed, that stands between two visible characters. Texts of visible characters and such spaces and line feeds are cut there;
    all others, and texts that hold a special token, go to the library whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = Words(self.tokenizer)

    def plain(self, text: str) -> bool:
        flat = text.replace("\n", " ")
        # printable: no white space but plain spaces
        return bool(flat) and "  " not in flat and flat[0] != " " and flat[-1] != " " and flat.isprintable() and not any(s in text for s in self.special)

    def encode_all(self, texts: list[str], end: int) -> list[np.ndarray]:
        """Ids of each text with the closing id."""
        plain = [self.plain(t) for t in texts]
        # every text begins with a line feed, whose id then makes room for the closing id
        spelt = pa.array(["\n" + t.replace("\n", " \n") for t, p in zip(texts, plain, strict=True) if p], pa.string())
        cut = iter(self._encode_plain(spelt, end)) if len(spelt) else iter(())
        odd = (np.array([*self.words.library(t), end], dtype="<u4") for t, p in zip(texts, plain, strict=True) if not p)
        return [next(cut) if p else next(odd) for p in plain]

    def _encode_plain(self, texts: pa.Array, end: int) -> list[np.ndarray]:
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        ids = self.words.of_all(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        begins = np.cumsum(lengths) - lengths
        own = lengths[at]
        ends = np.cumsum(own)
        found = flat[np.repeat(begins[at] - (ends - own), own) + np.arange(ends[-1])]
        stops = ends[split.offsets.to_numpy()[1:] - 1]
        out = np.empty_like(found)
        out[:-1] = found[1:]
        out[stops - 1] = end
        return np.split(out, stops[:-1])


@functools.lru_cache(maxsize=1)
def cached_tokenizer(path: str) -> CachedTokenizer:
    """One for all tasks of a Python worker."""
    return CachedTokenizer(path)


def tokens(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, key, n, ids): the packed ids of every text with the closing id.

    The last row of each task has n = ``COUNTS`` and, for ids, how often the task has met each id.
    """
    schema = arrow_schema(TOKENS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tokenizer = cached_tokenizer(path)
        met = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for part, texts in texts_in_blocks(batch, 2):
                found = tokenizer.encode_all([t.decode("utf-8", "replace") for t in texts], END_ID)
                met = added(np.bincount(np.concatenate(found)).astype(np.uint64), met)
                for doc_id, key, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), found, strict=True):
                    yield doc_id, key, len(ids), pack(ids.astype("<u2") if len(met) <= 1 << 16 else ids)
        if len(met):
            yield None, None, COUNTS, pack(met)

    rows_in = docs.select(F.col("doc_id").cast("bigint"), text_key(F.col("text")).alias("key"), "text")
    return rows_in.mapInArrow(lambda batches: emit(schema, rows(batches)), TOKENS)


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of counts of which one may reach further."""
    longer, shorter = (a, b) if len(a) >= len(b) else (b, a)
    longer = longer.copy()
    longer[: len(shorter)] += shorter
    return longer


def count_ids(found: DataFrame) -> DataFrame:
    schema = arrow_schema(COUNTED)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column(0).to_pylist():
                total = unpack(row)
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used].astype(np.int64))], schema=schema)

    return found.where(F.col("n") == COUNTS).select("ids").mapInArrow(count, COUNTED).groupBy("id").agg(F.sum("n").alias("n"))


class Model:
    """Frequencies scaled to 2**SCALE, the start of each id's range, and the id of each slot."""

    def __init__(self, counts: dict[int, int]):
        size = max(counts) + 1
        self.freq = np.zeros(size, dtype=np.uint64)
        total = sum(counts.values())
        for i, n in counts.items():
            self.freq[i] = max(1, (n << SCALE) // total)
        rest = (1 << SCALE) - int(self.freq.sum())
        by_size = np.argsort(-self.freq.astype(np.int64), kind="stable")
        for i in by_size if rest < 0 else by_size[:1]:  # frequent ids give back what the rare were raised by
            change = rest if rest > 0 else -min(-rest, int(self.freq[i]) // 2)
            self.freq[i] = int(self.freq[i]) + change
            rest -= change
            if not rest:
                break
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.id_at = np.repeat(np.arange(size, dtype=np.uint32), self.freq.astype(np.int64))


def encode_block(ids: np.ndarray, model: Model) -> tuple[np.ndarray, bytes]:
    """Checkpoints (row, place in the stream, states) and the stream of 32-bit words."""
    state = np.full(LANES, LOW, dtype=np.uint64)
    freq, start = model.freq[ids], model.start[ids]
    limit = freq << np.uint64(63 - SCALE)
    words: list[np.ndarray] = []
    sent = 0
    marks = []
    for row in range((len(ids) - 1) // LANES, -1, -1):
        at = slice(row * LANES, min(len(ids), (row + 1) * LANES))
        f = freq[at]
        x = state[: len(f)]
        over = x >= limit[at]
        out = (x[over] & np.uint64(0xFFFFFFFF)).astype("<u4")
        x = np.where(over, x >> np.uint64(32), x)
        whole = x // f
        state[: len(f)] = (whole << np.uint64(SCALE)) + (x - whole * f) + start[at]
        words.append(out)
        sent += len(out)
        if row * LANES % EVERY == 0:
            marks.append((row, sent, state.copy()))
    kind = np.dtype([("row", "<u4"), ("place", "<u4"), ("state", "<u8", LANES)])
    checkpoints = np.array([(row, sent - e, s) for row, e, s in reversed(marks)], dtype=kind)
    return checkpoints, np.concatenate(words[::-1]).tobytes()


def decode_block(n_ids: int, checkpoints: bytes, payload: bytes, model: Model, first: int = 0, count: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of a block, decoded from the last checkpoint before them."""
    marks = np.frombuffer(checkpoints, dtype=np.dtype([("row", "<u4"), ("place", "<u4"), ("state", "<u8", LANES)]))
    stream = np.frombuffer(payload, dtype="<u4").astype(np.uint64)
    stop = n_ids if count is None else min(n_ids, first + count)
    mark = marks[np.searchsorted(marks["row"], first // LANES, side="right") - 1]
    state, at, begin = mark["state"].copy(), int(mark["place"]), int(mark["row"])
    rows = []
    mask = np.uint64((1 << SCALE) - 1)
    for row in range(begin, (stop + LANES - 1) // LANES):
        x = state[: min(LANES, n_ids - row * LANES)]
        slot = x & mask
        ids = model.id_at[slot.astype(np.int64)]
        x = model.freq[ids] * (x >> np.uint64(SCALE)) + slot - model.start[ids]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << np.uint64(32)) | stream[at : at + len(low)]
        at += len(low)
        state[: len(x)] = x
        rows.append(ids)
    found = np.concatenate(rows) if rows else np.zeros(0, dtype=np.uint32)
    return found[first - begin * LANES : stop - begin * LANES]


def load_model(folder_model: DataFrame) -> Broadcast:
    """Bounded by the vocabulary."""
    counts = {r.id: r.n for r in folder_model.collect()}
    return folder_model.sparkSession.sparkContext.broadcast(Model(counts) if counts else None)


def encode_blocks(found: DataFrame, model: Broadcast) -> DataFrame:
    schema = arrow_schema(BLOCKS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        seq, first, held = 0, 0, []
        size = 0

        def block() -> tuple:
            ids = np.concatenate([x for _, x in held])
            marks, stream = encode_block(ids, model.value)
            raw = marks.tobytes()
            crcs = zlib.crc32(stream, zlib.crc32(raw)), zlib.crc32(ids.astype("<u4").tobytes())
            return part, seq, [d for d, _ in held], [len(x) for _, x in held], len(ids), raw, stream, *crcs, first

        for batch in batches:
            for doc_id, n, ids in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), strict=True):
                if held and size + n > BLOCK_IDS:
                    yield block()
                    seq, first, held, size = seq + 1, first + size, [], 0
                held.append((doc_id, unpack(ids)))
                size += n
        if held:
            yield block()

    ordered = found.where(F.col("n") != COUNTS).repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key")
    return ordered.mapInArrow(lambda batches: emit(schema, rows(batches), 16), BLOCKS)


def decode_documents(blocks: DataFrame, model: Broadcast) -> DataFrame:
    """(part, doc_id, before, n_tokens, ids_crc32): what the files hold, with the ids before the document in its partition."""
    schema = arrow_schema(DOCUMENTS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.slice(i, 1).to_pylist()[0]
                if zlib.crc32(b["payload"], zlib.crc32(b["checkpoints"])) != b["stream_crc32"]:
                    raise ValueError(f"block {b['part']}/{b['seq']} is damaged")
                ids = decode_block(b["n_ids"], b["checkpoints"], b["payload"], model.value).astype("<u4").tobytes()
                if zlib.crc32(ids) != b["ids_crc32"]:
                    raise ValueError(f"block {b['part']}/{b['seq']} decodes to other ids")
                at = 0
                for doc_id, n in zip(b["doc_ids"], b["lengths"], strict=True):
                    yield b["part"], doc_id, b["first"] + at, n, zlib.crc32(ids[4 * at : 4 * (at + n)])
                    at += n

    return blocks.mapInArrow(lambda batches: emit(schema, rows(batches), 10_000), DOCUMENTS)


def write_rans(docs: DataFrame, path: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """Tables of the written ``blocks`` and ``model``."""
    found = saved(tokens(docs, path), "tokens")
    model = saved(count_ids(found).orderBy("id"), "rans-model")
    return saved(encode_blocks(found, load_model(model)), "rans-blocks"), model


def read_rans(blocks: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    per_part = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = per_part.select("part", before.alias("offset"))  # one row per partition of the sort
    decoded = decode_documents(blocks, load_model(model))
    return decoded.join(offsets, "part").select("doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """Writes the files and reads them back."""
    return read_rans(*write_rans(docs, path))
