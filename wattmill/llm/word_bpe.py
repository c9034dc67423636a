"""BPE encoding and decoding through a table of distinct words.

Texts are split at ASCII white space in Spark. Each distinct word of the corpus is encoded once, by the tokenizers library and in
the partition that its hash selects; its ids return to every block that has the word and are joined back by the word's
number at each position. Decoding joins the distinct words' ids with the table of id and piece and puts the pieces of a
text together with spaces, as the library does for a tokenizer without a decoder.

That words can be encoded apart needs a tokenizer that drops white space, whose normaliser works character by character
(plus canonical composition, which never crosses white space) and whose special tokens hold no white space; ``word_bpe_49k.json``
is of that kind. ``check_tokenizer`` refuses others.

Nulls: a null text is encoded as empty, a null doc_id stays null. Repeated rows each get their row. An empty table gives an empty result.
Other columns are ignored. The id-to-piece table has one row per id of the vocabulary: bounded by the file, not by the corpus.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from wattmill.llm.common import arrow_schema, emit, struct
from wattmill.llm.word_blocks import DEALT, pack, parts_for, places, press, text_blocks, unpack, words_in

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ENCODED = struct(doc_id="long", n_tokens="long", ids="binary", decoded="binary")
DIGESTS = struct(doc_id="long", n_tokens="long", ids_sha256="string", decoded_sha256="string")


@functools.lru_cache(maxsize=1)
def worker_tokenizer(path: str) -> Tokenizer:
    """One for all tasks of a Python worker."""
    return load(path)


def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def check_tokenizer(path: str) -> None:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [spec["normalizer"]] if spec["normalizer"] else [])]
    first = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    drops_space = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    if spec["decoder"] or not drops_space or not set(kinds) <= {"NFC", "Replace", "Lowercase"} or any(" " in t["content"] for t in spec["added_tokens"]):
        raise ValueError(f"{path}: words can't be encoded apart from their surroundings")


def pieces(path: str) -> list[str]:
    """Piece of each id."""
    tokenizer = load(path)
    return [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]


def encode_words(dealt: DataFrame, path: str) -> DataFrame:
    """Ids of every word in the order of its block: each distinct word is encoded once, in the partition where all its rows meet."""
    schema = arrow_schema(DEALT)

    def encode(_: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(path)
        known: dict[bytes, bytes] = {}

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for part, block, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "payload")), strict=True):
                    words = words_in(payload)
                    new = [w for w in dict.fromkeys(words) if w not in known]
                    for i in range(0, len(new), 2_000):
                        some = new[i : i + 2_000]
                        texts = [w.decode("utf-8", "replace") for w in some]
                        for word, found in zip(some, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                            known[word] = np.array(found.ids, dtype=np.uint32).tobytes()
                    yield part, block, join_ids([known[w] for w in words])

        return emit(schema, rows(), 500, 8 << 20)

    return dealt.groupBy("part").applyInArrow(encode, DEALT)


def deal_words(blocks: DataFrame, parts: int) -> DataFrame:
    schema = arrow_schema(DEALT)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_in(data)
                for part, own in places(words, parts):
                    yield part, block, press(b" ".join([words[i] for i in own.tolist()]))

    return blocks.select("block", "words").mapInArrow(lambda batches: emit(schema, rows(batches), 500, 8 << 20), DEALT)


def join_ids(ids: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, ids), dtype=np.uint32, count=len(ids)) // 4
    sizes = pack(lengths)
    return len(sizes).to_bytes(4, "little") + sizes + pack(np.frombuffer(b"".join(ids), dtype=np.uint32))


def split_ids(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(payload[:4], "little")
    return unpack(payload[4 : 4 + size]), unpack(payload[4 + size :])


def encode(docs: DataFrame, path: str = TOKENIZER, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the decoded text in UTF-8; or SHA-256 of the two."""
    check_tokenizer(path)
    parts = parts_for(docs)
    blocks = text_blocks(docs)
    answers = encode_words(deal_words(blocks, parts), path)
    # bounded by the vocabulary; each piece brings the space that follows it
    table = docs.sparkSession.sparkContext.broadcast(pa.array([p.encode() + b" " for p in pieces(path)], pa.binary()))
    out = DIGESTS if digests else ENCODED
    schema = arrow_schema(out)

    def texts(block: pa.Table, found: pa.Table) -> Iterator[tuple]:
        if not block.num_rows:
            return
        row = block.to_pylist()[0]
        answer = dict(zip(found.column("part").to_pylist(), found.column("payload").to_pylist(), strict=True))
        dealt = list(places(words_in(row["words"]), parts))
        if not dealt:
            dealt, answer = [(0, np.zeros(0, dtype=np.int64))], {0: join_ids([])}
        split = [split_ids(answer[part]) for part, _ in dealt]
        lengths, ids = (np.concatenate(x) for x in zip(*split, strict=True))
        stops = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        # the id-to-piece join: pieces of all words in a row, then cut into words
        spelt = table.value.take(pa.array(ids, pa.int64()))
        _, edges, letters = spelt.buffers()
        edges = np.frombuffer(edges, dtype=np.int32, count=len(ids) + 1) if len(ids) else np.zeros(1, dtype=np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(edges[stops].tobytes()), letters])
        order = np.concatenate([own for _, own in dealt])
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        at = place[unpack(row["numbers"])]  # by position
        own = lengths[at].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(own)])
        all_ids = ids[np.repeat(stops[at] - ends[:-1], own) + np.arange(ends[-1])].astype("<u4").tobytes()
        _, bounds, decoded = words.take(pa.array(at)).buffers()
        bounds = np.frombuffer(bounds, dtype=np.int32, count=len(at) + 1) if len(at) else np.zeros(1, dtype=np.int32)
        decoded = memoryview(decoded) if decoded else memoryview(b"")
        last = 0
        for doc_id, length in zip(row["doc_ids"], row["lengths"], strict=True):
            first, last = last, last + length
            text_ids = all_ids[4 * ends[first] : 4 * ends[last]]
            text = decoded[bounds[first] : max(bounds[first], bounds[last] - 1)]
            if digests:
                yield doc_id, len(text_ids) // 4, hashlib.sha256(text_ids).hexdigest(), hashlib.sha256(text).hexdigest()
            else:
                yield doc_id, len(text_ids) // 4, text_ids, bytes(text)

    def join(_: tuple, block: pa.Table, found: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(emit(schema, texts(block, found), 10_000)), schema=schema)

    left = blocks.select("block", "doc_ids", "lengths", "numbers", "words").groupBy("block")
    return left.cogroup(answers.groupBy("block")).applyInArrow(join, out)
