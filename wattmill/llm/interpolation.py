"""Language-model scoring by deleted interpolation.

A text is its words (ASCII upper case lowered, split at ASCII white space) and one end. The model mixes maximum-likelihood
estimates of order two, one and zero,

    P(w | v) = a(b) c(v w) / c(v) + u(b) c(w) / N + z(b) / (V + 1),

where v is the token before (the end of the text before, for the first word) and b the bucket of its frequency, the power of two
at or below c(v). The weights of each bucket add up to 1 and are learned by expectation-maximisation: a tenth of the training
documents is deleted from the counts, and the weights that make it most likely under the other counts are kept; the final
counts are those of all training documents. Rounds end when the log-likelihood per token gains less than ``tolerance``.

Documents train if crc32(doc_id as text) mod 10 is not 0, and those with remainder 1 are the deleted tenth. Every document is scored.

Words and word pairs are counted per block, dealt by hash, added up where they meet and sent back to their blocks as plain
arrays; scores are sums within a block. So the busiest word or pair is one entry per block. Pairs are known by 64-bit hashes;
words are compared in full. Order two is what the disk budget of the check tool leaves room for; pairs of pairs would double it.

Nulls: a null text is empty (one end); a null doc_id has remainder 0. Repeated rows are documents of their own. If no document
trains, base score and score are null. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattmill.llm.common import arrow_schema, emit, saved, struct
from wattmill.llm.word_blocks import DEALT, pack, parts_for, places, press, text_blocks, unpack, words_in

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
END = b"\n"  # no word holds white space
BUCKETS = 64
COUNTED = struct(part="int", block="long", kind="int", payload="binary", n_new="long", n_all="long", n_kept="long")
TRIPLES = struct(payload="binary")
SCORES = struct(doc_id="long", held_out="bool", n_tokens="long", n_known="long", train_tokens="long", base_score="double", score="double")


def remainder(doc_id: int | None) -> int:
    return zlib.crc32(str(doc_id).encode()) % 10 if doc_id is not None else 0


class Block:
    """A block of texts with an end after each; the end has the last number of the list of words."""

    def __init__(self, row: dict):
        self.words = [*words_in(row["words"]), END]
        self.doc_ids = row["doc_ids"]
        self.lengths = np.array(row["lengths"], dtype=np.int64)
        self.kinds = np.array([remainder(d) for d in self.doc_ids], dtype=np.int8)
        self.ends = np.cumsum(self.lengths + 1)  # where the next text begins
        end = len(self.words) - 1
        self.tokens = np.full(self.ends[-1], end, dtype=np.int64)
        inner = np.ones(len(self.tokens), dtype=bool)
        inner[self.ends - 1] = False
        self.tokens[inner] = unpack(row["numbers"])
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[self.ends - self.lengths - 1] = end
        self.kind_at = np.repeat(self.kinds, self.lengths + 1)

    def word_counts(self, where: np.ndarray) -> np.ndarray:
        return np.bincount(self.tokens[where], minlength=len(self.words)).astype(np.uint32)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of the distinct pairs, the pair at each position, and both words of each pair."""
        codes, at = np.unique(self.before * len(self.words) + self.tokens, return_inverse=True)
        first, second = np.divmod(codes, len(self.words))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), dtype=np.uint64, count=len(self.words))
        keys = pair_keys(hashes[first], hashes[second])
        order = np.argsort(keys)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return keys[order], place[at], first[order], second[order]


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    key = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    key ^= key >> np.uint64(32)
    return key * np.uint64(0xFF51AFD7ED558CCD)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def framed(*payloads: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in payloads)


def unframed(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return out


def ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of the 64-bit keys begins and ends in sorted keys."""
    limits = np.array([(i << 64) // parts for i in range(1, parts)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, limits), [len(keys)]])


def deal_counts(blocks: DataFrame, parts: int, pairs: bool) -> DataFrame:
    """Counts of each block's words or pairs in all training documents and in those that stay when a tenth is deleted."""
    schema = arrow_schema(DEALT)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row in rows_of(batch):
                b = Block(row)
                train, kept = b.kind_at > 0, b.kind_at > 1
                if pairs:
                    keys, at, _, _ = b.pairs()
                    counts = [np.bincount(at[w], minlength=len(keys)).astype(np.uint32) for w in (train, kept)]
                    edges = ranges(keys, parts)
                    for part in range(parts):
                        own = slice(edges[part], edges[part + 1])
                        if edges[part + 1] > edges[part]:
                            steps = np.diff(keys[own], prepend=np.uint64(0))
                            yield part, row["block"], framed(pack(steps), *(pack(c[own]) for c in counts))
                else:
                    counts = [b.word_counts(w) for w in (train, kept)]
                    for part, own in places(b.words, parts):
                        # words are joined by a space, so that the end keeps its newline
                        yield part, row["block"], framed(press(b" ".join([b.words[i] for i in own.tolist()])), *(pack(c[own]) for c in counts))

    return blocks.mapInArrow(lambda batches: emit(schema, rows(batches), 500, 8 << 20), DEALT)


def add_up(dealt: DataFrame, pairs: bool) -> DataFrame:
    """The total counts, for each block in its own order; one row of a partition also tells its sums and number of trained words."""
    schema = arrow_schema(COUNTED)

    def total(_: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, np.ndarray]] = []  # part, block, number of each of the block's entries
        known: dict[bytes, int] = {}
        keys: list[np.ndarray] = []
        given: list[list[np.ndarray]] = [[], []]
        for batch in batches:
            for part, block, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "payload")), strict=True):
                names, *counts = unframed(payload)
                if pairs:
                    own = np.cumsum(unpack(names))
                    keys.append(own)
                else:
                    words = words_in(names)
                    own = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
                held.append((part, block, own))
                for k in (0, 1):
                    given[k].append(unpack(counts[k]))
        if pairs:
            distinct = np.unique(np.concatenate(keys))
            numbers = [np.searchsorted(distinct, own) for own in keys]
        else:
            distinct, numbers = known, [own for *_, own in held]
        sums = [np.zeros(len(distinct), dtype=np.int64) for _ in range(2)]
        for k in (0, 1):
            for own, counts in zip(numbers, given[k], strict=True):
                sums[k][own] += counts  # a block has an entry once
        facts = (int((sums[0] > 0).sum()), int(sums[0].sum()), int(sums[1].sum()))

        def rows() -> Iterator[tuple]:
            for i, ((part, block, _), own) in enumerate(zip(held, numbers, strict=True)):
                kind = np.uint32 if max(s.max() for s in sums) < 1 << 32 else np.uint64
                yield part, block, int(pairs), framed(*(pack(s[own].astype(kind)) for s in sums)), *(facts if i == 0 else (0, 0, 0))

        return emit(schema, rows(), 500, 8 << 20)

    return dealt.groupBy("part").applyInArrow(total, COUNTED)


def answers(found: pa.Table, kind: int) -> list[np.ndarray]:
    """Corpus counts of a block's words or pairs, partition after partition: of all training documents, and without the deleted tenth."""
    rows = sorted((r["part"], r["payload"]) for r in found.select(["kind", "part", "payload"]).to_pylist() if r["kind"] == kind)
    both = [unframed(payload) for _, payload in rows]
    return [np.concatenate([unpack(x[k]) for x in both]).astype(np.int64) for k in (0, 1)]


def dealt_order(words: list[bytes], parts: int) -> np.ndarray:
    """Numbers of a block's words in the order of ``answers``."""
    return np.concatenate([own for _, own in places(words, parts)])


def bucket_of(counts: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + the power of two at or below its count."""
    return np.frexp(counts.astype(np.float64))[1]


def deleted_pairs(blocks: DataFrame, parts: int) -> DataFrame:
    """Pairs of the deleted documents: for each its place among the block's pairs, the places of its words, and how often it occurs."""
    schema = arrow_schema(DEALT)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row in rows_of(batch):
                b = Block(row)
                if (b.kinds == 1).any():
                    keys, at, first, second = b.pairs()
                    held = np.bincount(at[b.kind_at == 1], minlength=len(keys))
                    some = np.flatnonzero(held)
                    order = dealt_order(b.words, parts)
                    place = np.empty(len(order), dtype=np.uint32)
                    place[order] = np.arange(len(order), dtype=np.uint32)
                    arrays = (some, place[first[some]], place[second[some]], held[some])
                    yield 0, row["block"], framed(*(pack(x.astype(np.uint32)) for x in arrays))

    return blocks.mapInArrow(lambda batches: emit(schema, rows(batches), 1), DEALT)


def likelihood_terms(blocks: DataFrame, counted: DataFrame, parts: int) -> DataFrame:
    """What the likelihood of the deleted documents needs, block by block: counts of pair, context and word, and how often they occur."""

    def gather(_: tuple, held: pa.Table, found: pa.Table) -> pa.Table:
        out: list[bytes] = []
        if held.num_rows:
            some, first, second, times = (unpack(p) for p in unframed(held.column("payload")[0].as_py()))
            word, pair = answers(found, 0)[1], answers(found, 1)[1]
            terms = np.stack([pair[some], word[first], word[second]], axis=1)
            distinct, back = np.unique(terms, axis=0, return_inverse=True)
            weight = np.bincount(back.ravel(), weights=times)
            out.append(framed(*(pack(x.astype(np.uint64)) for x in (*distinct.T, weight))))
        return pa.table({"payload": pa.array(out, pa.binary())})

    return deleted_pairs(blocks, parts).groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(gather, TRIPLES)


def learn(terms: DataFrame, n: int, v: int, rounds: int = 50, tolerance: float = 1e-4) -> np.ndarray:
    """Weights (bucket x order) by expectation-maximisation; each round adds up 64 x 4 numbers over all terms."""
    weights = np.tile(np.array([0.4, 0.4, 0.2]), (BUCKETS, 1))
    weights[0] = [0.0, 0.7, 0.3]
    sums = struct(bucket="int", a="double", u="double", z="double", log="double")
    schema = arrow_schema(sums)
    last = -math.inf
    for _ in range(rounds):
        now = weights.copy()

        def expect(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            out = np.zeros((BUCKETS, 4))
            for batch in batches:
                for payload in batch.column(0).to_pylist():
                    pair, context, word, times = (unpack(p).astype(np.float64) for p in unframed(payload))
                    b = bucket_of(context)
                    parts = now[b] * np.stack([pair / np.maximum(context, 1), word / n, np.full(len(word), 1 / (v + 1))], axis=1)
                    total = parts.sum(axis=1)
                    for k in range(3):
                        out[:, k] += np.bincount(b, weights=times * parts[:, k] / total, minlength=BUCKETS)
                    out[:, 3] += np.bincount(b, weights=times * np.log(total), minlength=BUCKETS)
            used = np.flatnonzero(out.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(out[used, k]) for k in range(4))], schema=schema)

        found = terms.mapInArrow(expect, sums).groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("a", "u", "z", "log"))).collect()
        mass = sum(r.a + r.u + r.z for r in found)
        if not mass:
            break
        for r in found:
            # half a token for each order keeps every weight above zero
            smooth = np.array([r.a, r.u, r.z]) + (np.array([0.0, 0.5, 0.5]) if r.bucket == 0 else 0.5)
            weights[r.bucket] = smooth / smooth.sum()
        gain, last = sum(r.log for r in found) / mass - last, sum(r.log for r in found) / mass
        if gain < tolerance:
            break
    return weights


def scores(docs: DataFrame) -> DataFrame:
    """Token counts, the add-a-tenth unigram score and the model's score (log10) of every document."""
    parts = parts_for(docs)
    blocks = text_blocks(docs, lambda text: text.translate(LOWER))
    counted = saved(add_up(deal_counts(blocks, parts, False), False).unionByName(add_up(deal_counts(blocks, parts, True), True)), "counts")
    facts = counted.where("kind = 0").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_new", "n_all", "n_kept"))).first()
    v, n, n_kept = facts.n_new, facts.n_all, facts.n_kept
    terms = saved(likelihood_terms(blocks, counted, parts), "terms")
    weights = learn(terms, max(n_kept, 1), v)
    schema = arrow_schema(SCORES)

    def score(_: tuple, block: pa.Table, found: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if block.num_rows:
            b = Block(block.to_pylist()[0])
            _, at, first, second = b.pairs()
            count = np.zeros(len(b.words), dtype=np.int64)
            count[dealt_order(b.words, parts)] = answers(found, 0)[0]
            pair = answers(found, 1)[0]
            word, context = count.astype(np.float64), count[first].astype(np.float64)
            starts = b.ends - b.lengths - 1
            known = np.add.reduceat((count > 0)[b.tokens].astype(np.int64), starts)
            if n:
                mix = weights[bucket_of(context)]
                chance = mix[:, 0] * pair / np.maximum(context, 1) + mix[:, 1] * word[second] / n + mix[:, 2] / (v + 1)
                model = np.add.reduceat(np.log10(chance)[at], starts).tolist()
                base = np.add.reduceat(np.log10((word + 0.1) / (n + 0.1 * (v + 1)))[b.tokens], starts).tolist()
            else:
                model = base = [None] * len(starts)
            tokens = (b.lengths + 1).tolist()
            rows = list(zip(b.doc_ids, (b.kinds == 0).tolist(), tokens, known.tolist(), [n] * len(tokens), base, model, strict=True))
        return pa.Table.from_batches(list(emit(schema, rows, 10_000)), schema=schema)

    return blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(score, SCORES)
