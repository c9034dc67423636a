"""Prefix trie of conversations, packed as double arrays.

A conversation is its turns in order; a node is a distinct sequence of first turns. Turns are known by the MD5 of role and text,
nodes by the MD5 of their turns' digests, so that texts are read once and do not travel.

Equal conversations become one row with a count. The rows are dealt to *prefix shards*: a group of rows with the same first turn
goes to one shard; a group of more than ``per_shard`` turns is divided by its first two turns, then four, and so on. In a shard,
turns get dense ids in order of their first place in the trie, and the nodes are packed into BASE and CHECK: child ``c`` of
node ``s`` is slot ``BASE[s] + c`` if ``CHECK`` of that slot is ``s``. Every row is walked through the arrays and adds to
the nodes that it meets. Shards are rows of a table in the shared folder; ``Trie.walk`` finds nodes in them.

Nodes above the depth that a shard was divided by are *upper* nodes and may lie in many shards. Their counts are added up over all shards;
one shard, the owner, then counts each of them as child, as leaf and with its tokens, so that the sums over subtrees, made
bottom-up in each shard, add up as well.

The ids that end at a node are sorted over all partitions, joined to texts of bounded size there, and hashed text after text, as SHA-256
is a chain; only these texts of one node meet in one task, which reads them as a stream.

A conversation counts as one document: its turns (20 bytes each, no texts) meet in one task. Nulls: rows without conv_id belong to no conversation
and are left out; null turns come first; null roles and texts are empty. Turns of equal number go by their digest, repeated rows are
turns of their own. Remainders of negative ids are those of SQL. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.llm.common import arrow_schema, emit, saved, struct
from wattmill.llm.merkle import union_of

PER_SHARD = 1 << 16
# free slots that are tried for the children of a node before they go behind all others
TRIES = 32
CHUNK_BYTES = 1 << 20
WIDTH = 16

SHARDS = struct(
    bucket="long", base="binary", check="binary", turns="binary", slots="binary", keys="binary", depth="binary", words="binary",
    n="binary", first="binary", upper="binary",
)
PARTIAL = struct(bucket="long", key="binary", n="long", first="long", has_child="bool")
NODES = struct(
    key="binary", upper="bool", conv_id="long", depth="long", parent_conv_id="long", n_convs="long", n_children="long", n_leaves="long",
    saved_tokens="long",
)
CHUNKS = struct(key="binary", first="long", ids="binary")
ENDS = struct(key="binary", ends_sha256="string")


def md5_of(value: Column) -> Column:
    return F.unhex(F.md5(value))


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, own): the turns of each conversation in order, as digests and word counts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        md5_of(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
    )
    rows = conversations.select(F.col("conv_id").cast("bigint"), turn.alias("turn")).where("conv_id IS NOT NULL")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("own"))


def with_shared_heads(conversations: DataFrame, every: int = 20, longest: int = 4) -> DataFrame:
    """Conversations whose first h turns are those of the conversation ``every`` divides, h being crc32(conv_id) % ``longest``."""
    heads = conversations.where(f"conv_id % {every} = 0").select(F.col("conv_id").alias("head_id"), F.slice("own", 1, longest - 1).alias("head"))
    c = conversations.withColumns(
        {"head_id": F.expr(f"conv_id - conv_id % {every}"), "h": (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % longest).cast("int")}
    )
    joined = c.join(heads, "head_id", "left")
    none = F.slice("own", 1, 0)
    shared = F.coalesce(F.slice("head", F.lit(1), F.col("h")), none)
    rest = F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(shared, rest).alias("own"))


def packed(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, turns, words): the digests of all turns in one value, and the key of the node where the conversation ends."""
    turns = F.unhex(F.array_join(F.transform("own", lambda x: F.hex(x.digest)), ""))
    rows = conversations.select("conv_id", turns.alias("turns"), F.transform("own", lambda x: x.words).alias("words"))
    return rows.select("conv_id", md5_of(F.col("turns")).alias("key"), "turns", "words")


def distinct_sequences(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first"), F.first("turns").alias("turns"), F.first("words").alias("words")
    )


def sharded(sequences: DataFrame, per_shard: int, least: int) -> DataFrame:
    """Adds ``bucket`` and ``cut``: all rows with the same first ``cut`` turns are in one bucket."""
    length = F.size("words")
    total = sequences.agg(F.sum(length + 1)).first()[0] or 0
    buckets = max(least, 2 * total // per_shard + 1)
    rest, done, depth = sequences, [], 1
    while True:
        rest = rest.withColumn("at", md5_of(F.substring("turns", 1, WIDTH * depth)))
        # a shorter conversation is a group of its own, and all its nodes may have other children elsewhere
        cut = F.least(F.lit(depth), length + 1)
        sized = rest.groupBy("at").agg(F.sum(length + 1).alias("size"), F.count("*").alias("n"))
        heavy = saved(sized.where((F.col("size") > per_shard) & (F.col("n") > 1)).select("at"), "heavy")
        last = heavy.isEmpty()
        done.append((rest if last else rest.join(heavy, "at", "left_anti")).withColumn("cut", cut))
        if last:
            break
        rest = saved(rest.join(heavy, "at", "left_semi").drop("at"), "divided")
        depth *= 2
    return union_of(done).withColumn("bucket", F.pmod(F.xxhash64("at"), F.lit(buckets))).drop("at")


class Trie:
    """BASE and CHECK over slots; slot 0 is the root."""

    def __init__(self, base: np.ndarray, check: np.ndarray):
        self.base, self.check = base, check

    def step(self, state: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The child of each node by each id, -1 where there is none."""
        at = self.base[state] + ids
        inside = (at > 0) & (at < len(self.check))
        return np.where(inside & (self.check[np.where(inside, at, 0)] == state), at, -1)

    def walk(self, ids: list[int]) -> int:
        state = np.zeros(1, dtype=np.int64)
        for i in ids:
            state = self.step(state, np.array([i]))
            if state[0] < 0:
                return -1
        return int(state[0])


class Packer:
    """Finds slots for the children of one node after another."""

    def __init__(self, size: int):
        self.used = np.zeros(size + 1, dtype=bool)
        self.used[0] = True
        self.free, self.end = 1, 1

    def _next(self, at: int) -> int:
        while at < self.end and self.used[at]:
            at += 1
        return at

    def place(self, ids: np.ndarray) -> int:
        """BASE of a node with children ``ids`` (ascending)."""
        apart = ids - ids[0]
        self.free = at = self._next(self.free)
        for _ in range(TRIES):
            spots = at + apart
            if not self.used[spots[spots < self.end]].any():
                break
            at = self._next(at + 1)
        else:
            spots = self.end + apart
        self.end = max(self.end, int(spots[-1]) + 1)
        if self.end > len(self.used):
            self.used = np.concatenate([self.used, np.zeros(self.end, dtype=bool)])
        self.used[spots] = True
        return int(spots[0] - ids[0])


def nodes_of(turns: list[bytes], words: list) -> tuple[list, list, list, list, list]:
    """Parent, turn, depth, words and key of every node, for sequences in ascending order; node 0 is the root."""
    root = hashlib.md5()
    parent, turn, depth, counts, keys = [-1], [b"\0" * WIDTH], [0], [0], [root.digest()]
    path, before = [(0, root)], b""
    for sequence, own in zip(turns, words, strict=True):
        most = min(len(before), len(sequence)) // WIDTH
        ours, last = np.frombuffer(sequence, "S16")[:most], np.frombuffer(before, "S16")[:most]
        differ = np.flatnonzero(ours != last)
        common = int(differ[0]) if len(differ) else most
        del path[common + 1 :]
        for d in range(common, len(sequence) // WIDTH):
            up, state = path[-1]
            digest = sequence[d * WIDTH : (d + 1) * WIDTH]
            state = state.copy()
            state.update(digest)
            path.append((len(parent), state))
            parent.append(up)
            turn.append(digest)
            depth.append(d + 1)
            counts.append(own[d])
            keys.append(state.digest())
        before = sequence
    return parent, turn, depth, counts, keys


def build(bucket: int, turns: list[bytes], words: list, copies: np.ndarray, firsts: np.ndarray, cuts: np.ndarray) -> tuple:
    """One shard's row. The sequences come in ascending order and are distinct."""
    parent, turn, depth, counts, keys = nodes_of(turns, words)
    parent, depth = np.array(parent), np.array(depth)
    digests = np.array(turn, dtype="S16")
    by_level = np.lexsort((np.arange(len(parent)), parent, depth))[1:]
    # ids by first place, level by level, so that siblings mostly have ids in a row
    found, at, number = np.unique(digests[by_level], return_index=True, return_inverse=True)
    order = np.argsort(at, kind="stable")
    dense = np.empty(len(found), dtype=np.int64)
    dense[order] = np.arange(1, len(found) + 1)
    label = np.zeros(len(parent), dtype=np.int64)
    label[by_level] = dense[number]
    slot = np.zeros(len(parent), dtype=np.int64)
    packer = Packer(len(parent))
    bases = {}
    starts = np.flatnonzero(np.diff(parent[by_level], prepend=-2))
    for children in np.split(by_level, starts[1:]) if len(by_level) else ():
        ids = label[children]
        ascending = np.argsort(ids)
        base = packer.place(ids[ascending])
        bases[int(parent[children[0]])] = base
        slot[children] = base + ids
    base = np.zeros(packer.end, dtype=np.int32)
    check = np.full(packer.end, -1, dtype=np.int32)
    for node, value in bases.items():
        base[slot[node]] = value
    check[slot[1:]] = slot[parent[1:]]
    trie = Trie(base, check)

    n = np.zeros(packer.end, dtype=np.int64)
    first = np.full(packer.end, np.iinfo(np.int64).max)
    upper = np.zeros(packer.end, dtype=bool)
    lengths = np.array([len(t) // WIDTH for t in turns])
    id_of = dict(zip(found.tolist(), dense.tolist(), strict=True))
    ids = np.array([id_of[x] for x in np.frombuffer(b"".join(turns), "S16").tolist()], dtype=np.int64)
    offsets = np.cumsum(lengths) - lengths
    rows, state = np.arange(len(turns)), np.zeros(len(turns), dtype=np.int64)
    d = 0
    while len(rows):
        np.add.at(n, state, copies[rows])
        np.minimum.at(first, state, firsts[rows])
        upper[state[cuts[rows] > d]] = True
        longer = lengths[rows] > d
        rows, state = rows[longer], state[longer]
        state = trie.step(state, ids[offsets[rows] + d])
        d += 1
    in_order = found[order]
    columns = (depth.astype(np.int32), np.array(counts, dtype=np.int32), n[slot], first[slot], upper[slot])
    return (bucket, base.tobytes(), check.tobytes(), in_order.tobytes(), slot.astype(np.int32).tobytes(), b"".join(keys), *(c.tobytes() for c in columns))


def shards(sequences: DataFrame) -> DataFrame:
    """The table of packed shards."""
    schema = arrow_schema(SHARDS)

    def pack(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("turns", "words", "n", "first", "cut", "bucket")), strict=True), key=lambda r: r[0])
        turns, words, *numbers = zip(*rows, strict=True)
        copies, firsts, cuts, buckets = (np.array(x, dtype=np.int64) for x in numbers)
        return pa.Table.from_batches(emit(schema, [build(int(buckets[0]), turns, words, copies, firsts, cuts)]), schema=schema)

    return saved(sequences.select("bucket", "turns", "words", "n", "first", "cut").groupBy("bucket").applyInArrow(pack, SHARDS), "shards")


class Shard:
    """A packed shard read back: per-node arrays in the order of ``slots``."""

    def __init__(self, row: dict):
        load = lambda name, kind: np.frombuffer(row[name], dtype=kind)
        self.trie = Trie(load("base", np.int32), load("check", np.int32))
        self.slots, self.depth, self.words = load("slots", np.int32), load("depth", np.int32), load("words", np.int32)
        self.n, self.first, self.upper = load("n", np.int64).copy(), load("first", np.int64).copy(), load("upper", bool)
        self.keys = [row["keys"][i : i + WIDTH] for i in range(0, len(row["keys"]), WIDTH)]
        self.ids = {row["turns"][i * WIDTH : (i + 1) * WIDTH]: i + 1 for i in range(len(row["turns"]) // WIDTH)}
        node_at = np.full(len(self.trie.check), -1)
        node_at[self.slots] = np.arange(len(self.slots))
        above = self.trie.check[self.slots]
        self.parent = np.where(above < 0, -1, node_at[above])

    def has_child(self) -> np.ndarray:
        has = np.zeros(len(self.slots), dtype=bool)
        has[self.parent[1:]] = True
        return has

    def find(self, turns: list[bytes]) -> bytes | None:
        """The key of the node that a sequence of turn digests leads to."""
        if not all(t in self.ids for t in turns):
            return None
        slot = self.trie.walk([self.ids[t] for t in turns])
        return None if slot < 0 else self.keys[int(np.flatnonzero(self.slots == slot)[0])]


def upper_parts(packed_shards: DataFrame) -> DataFrame:
    """What each shard knows of its upper nodes."""
    schema = arrow_schema(PARTIAL)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                shard = Shard(row)
                has = shard.has_child()
                for x in np.flatnonzero(shard.upper).tolist():
                    yield row["bucket"], shard.keys[x], int(shard.n[x]), int(shard.first[x]), bool(has[x])

    return packed_shards.mapInArrow(lambda batches: emit(schema, rows(batches), 20_000), PARTIAL)


def owned_upper_nodes(parts: DataFrame) -> DataFrame:
    """Counts of the upper nodes over all shards, back at every shard that has them; ``owned`` at one of them."""
    whole = parts.groupBy("key").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("has_child").alias("has_child"), F.min("bucket").alias("owner")
    )
    return parts.select("bucket", "key").join(whole, "key").withColumn("owned", F.col("bucket") == F.col("owner")).drop("owner")


def node_rows(packed_shards: DataFrame, upper: DataFrame) -> DataFrame:
    """Nodes of every shard with sums over their subtrees; upper nodes with the shard's part of the sums."""
    schema = arrow_schema(NODES)

    def finish(shard_table: pa.Table, known: pa.Table) -> pa.Table:
        shard = Shard(shard_table.to_pylist()[0])
        size = len(shard.slots)
        leaf = ~shard.has_child()
        counts = np.ones(size, dtype=bool)
        at = {shard.keys[x]: x for x in np.flatnonzero(shard.upper).tolist()}
        for r in known.to_pylist():
            x = at[r["key"]]
            shard.n[x], shard.first[x], leaf[x], counts[x] = r["n"], r["first"], not r["has_child"], r["owned"]
        leaves = (leaf & counts).astype(np.int64)
        tokens = np.where(counts, (shard.n - 1) * shard.words, 0)
        children = np.zeros(size, dtype=np.int64)
        np.add.at(children, shard.parent[1:], counts[1:].astype(np.int64))
        deepest_first = np.argsort(-shard.depth, kind="stable")
        ends = np.flatnonzero(np.diff(shard.depth[deepest_first], append=-1))
        begin = 0
        for end in ends.tolist():
            level = deepest_first[begin : end + 1]
            begin = end + 1
            level = level[shard.parent[level] >= 0]
            np.add.at(leaves, shard.parent[level], leaves[level])
            np.add.at(tokens, shard.parent[level], tokens[level])
        above = pa.array(np.where(shard.parent >= 0, shard.first[shard.parent], 0), mask=shard.parent < 0)
        columns = [
            pa.array(shard.keys, pa.binary()), pa.array(shard.upper), pa.array(shard.first), pa.array(shard.depth.astype(np.int64)), above,
            pa.array(shard.n), pa.array(children), pa.array(leaves), pa.array(tokens.astype(np.int64)),
        ]
        return pa.Table.from_arrays(columns, schema=schema)

    return packed_shards.groupBy("bucket").cogroup(upper.groupBy("bucket")).applyInArrow(finish, NODES)


def ends_of(members: DataFrame) -> DataFrame:
    """(key, ends_sha256) of every node at which conversations (key, conv_id) end."""
    chunk_schema, end_schema = arrow_schema(CHUNKS), arrow_schema(ENDS)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, ids, size = None, [], 0
        for batch in batches:
            for own, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (own != key or size >= CHUNK_BYTES):
                    yield key, ids[0], ",".join(map(str, ids)).encode()
                    ids, size = [], 0
                key = own
                ids.append(conv_id)
                size += 8
        if ids:
            yield key, ids[0], ",".join(map(str, ids)).encode()

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, state = None, None
        for batch in batches:
            for own, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != key:
                    if state:
                        yield key, state.hexdigest()
                    key, state = own, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
        if state:
            yield key, state.hexdigest()

    ordered = members.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = ordered.mapInArrow(lambda batches: emit(chunk_schema, join(batches), 20_000), CHUNKS)
    streams = chunks.repartition("key").sortWithinPartitions("key", "first").select("key", "ids")
    return streams.mapInArrow(lambda batches: emit(end_schema, chain(batches), 20_000), ENDS)


def prefix_trie(conversations: DataFrame, per_shard: int = PER_SHARD) -> tuple[DataFrame, DataFrame]:
    """The nodes of (conv_id, own) conversations, and the table of packed shards."""
    spark = conversations.sparkSession
    rows = saved(packed(conversations), "sequences")
    sequences = saved(distinct_sequences(rows), "distinct")
    packed_shards = shards(sharded(sequences, per_shard, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    upper = saved(owned_upper_nodes(saved(upper_parts(packed_shards), "upper-parts")), "upper")
    found = saved(node_rows(packed_shards, upper), "trie-nodes")
    same_for_all = [F.min(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs")]
    added_up = [F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    merged = found.where("upper").groupBy("key").agg(*same_for_all, *added_up)
    nodes = found.where("NOT upper").drop("upper").unionByName(merged)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    nodes = nodes.join(ends_of(rows), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    return nodes, packed_shards


def shared_prefixes(conversations: DataFrame, per_shard: int = PER_SHARD) -> DataFrame:
    """Nodes of the conversations rebuilt with shared heads."""
    own = saved(turns_of(conversations), "turns")
    nodes, _ = prefix_trie(with_shared_heads(own), per_shard)
    return nodes.drop("key")
