import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import types as T

from wattmill.llm import oracle
from wattmill.llm import prefix_trie as pt

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(turn):
    role, text = turn
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def own_turns(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            pair = (role or "", text or "")
            own[conv_id].append(((turn is not None, turn or 0), digest(pair), pair))
    return {c: [pair for *_, pair in sorted(turns)] for c, turns in own.items()}


def brute_force(rows):
    own = own_turns(rows)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in sorted(rebuilt.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
        ends[turns].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, tokens = defaultdict(int), defaultdict(int)
    for node, own_members in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            tokens[node[:d]] += (len(own_members) - 1) * words
            leaves[node[:d]] += not children[node]
    return sorted(
        (
            (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], tokens[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
            for node, m in members.items()
        ),
        key=str,
    )


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def frame_of(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_sample_equals_brute_force_and_sql(spark):
    df = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    got = found(pt.shared_prefixes(df))
    assert got == brute_force([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_DIR}/conversations.parquet'")
    assert sorted(con.execute(oracle.OP11).fetchall(), key=str) == got


def drawn(seed, n):
    """Conversations over few turns, many of them equal or with long shared heads."""
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        length = draw.choice([0, 1, 2, 3, 5, 9])
        head = ["a"] * draw.choice([0, 1, 6]) + [draw.choice("ab c") for _ in range(length)]
        rows += [(c, i, draw.choice(["user", "user", None]), t) for i, t in enumerate(head)]
    return rows


@pytest.mark.parametrize("per_shard", [1, 6, 40, 10_000])
def test_divided_groups_add_up(frame_of, per_shard):
    rows = drawn(per_shard, 150)
    assert found(pt.shared_prefixes(frame_of(rows), per_shard)) == brute_force(rows)


def test_odd_rows(frame_of):
    rows = [(None, 1, "user", "x"), (20, None, None, None), (20, 3, "user", "b c"), (20, 3, "user", "b c"), (20, 3, "user", "a"), (21, 0, "user", ""), (22, 0, "", None), (7, 0, "user", "w " * 50_000), (41, 2, "user", "q")]
    df = frame_of(rows).selectExpr("*", "1 AS key", "2 AS n", "3 AS own", "4 AS upper", "5 AS head_id")
    assert found(pt.shared_prefixes(df)) == brute_force(rows)


def test_empty_table(frame_of):
    assert pt.shared_prefixes(frame_of([])).collect() == []
    assert pt.shared_prefixes(frame_of([(None, 1, "user", "x")])).collect() == []


def test_a_conversation_that_is_rebuilt_without_turns(frame_of):
    c = next(c for c in range(100, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    assert found(pt.shared_prefixes(frame_of(rows))) == brute_force(rows)
    assert len(brute_force(rows)) == 1


def test_shards_find_every_sequence_and_no_other(spark, frame_of):
    rows = drawn(3, 80)
    own = pt.turns_of(frame_of(rows))
    nodes, shards = pt.prefix_trie(own, per_shard=30)
    keys = {bytes(r.key) for r in nodes.collect()}
    tries = [pt.Shard(r.asDict()) for r in shards.collect()]
    sequences = {tuple(map(digest, turns)) for turns in own_turns(rows).values()}
    prefixes = {s[:d] for s in sequences for d in range(len(s) + 1)}
    for p in prefixes:
        key = hashlib.md5(b"".join(p)).digest()
        assert key in keys and any(t.find(p) == key for t in tries)
    wrong = [p + (digest(("user", "none")),) for p in prefixes] + [p + p[-1:] for p in prefixes if p and p + p[-1:] not in prefixes]
    assert all(t.find(p) is None for p in wrong for t in tries)
    # slots are packed: few stay free
    assert all((t.trie.check[1:] >= 0).mean() > 0.5 for t in tries if len(t.slots) > 1)


def test_packing_of_wide_and_narrow_nodes():
    draw = np.random.default_rng(5)
    packer, taken = pt.Packer(10), set()
    for _ in range(300):
        ids = np.unique(draw.integers(1, 500, size=draw.integers(1, 12)))
        spots = packer.place(ids) + ids
        assert spots.min() > 0 and not taken & set(spots.tolist())
        taken |= set(spots.tolist())


def test_ids_of_a_large_group_are_hashed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK_BYTES", 64)
    members = spark.range(-50, 1000).selectExpr("unhex(md5(if(id % 3 = 0, 'a', 'b'))) AS key", "id AS conv_id").repartition(5)
    got = {bytes(r.key): r.ends_sha256 for r in pt.ends_of(members).collect()}
    ids = {k: [i for i in range(-50, 1000) if (i % 3 == 0) == (k == "a")] for k in "ab"}
    assert got == {hashlib.md5(k.encode()).digest(): hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in ids.items()}
