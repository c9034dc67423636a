"""Merkle manifest of a table of documents, with a proof for every row.

A row is a leaf: the SHA-256 of its fields, each ``-`` for null and otherwise its length in bytes, ``:`` and its value. The leaves of
a language, in ascending doc_id order, make a tree of runs of ``FAN``; the roots of these trees, by language, make the tree above
them. H is the lower-case hex SHA-256 of its inputs joined, digests as hex text.

Proofs come by pointer jumping. Every inner node holds the siblings to its left and right and a pointer to its parent. A round joins the
nodes with themselves on the pointer, appends the segment found there and takes over its pointer: the distance doubles, and
after log2(height) rounds every node holds its whole way to the root. Leaves then take the way of the run they lie in. There are an
eighth as many nodes as leaves, so the long segments are made and moved once per run. Rounds are written to the shared folder.

Ranks of leaves come from a range sort with counts per partition added up, so that no language meets in one task. A node that many pointers
meet at is one row on its side of the join, and Spark splits the other side.

Nulls: each column may be null; null languages are a language, ordered first; a null doc_id sorts first and is never tampered with. Rows of
equal doc_id go by the digest of the leaf, repeated rows one after another. Texts are hashed whole. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattmill.llm.common import same, saved
from wattmill.llm.interleave import numbered

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """SHA-256 of text, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*values), 256))


def as_hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaves(docs: DataFrame) -> DataFrame:
    """(lang, doc_id, leaf, changed): the leaf of each row, and its leaf once tampered with, where it is."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "source", "lang", "n_chars", "text")
    head = [field(F.col(c)) for c in FIELDS[:-1]]
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    lowered = F.translate("text", UPPER, LOWER)
    return rows.select(
        "lang",
        "doc_id",
        digest(*head, field(F.col("text"))).alias("leaf"),
        F.when(tampered, digest(*head, field(lowered))).alias("changed"),
    )


def ranked(rows: DataFrame, group: str, order: tuple[str, ...], name: str) -> DataFrame:
    """``rows`` with ``rank`` within ``group`` (from 0), the group's size ``n`` and the group's own place ``tree`` (from 1)."""
    placed = numbered(rows, (group, *order), name)
    counts = placed.groupBy(group, "part").agg(F.min("pos").alias("first"), F.count("*").alias("own"))
    by_group = Window.partitionBy(group)  # a row for each partition that holds the group
    before = F.coalesce(F.sum("own").over(by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = counts.select(group, "part", (before - F.col("first")).alias("shift"), F.sum("own").over(by_group).alias("n"))
    trees = numbered(counts.select(group).distinct(), (group,), f"{name}-groups")
    ends = trees.groupBy("part").agg(F.count("*").alias("own"))
    upto = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    ends = ends.select("part", F.coalesce(F.sum("own").over(upto), F.lit(0)).alias("before"))
    trees = trees.join(ends, "part").select(group, (F.col("before") + F.col("pos") + 1).alias("tree")).alias("t")
    s, p = shifts.alias("s"), placed.alias("p")
    sized = s.join(trees, same(F.col(f"s.{group}"), F.col(f"t.{group}"))).select("s.*", "t.tree").alias("s")
    joined = p.join(sized, (F.col("p.part") == F.col("s.part")) & same(F.col(f"p.{group}"), F.col(f"s.{group}")))
    return joined.select(*(f"p.{c}" for c in rows.columns), (F.col("p.pos") + F.col("s.shift")).alias("rank"), "s.n", "s.tree")


def runs_of(nodes: DataFrame, *held: str) -> DataFrame:
    """The next level: (tree, rank, n, digest, run) of every ``FAN`` nodes; ``run`` holds their digests and ``held`` in order."""
    # at most FAN members a group
    grouped = nodes.groupBy("tree", F.expr(f"rank div {FAN}").alias("up")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "digest", *held))).alias("run"), F.max("n").alias("n")
    )
    joined = digest(F.array_join(F.transform("run", lambda x: as_hex(x.digest)), ""))
    # a leaf that is alone in its tree is the root itself
    whole = F.when(F.col("n") == 1, F.col("run")[0]["digest"]).otherwise(joined)
    return grouped.select("tree", F.col("up").alias("rank"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), whole.alias("digest"), "run")


def beside(run: Column, at: Column) -> Column:
    """The digests to the left and to the right of the member at a place, each joined."""
    join = lambda part: F.unhex(F.array_join(F.transform(part, lambda x: F.hex(x.digest)), ""))
    return F.struct(join(F.filter(run, lambda x: x.rank < at)).alias("left"), join(F.filter(run, lambda x: x.rank > at)).alias("right"))


def levels_over(n: int) -> int:
    """How many levels lie above ``n`` nodes."""
    levels = 0
    while n > 1:
        n, levels = (n + FAN - 1) // FAN, levels + 1
    return levels


def union_of(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def climb(nodes: DataFrame, levels: int, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """Levels over ``nodes`` (tree, rank, n, digest): the roots (tree, digest), and all other nodes with pointer and siblings.

    Nodes are (tree, level, rank); ``nodes`` are level 1. ``up_level`` is null at a child of the root.
    """
    roots, inner = [], []
    for level in range(1, levels + 1):
        roots.append(nodes.where("n = 1").select("tree", "digest"))
        above = saved(runs_of(nodes.where("n > 1")), f"{name}-{level}")
        inner.append(
            above.select("tree", "rank", "n", F.explode("run").alias("own"), "run").select(
                "tree",
                F.lit(level).alias("level"),
                F.col("own.rank").alias("rank"),
                F.when(F.col("n") > 1, F.lit(level + 1)).alias("up_level"),
                F.when(F.col("n") > 1, F.col("rank")).alias("up_rank"),
                F.array(beside(F.col("run"), F.col("own.rank"))).alias("steps"),
            )
        )
        nodes = above.drop("run")
    return union_of([*roots, nodes.where("n = 1").select("tree", "digest")]), inner


STEPS = "array<struct<left:binary,right:binary>>"


def jumped(nodes: DataFrame, rounds: int) -> DataFrame:
    """Whole ways to the root by pointer jumping; ``up_tree`` is null where a way has reached it."""
    for k in range(rounds):
        n, u = nodes.where("up_tree IS NOT NULL").alias("n"), nodes.alias("u")
        parent = (F.col("n.up_tree") == F.col("u.tree")) & (F.col("n.up_level") == F.col("u.level")) & (F.col("n.up_rank") == F.col("u.rank"))
        steps = F.concat("n.steps", "u.steps").alias("steps")
        gone_on = n.join(u, parent).select("n.tree", "n.level", "n.rank", "u.up_tree", "u.up_level", "u.up_rank", steps)
        nodes = saved(gone_on.unionByName(nodes.where("up_tree IS NULL")), f"ways-{k}")
    return nodes


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, start, lambda own, step: digest(as_hex(step.left), as_hex(own), as_hex(step.right)))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, subroot, root, steps (siblings to the left and right of each level) and ``changed`` of every row, digests as bytes."""
    placed = ranked(saved(leaves(docs), "hashes"), "lang", ("doc_id", "leaf"), "leaves").withColumnRenamed("leaf", "digest")
    runs = saved(runs_of(placed, "lang", "doc_id", "changed"), "runs")
    widest = runs.agg(F.max("n")).first()[0] or 0
    height = levels_over(widest)
    subroots, inner = climb(runs.drop("run"), height, "level")
    subroots = saved(subroots, "subroots")
    # they are the lowest level of tree 0, in the order of their trees
    trees = subroots.count()
    number = (F.col("tree") - 1).alias("rank")
    top = subroots.select(F.lit(0).cast("bigint").alias("tree"), number, F.lit(trees).cast("bigint").alias("n"), "digest")
    root, over = climb(top, levels_over(trees), "top")
    to_top = F.col("up_level").isNull()
    above = F.lit(0) if over else F.lit(None)  # a single tree's root is the root
    inner = [
        part.select(
            "tree",
            "level",
            "rank",
            F.when(to_top, above).otherwise(F.col("tree")).cast("bigint").alias("up_tree"),
            F.when(to_top, F.lit(1)).otherwise(F.col("up_level")).alias("up_level"),
            F.when(to_top, number).otherwise(F.col("up_rank")).alias("up_rank"),
            "steps",
        )
        for part in inner
    ]
    over = [part.withColumn("up_tree", F.when(F.col("up_level").isNotNull(), F.col("tree"))) for part in over]
    s, r = subroots.alias("s"), runs.alias("r")
    # a run that is its tree's root is a node of tree 0
    is_root = F.col("r.n") == 1
    runs = r.join(s, F.col("r.tree") == F.col("s.tree")).select(
        "r.run",
        F.when(is_root, F.lit(0)).otherwise(F.col("r.tree")).alias("tree"),
        F.when(is_root, F.col("r.tree") - 1).otherwise(F.col("r.rank")).alias("rank"),
        (is_root & (F.size("r.run") == 1)).alias("alone"),
        F.col("s.digest").alias("subroot"),
        root.select("digest").scalar().alias("root"),
    )
    no_steps = F.expr(f"cast(array() as {STEPS})")
    if inner or over:
        nodes = saved(union_of([*inner, *over]), "nodes")
        distance = height + levels_over(trees)
        ways = jumped(nodes, (distance - 1).bit_length()).where("level = 1").alias("w")
        r = runs.alias("r")
        found = r.join(ways, (F.col("r.tree") == F.col("w.tree")) & (F.col("r.rank") == F.col("w.rank")), "left")
        runs = found.select("r.*", F.coalesce("w.steps", no_steps).alias("way"))
    else:
        runs = runs.withColumn("way", no_steps)
    own = runs.select(F.explode("run").alias("own"), "run", "alone", "subroot", "root", "way")
    first = F.when(F.col("alone"), no_steps).otherwise(F.array(beside(F.col("run"), F.col("own.rank"))))
    return own.select(
        F.col("own.doc_id").alias("doc_id"),
        F.col("own.lang").alias("lang"),
        F.col("own.digest").alias("leaf"),
        F.col("own.changed").alias("changed"),
        "subroot",
        "root",
        F.concat(first, "way").alias("steps"),
    )


def proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row, in hex."""
    found = manifest(docs)
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(as_hex(s.left), as_hex(s.right))), "")
    checked = found.withColumn("folded", folded(F.coalesce("changed", "leaf"), F.col("steps")))
    return checked.select(
        "doc_id",
        as_hex(F.col("leaf")).alias("leaf"),
        as_hex(F.col("subroot")).alias("subroot"),
        as_hex(F.col("root")).alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"),
        as_hex(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
