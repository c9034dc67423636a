"""Similarity join of texts on sets of word n-grams (Jaccard >= 0.8) by chosen paths, and classes of linked texts.

**Sets.** Words are ASCII-lower-cased and split at ASCII white space; a text's set holds the 64-bit hashes of its runs of ``WIDTH`` words
(one shorter run if it has fewer). Texts with equal sets are one *representative*; only representatives are joined.

**Sketch.** A representative is embedded as ``TOKENS`` MinHash values, each a sampled token of its set that two sets share with probability equal to
their Jaccard similarity.

**Chosen paths.** A run draws a few token positions at the root; sets that agree on a drawn token go to the same child. A child of
at most ``SMALL`` sets is compared pair by pair; a larger one draws again with its own randomness and splits further, down to
``DEPTH``. A larger child that splitting would not thin out, since its members mostly agree with one of them, and every larger
child of the last level is left whole.

**Families.** Whole children of all runs that share members are one family. Every pair of a family is compared on the full sets, in pairs of
salted blocks that return links enough to connect what is linked. So no pair of a family is missed, whatever its size, and none of its
pairs becomes a row.

**Runs.** A likely pair (by sketch) of a new run outside the families that the earlier runs do not have is one they missed. The share of
such pairs tells how probably all runs so far miss one; runs repeat until that is at most 1 - ``recall``, ``MOST_RUNS`` times at most,
and a warning says so if that is not enough. At the end the candidates of all runs are verified on the full sets.

The result has a row per document: its class (connected texts, named by the least doc_id), the number of *links* (other representatives it was
verified similar to) and of *copies* (documents with the same set, itself included).

Nulls: a null or wordless text is alone in its class, which is named by its doc_id, without links. A class in which no doc_id is known has a
null name. Repeated rows are copies. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.llm.common import arrow_schema, bucketed, emit, fresh, same, saved, struct, text_key, texts_in_blocks

WIDTH = 5
TOKENS = 64
ROOT_DRAWS = 4
DRAWS = 2
SMALL = 24
DEPTH = 4
MOST_RUNS = 6
SLACK = 0.2  # how far below the threshold a sketch may fall before a pair is not verified: four standard deviations

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
DENSE = 0.5  # mean agreement with one member from which a large child is not split further
BLOCK = 256  # members of a family compared at a time; a large family is dealt in blocks of up to four times that
BLOCK_BYTES = 16 << 20
TEXT_BYTES = 2 << 20  # text taken at a time: as words and hashes it is some ten times as large
COLUMNS = 4096  # hashes in one product of a comparison
SKETCHED = struct(doc_id="long", text_key="long", rep="binary", sketch="binary")
SETS = struct(rep="binary", grams="binary")
PATHS = struct(path="long", rep="binary")
PAIRS = struct(a="binary", b="binary", agree="int")
LINKS = struct(a="binary", b="binary")
INNER = struct(rep="binary", part="binary", n="long")
FOUND = struct(a="binary", b="binary", n="long")
ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, and how many words each has."""
    lowered = [t.translate(LOWER).split() for t in texts]
    lengths = np.array([len(w) for w in lowered], dtype=np.int64)
    flat = pa.array([w for words in lowered for w in words], pa.binary()).dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in flat.dictionary.to_numpy(zero_copy_only=False)], dtype=np.uint64)
    return known[flat.indices.to_numpy()] if len(known) else np.zeros(0, dtype=np.uint64), lengths


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def gram_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    hashes, lengths = word_hashes(texts)
    out = []
    at = 0
    for n in lengths.tolist():
        own = hashes[at : at + n]
        at += n
        size = min(width, n)
        grams = np.zeros(n - size + 1 if n else 0, dtype=np.uint64)
        for k in range(size):
            grams = grams * ODD + own[k : k + len(grams)]
        out.append(np.unique(mixed(grams)))
    return out


def coefficients(seed: int = 6) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, TOKENS, dtype=np.uint64)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """TOKENS 32-bit MinHash values for each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), TOKENS), dtype=np.uint32)
    for k, (a, b) in enumerate(zip(*coefficients(), strict=True)):
        out[:, k] = np.minimum.reduceat(((flat * a + b) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def sketch_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, representative (digest of the set) and sketch; both null without words."""
    schema = arrow_schema(SKETCHED)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for part, texts in texts_in_blocks(batch, 2, TEXT_BYTES):
                sets = gram_sets(texts)
                full = [s for s in sets if len(s)]
                found = iter(sketches(full)) if full else iter(())
                for doc_id, key, grams in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), sets, strict=True):
                    yield (doc_id, key, xxhash.xxh3_128_digest(grams.tobytes()), next(found).tobytes()) if len(grams) else (doc_id, key, None, None)

    source = docs.select(F.col("doc_id").cast("bigint"), text_key(F.col("text")).alias("text_key"), "text")
    return source.mapInArrow(lambda batches: emit(schema, rows(batches), 5000), SKETCHED)


def matrix(column: pa.Array) -> np.ndarray:
    """Sketches of a column, one per row."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, TOKENS)


def children(paths: np.ndarray, tokens: np.ndarray, draws: int, run: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each draw the child path of every row: the path alone decides the position, the token there the child."""
    step = lambda k: np.uint64((k + 1) * int(ODD) % (1 << 64))
    seeds = mixed(paths.astype(np.uint64) + step(run))
    taken = np.zeros((len(paths), TOKENS), dtype=bool)
    every = np.arange(len(paths))
    for k in range(draws):
        position = (mixed(seeds + step(k)) % np.uint64(TOKENS)).astype(np.int64)
        while taken[every, position].any():  # draws of a path are distinct
            position = np.where(taken[every, position], (position + 1) % TOKENS, position)
        taken[every, position] = True
        token = tokens[every, position].astype(np.uint64)
        yield every, mixed(mixed(seeds + position.astype(np.uint64)) + token * ODD).astype(np.int64)


def root_paths(reps: DataFrame, run: int) -> DataFrame:
    schema = arrow_schema(PATHS)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = matrix(batch.column(1))
            for _, child in children(np.zeros(len(tokens), dtype=np.int64), tokens, ROOT_DRAWS, run):
                yield pa.RecordBatch.from_arrays([pa.array(child), batch.column(0)], schema=schema)

    return reps.select("rep", "sketch").mapInArrow(split, PATHS)


def small_pairs(members: DataFrame) -> DataFrame:
    """All pairs within small children, as far as sketches make them likely."""
    schema = arrow_schema(PAIRS)
    least = int((0.8 - SLACK) * TOKENS)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            paths = table.column("path").to_numpy()
            tokens = matrix(table.column("sketch").combine_chunks())
            reps = table.column("rep").to_pylist()
            for k in range(1, min(SMALL, len(paths))):
                at = np.flatnonzero(paths[:-k] == paths[k:])
                agree = (tokens[at] == tokens[at + k]).sum(axis=1)
                good = agree >= least
                pairs = [(min(reps[i], reps[i + k]), max(reps[i], reps[i + k]), int(n)) for i, n in zip(at[good].tolist(), agree[good].tolist(), strict=True)]
                yield from emit(schema, iter(pairs), 10_000)
            # the last path may go on in the next batch
            held = table.slice(int(np.searchsorted(paths, paths[-1]))).to_batches() if len(paths) else []

    # at most SMALL rows to a path
    return members.repartition("path").sortWithinPartitions("path").mapInArrow(compare, PAIRS)


def agreement(df: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """``df`` with the number of tokens that two sketch columns share."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.IntegerType())])
    one, two = df.columns.index(left), df.columns.index(right)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            agree = (matrix(batch.column(one)) == matrix(batch.column(two))).sum(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(agree)], names=[*batch.schema.names, name])

    return df.mapInArrow(count, schema)


def split_large(large: DataFrame, run: int, last: bool) -> tuple[DataFrame, DataFrame]:
    """Large paths that splitting would not thin out as (path, rep), and the children of the others' members."""
    if last:
        return large.select("path", "rep"), large.select("path", "rep").limit(0)
    pivots = large.where(F.col("rep") == F.col("random")).select("path", F.col("sketch").alias("pivot_sketch"))
    judged = agreement(large.select("path", "rep", "sketch").join(saved(pivots, "pivots"), "path"), "sketch", "pivot_sketch", "agree")
    dense = saved(judged.groupBy("path").agg((F.avg("agree") >= DENSE * TOKENS).alias("dense")), "dense")
    placed = large.select("path", "rep", "sketch").join(dense, "path")
    schema = arrow_schema(PATHS)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = matrix(batch.column(2))
            for _, child in children(batch.column(0).to_numpy(), tokens, DRAWS, run):
                yield pa.RecordBatch.from_arrays([pa.array(child), batch.column(1)], schema=schema)

    return placed.where("dense").select("path", "rep"), placed.where("NOT dense").select("path", "rep", "sketch").mapInArrow(split, PATHS)


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def one_run(reps: DataFrame, run: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b, agree) of one run, each once, and the members (path, rep) of the large paths that were not split."""
    found, left = [], []
    paths = root_paths(reps, run)
    for level in range(DEPTH):
        paths = saved(paths, "paths")
        sizes = paths.groupBy("path").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("rep", F.lit(run)), "rep")).alias("first"))
        sizes = saved(sizes.where("n > 1").select("path", "n", F.col("first.rep").alias("random")), "sizes")
        members = paths.join(sizes, "path")
        members = saved(members.join(reps.select("rep", "sketch"), "rep"), "members")
        found.append(small_pairs(members.where(F.col("n") <= SMALL)))
        if sizes.where(F.col("n") > SMALL).isEmpty():
            break
        whole, paths = split_large(members.where(F.col("n") > SMALL), run, level == DEPTH - 1)
        left.append(whole)
    pairs = saved(union(found).groupBy("a", "b").agg(F.max("agree").alias("agree")), "pairs")
    return pairs, saved(union(left) if left else paths.limit(0), "left")


def candidates(reps: DataFrame, recall: float) -> tuple[DataFrame, DataFrame]:
    """Pairs of all runs and (rep, root) of the families.

    Runs repeat until a likely pair outside the families is missed by all of them with a chance of at most 1 - recall.
    """
    every, left = one_run(reps, 0)
    lefts, missed = [left], 0.0
    for run in range(1, MOST_RUNS):
        own, left = one_run(reps, run)
        lefts.append(left)
        dense = union(lefts).select("rep").distinct()
        a, b = dense.select(F.col("rep").alias("a"), F.lit(True).alias("in_a")), dense.select(F.col("rep").alias("b"), F.lit(True).alias("in_b"))
        new = own.where(F.col("agree") >= int(0.8 * TOKENS)).join(a, "a", "left").join(b, "b", "left").where("in_a IS NULL OR in_b IS NULL")
        joined = new.select("a", "b").join(every.select("a", "b", F.lit(1).alias("known")), ["a", "b"], "left")
        seen = joined.agg(F.count("*").alias("pairs"), F.count("known").alias("known")).first()
        every = saved(every.unionByName(own).groupBy("a", "b").agg(F.max("agree").alias("agree")), "pairs")
        # `run` earlier runs missed this share together; one more run multiplies it by what one run misses
        missed = (1 - seen.known / seen.pairs if seen.pairs else 0.0) ** ((run + 1) / run)
        if missed <= 1 - recall:
            break
    else:
        warnings.warn(f"chosen paths: about {missed:.2%} of the pairs outside families are missed after {MOST_RUNS} runs, {1 - recall:.2%} were allowed", stacklevel=2)
    return every, families(union(lefts))


def families(left: DataFrame) -> DataFrame:
    """(rep, root): large paths that share members are one family."""
    least = saved(left.groupBy("rep").agg(F.min("path").alias("b")), "least")
    # paths are connected, not members: there are far fewer
    roots = components(left.join(least, "rep").select(F.col("path").alias("a"), "b").distinct())
    return saved(least.join(roots.withColumnRenamed("rep", "b"), "b").select("rep", "root"), "families")


def shared_grams(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of ``left`` shares with each of ``right``."""
    flat = np.concatenate([*left, *right])
    _, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    # hashes of one set only are in no intersection
    column = np.cumsum(times > 1) - 1
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    useful = times[place] > 1
    row, place = row[useful], column[place[useful]]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for begin in range(0, int(column[-1]) + 1, COLUMNS):
        own = slice(*np.searchsorted(place, [begin, begin + COLUMNS]))
        grid = np.zeros((len(left) + len(right), COLUMNS), dtype=np.float32)
        grid[row[own], place[own] - begin] = 1
        out += grid[: len(left)] @ grid[len(left) :].T
    return out.astype(np.int64)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect whatever the matrix of links connects."""
    left, right = linked.shape
    open_rows, open_columns = np.ones(left, dtype=bool), np.ones(right, dtype=bool)
    out: list[tuple[int, int]] = []
    for begin in range(left):
        if not open_rows[begin]:
            continue
        open_rows[begin] = False
        rows = [begin]
        while rows:
            i = rows.pop()
            for j in np.flatnonzero(linked[i] & open_columns).tolist():
                open_columns[j] = False
                out.append((i, j))
                for k in np.flatnonzero(linked[:, j] & open_rows).tolist():
                    open_rows[k] = False
                    out.append((k, j))
                    rows.append(k)
    return out


def links_between(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets of ``left`` are similar to which of ``right``."""
    sizes, others = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    out = np.empty((len(left), len(right)), dtype=bool)
    for i in range(0, len(left), BLOCK):
        for j in range(0, len(right), BLOCK):
            shared = shared_grams(left[i : i + BLOCK], right[j : j + BLOCK])
            out[i : i + BLOCK, j : j + BLOCK] = shared >= threshold * (sizes[i : i + BLOCK, None] + others[j : j + BLOCK] - shared)
    return out


def family_links(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Every pair of a family compared on the full sets, block by block.

    Rows (a, b, null) are links enough to connect what is linked, rows (a, null, n) how many links a has in one block or pair of blocks.
    """
    full = members.join(sets, "rep")
    size = full.groupBy("root").agg(F.count("*").alias("n"), F.sum(F.length("grams")).alias("bytes"))
    rows = F.greatest(F.lit(BLOCK), F.least(F.lit(4 * BLOCK), F.col("n") / 16))
    size = size.select("root", F.ceil(F.greatest(F.col("n") / rows, F.col("bytes") / F.lit(BLOCK_BYTES))).cast("int").alias("blocks"))
    dealt = full.join(saved(size, "sizes"), "root").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    schema, inner = arrow_schema(FOUND), arrow_schema(INNER)

    def sets_of(table: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(x, dtype=np.uint64) for x in table.column("grams").to_pylist()]

    def within(table: pa.Table) -> pa.Table:
        own, reps = sets_of(table), table.column("rep").to_pylist()
        linked = links_between(own, own, threshold)
        np.fill_diagonal(linked, False)
        part = np.arange(len(own))
        while True:  # the least of each component, as in ``components``
            least = np.array([min(part[i], part[row].min(initial=part[i])) for i, row in enumerate(linked)])
            least = least[least]
            if (least == part).all():
                break
            part = least
        return pa.Table.from_arrays([pa.array(reps, pa.binary()), pa.array([reps[k] for k in part], pa.binary()), pa.array(linked.sum(axis=1))], schema=inner)

    def between(key: tuple, table: pa.Table) -> pa.Table:
        at = table.column("own").to_numpy()
        left, right = (table.filter(pa.array(at == k.as_py())) for k in key[1:])
        if not len(left) or not len(right):
            return schema.empty_table()
        linked = links_between(sets_of(left), sets_of(right), threshold)
        out: list[tuple] = []
        for side, counts in ((left, linked.sum(axis=1)), (right, linked.sum(axis=0))):
            out += [(rep, None, n) for rep, n in zip(side.column("rep").to_pylist(), counts.tolist(), strict=True) if n]
        # what a block connects by itself is one node
        a, b = (side.column("part").combine_chunks().dictionary_encode() for side in (left, right))
        joined = np.zeros((len(a.dictionary), len(b.dictionary)), dtype=bool)
        i, j = np.nonzero(linked)
        joined[a.indices.to_numpy()[i], b.indices.to_numpy()[j]] = True
        out += [(a.dictionary[i].as_py(), b.dictionary[j].as_py(), None) for i, j in forest(joined)]
        return pa.Table.from_batches(emit(schema, iter(out)), schema=schema)

    parts = saved(dealt.select("root", "own", "rep", "grams").groupBy("root", "own").applyInArrow(within, INNER), "parts")
    pairs = dealt.join(parts.select("rep", "part"), "rep").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("own <> other")
    pairs = pairs.select("root", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "rep", "part", "grams")
    across = pairs.groupBy("root", "lo", "hi").applyInArrow(between, FOUND)
    stars = parts.where("rep <> part").select(F.col("rep").alias("a"), F.col("part").alias("b"), F.lit(None).cast("bigint").alias("n"))
    counts = parts.where("n > 0").select(F.col("rep").alias("a"), F.lit(None).cast("binary").alias("b"), "n")
    return across.unionByName(stars).unionByName(counts)


def full_sets(docs: DataFrame, sketched: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, grams) of the wanted representatives, from one text each."""
    one = sketched.where("rep IS NOT NULL").groupBy("rep").agg(F.min(F.struct("doc_id", "text_key")).alias("text")).join(wanted, "rep")
    one = one.select("rep", "text.doc_id", "text.text_key").alias("o")
    d = docs.select(F.col("doc_id").cast("bigint"), text_key(F.col("text")).alias("text_key"), "text").alias("d")
    texts = d.join(one, same(F.col("d.doc_id"), F.col("o.doc_id")) & (F.col("d.text_key") == F.col("o.text_key"))).select("o.rep", "d.text")
    schema = arrow_schema(SETS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for part, found in texts_in_blocks(batch, 1, TEXT_BYTES):
                for rep, grams in zip(part.column(0).to_pylist(), gram_sets(found), strict=True):
                    yield rep, grams.tobytes()

    # rows equal in doc_id and text give the same set again
    return texts.mapInArrow(lambda batches: emit(schema, rows(batches)), SETS).dropDuplicates(["rep"])


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose full sets are similar."""
    schema = arrow_schema(LINKS)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                left, right = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                shared = len(np.intersect1d(left, right, assume_unique=True))
                if shared >= threshold * (len(left) + len(right) - shared):
                    good.append((a, b))
            yield from emit(schema, iter(good), 10_000)

    left = sets.select(F.col("rep").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("grams").alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(check, LINKS)


def components(links: DataFrame) -> DataFrame:
    """(rep, root) of every linked representative: the least of its component, by rounds of least neighbours and shortcuts."""
    both = saved(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    roots = saved(both.groupBy(F.col("a").alias("rep")).agg(F.least(F.min("a"), F.min("b")).alias("root")), "roots")
    while True:
        near = both.join(roots, both.b == roots.rep).groupBy(F.col("a").alias("rep")).agg(F.min("root").alias("near"))
        lower = roots.join(near, "rep").select("rep", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = roots.select(F.col("rep").alias("up_rep"), F.col("root").alias("up"))
        step = lower.join(up, lower.root == up.up_rep).select("rep", "old", F.least("root", "up").alias("root"))
        step = saved(step, "roots")
        roots = step.select("rep", "root")
        if step.where("root <> old").isEmpty():
            return roots


def near_duplicates(docs: DataFrame, threshold: float = 0.8, recall: float = 0.99) -> DataFrame:
    """doc_id, text_key, class_id, n_links, n_copies of every document, and ``first``: whether it is the first of its class."""
    sketched = saved(sketch_documents(docs), "sketches")
    reps = sketched.where("rep IS NOT NULL").groupBy("rep").agg(F.first("sketch").alias("sketch"), F.count("*").alias("n_copies"))
    # every level of every run joins the sketches again: they are dealt once
    reps = bucketed(reps, "reps", "rep", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pairs, members = candidates(reps, recall)
    of_a, of_b = members.select(F.col("rep").alias("a"), F.col("root").alias("root_a")), members.select(F.col("rep").alias("b"), F.col("root").alias("root_b"))
    # pairs within a family are compared there
    pairs = saved(pairs.join(of_a, "a", "left").join(of_b, "b", "left").where("coalesce(root_a <> root_b, true)").select("a", "b"), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("rep")).unionByName(members.select("rep")).distinct()
    sets = saved(full_sets(docs, sketched, ends), "sets")
    inside = saved(family_links(members, sets, threshold), "inside")
    outside = saved(verified(pairs, sets, threshold), "links")
    links = outside.unionByName(inside.where("b IS NOT NULL").select("a", "b"))
    ends = outside.select(F.explode(F.array("a", "b")).alias("rep"), F.lit(1).cast("bigint").alias("n"))
    # a family's own links come as counts
    degrees = ends.unionByName(inside.where("b IS NULL").select(F.col("a").alias("rep"), "n")).groupBy("rep").agg(F.sum("n").alias("n_links"))
    classes = reps.select("rep", "n_copies").join(degrees, "rep", "left").join(components(links), "rep", "left")
    classes = saved(classes.select("rep", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "rep").alias("root")), "classes")
    placed = saved(sketched.select("doc_id", "text_key", "rep").join(classes, "rep", "left"), "placed")
    rank = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key")
    names = saved(placed.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("class_id"), F.min(rank).alias("lead")), "names")
    p = placed.join(names, "root", "left")
    return p.select(
        "doc_id",
        "text_key",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        (F.col("root").isNull() | rank.eqNullSafe(F.col("lead"))).alias("first"),
    )


def one_of_each(docs: DataFrame, threshold: float = 0.8, recall: float = 0.99) -> DataFrame:
    """``docs`` with only the first document of each class, by (doc_id, nulls last; hash of the text); wordless rows all stay."""
    found = near_duplicates(docs, threshold, recall)
    late, key = fresh(docs, "_wordless"), fresh(docs, "_key")
    firsts = found.where("first").groupBy("doc_id", "text_key").agg(F.lit(1).alias("one")).alias("f")
    d = docs.withColumn(key, text_key(F.col("text"))).alias("d")
    kept = d.join(firsts, same(F.col("d.doc_id"), F.col("f.doc_id")) & (F.col(f"d.{key}") == F.col("f.text_key")), "left_semi")
    wordless = F.coalesce(F.length(F.trim(F.translate(F.coalesce("text", F.lit("")), "\t\n\x0b\x0c\r", "     "))) == 0, F.lit(True))
    kept = kept.withColumn(late, F.when(wordless, F.monotonically_increasing_id()))
    return kept.dropDuplicates(["doc_id", key, late]).select(*docs.columns)
