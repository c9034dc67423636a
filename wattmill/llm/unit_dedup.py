"""Substring deduplication by hashing the units of paragraphs.

Every text is cut into units: behind each line feed, and behind a mark (``.,;:!?``) and the space after it, so that a passage that repeats within other lines
is made of units of its own. A unit's words (ASCII lower case; letters, digits and what is not ASCII) are hashed to 64 bits. Over the whole corpus the
earliest occurrence of a digest stays and every later one is *repeated*, within a document as well as across documents. Occurrences are ranked by
(doc_id, nulls last; hash of the text; position).

Repeated units go where they make up a passage: a run of repeated units one behind another, of ``least_words`` words in all, is
removed from the start of its first to the end of its last. Units under ``least_unit`` words are too common to tell anything: they are not
hashed, neither break a run nor count for it, and go if they lie inside. So a phrase that recurs by chance stays.

Rows equal in doc_id and text are one document: they are judged alike and lose nothing to each other. A null text has no
units and stays null. Spans are code points of the original text, end exclusive. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.llm.common import arrow_schema, emit, same, saved, struct, text_key, texts_in_blocks

LEAST_WORDS = 25
LEAST_UNIT = 3

CUT = re.compile(rb"\n|[.,;:!?] ")
# lower case, and a space for each ASCII character that no word has
SPELLING = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
UNITS = struct(doc_id="long", text_key="long", n="int", digest="long")
DOCUMENTS = struct(doc_id="long", text="string", n_units="long", n_removed="long", removed=T.ArrayType(SPAN))


def bounds(text: bytes) -> list[int]:
    """Where the units begin, and the end of the text."""
    ends = [m.end() for m in CUT.finditer(text)]
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return [0, *ends]


def words_of(text: bytes, at: list[int]) -> Iterator[list[bytes]]:
    spelt = text.translate(SPELLING)
    for begin, end in zip(at, at[1:], strict=False):
        yield spelt[begin:end].split()


def units(docs: DataFrame, least_unit: int = LEAST_UNIT) -> DataFrame:
    """(doc_id, text_key, n, digest) of every unit that is long enough."""
    schema = arrow_schema(UNITS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for part, texts in texts_in_blocks(batch, 2):
                for doc_id, key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, strict=True):
                    for n, words in enumerate(words_of(text, bounds(text))):
                        if len(words) >= least_unit:
                            digest = hashlib.blake2b(b" ".join(words), digest_size=8).digest()
                            yield doc_id, key, n, int.from_bytes(digest, "little", signed=True)

    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("bigint"), text_key(F.col("text")).alias("key"), "text")
    return rows.mapInArrow(lambda batches: emit(schema, cut(batches), 20_000), UNITS)


def repeated_units(found: DataFrame) -> DataFrame:
    """The units that are not the earliest with their digest."""
    rank = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key", "n")
    firsts = found.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("times")).where("times > 1").select("digest", "first")
    # written, so that both sides of the join are dealt for it and Spark can split a common digest's rows
    firsts = saved(firsts, "firsts")
    return found.join(firsts, "digest").where(~(rank.eqNullSafe(F.col("first")))).drop("first")


def passages(text: bytes, at: list[int], repeated: set[int], least_words: int, least_unit: int) -> list[tuple[int, int]]:
    """First and last unit of each run of repeated units that is long enough."""
    found, first, last, size = [], 0, -1, 0
    for n, words in enumerate(words_of(text, at)):
        if len(words) < least_unit:
            continue
        if n in repeated:
            first, last, size = (n if size == 0 else first), n, size + len(words)
            continue
        if size >= least_words:
            found.append((first, last))
        size = 0
    return [*found, (first, last)] if size >= least_words else found


def without_passages(rows: DataFrame, least_words: int, least_unit: int) -> DataFrame:
    """Documents less their repeated passages, from (doc_id, text, gone)."""
    schema = arrow_schema(DOCUMENTS)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for part, texts in texts_in_blocks(batch, 1):
                known = part.column(1).is_valid().to_pylist()
                for doc_id, there, text, gone in zip(part.column(0).to_pylist(), known, texts, part.column(2).to_pylist(), strict=True):
                    at = bounds(text)
                    spans = passages(text, at, set(gone), least_words, least_unit) if gone else []
                    kept, place, told = [], 0, []
                    for first, last in spans:
                        begin, end = at[first], at[last + 1]
                        kept.append(text[place:begin])
                        place = end
                        start = len(text[:begin].decode())
                        told.append({"start": start, "stop": start + len(text[begin:end].decode())})
                    rest = b"".join([*kept, text[place:]]).decode() if there else None
                    yield doc_id, rest, len(at) - 1, sum(last - first + 1 for first, last in spans), told

    return rows.select("doc_id", "text", "gone").mapInArrow(lambda batches: emit(schema, finish(batches)), DOCUMENTS)


def unit_dedup(docs: DataFrame, least_words: int = LEAST_WORDS, least_unit: int = LEAST_UNIT) -> DataFrame:
    """doc_id, the deduplicated text, what was removed (spans of the original) and how many units there were."""
    found = saved(units(docs, least_unit), "units")
    gone = repeated_units(found).groupBy("doc_id", "text_key")
    # one document's own units, at most as many as it has
    gone = gone.agg(F.collect_set("n").alias("gone")).alias("g")
    d = docs.select(F.col("doc_id").cast("bigint"), "text", text_key(F.col("text")).alias("text_key")).alias("d")
    joined = d.join(gone, same(F.col("d.doc_id"), F.col("g.doc_id")) & (F.col("d.text_key") == F.col("g.text_key")), "left")
    return without_passages(joined.select("d.doc_id", "d.text", "g.gone"), least_words, least_unit)
