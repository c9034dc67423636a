"""What the operators share: reading columns whatever else a table holds, written tables that cut lineage, row keys."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.session import shared_dir


# Rows cross to a Python worker in batches of this size at most, or one row if it is larger. Spark's own 64 MB count several times: in
# Spark's buffers, in the worker's, and as the objects made of them.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would, and the session batches of bounded size."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_wattmill_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    path = Path(tempfile.mkdtemp(prefix="run-")) / "wattmill.zip"  # on the driver only; Spark hands out the file
    with zipfile.ZipFile(path, "w") as bundle:
        for source in sorted((root / "wattmill").rglob("*.py")):
            bundle.write(source, source.relative_to(root))
    sc.addPyFile(str(path))
    sc._wattmill_shipped = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def saved(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` into the cluster's shared folder and read it again: a lost executor costs no earlier step."""
    path = shared_dir(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """``saved``, with the rows dealt to files by ``column``: joins and groups on it need not shuffle them again."""
    path = shared_dir(df.sparkSession, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.bucketBy(buckets, column).option("path", path).saveAsTable(table, format="parquet")
    return df.sparkSession.table(table)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    """Tells apart rows that share a doc_id. Rows equal in doc_id and text count as the same document."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null reads as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts_in_blocks(batch: pa.RecordBatch, column: int, most_bytes: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch with about ``most_bytes`` of text each."""
    texts = raw_texts(batch.column(column))
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most_bytes or i == len(texts) - 1:
            yield batch.slice(begin, i + 1 - begin), texts[begin : i + 1]
            begin, size = i + 1, 0


def emit(schema: pa.Schema, rows: Iterable[tuple], most_rows: int = 2000, most_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows as record batches bounded by count and by the size of their binary values."""
    kept: list[tuple] = []
    size = 0
    for row in rows:
        kept.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if len(kept) >= most_rows or size >= most_bytes:
            yield _batch(schema, kept)
            kept, size = [], 0
    if kept:
        yield _batch(schema, kept)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(values), type=field.type) for field, values in zip(schema, zip(*rows, strict=True), strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


ARROW = {
    T.LongType(): pa.int64(),
    T.IntegerType(): pa.int32(),
    T.DoubleType(): pa.float64(),
    T.BooleanType(): pa.bool_(),
    T.StringType(): pa.string(),
    T.BinaryType(): pa.binary(),
}


def arrow_schema(schema: T.StructType) -> pa.Schema:
    def kind(t: T.DataType) -> pa.DataType:
        if isinstance(t, T.ArrayType):
            return pa.list_(kind(t.elementType))
        if isinstance(t, T.StructType):
            return pa.struct([pa.field(f.name, kind(f.dataType)) for f in t.fields])
        return ARROW[t]

    return pa.schema([pa.field(f.name, kind(f.dataType)) for f in schema.fields])


NAMED = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "bool": T.BooleanType(), "string": T.StringType(), "binary": T.BinaryType()}


def struct(**fields: str | T.DataType) -> T.StructType:
    """A schema without a session at hand: column names and kinds."""
    return T.StructType([T.StructField(name, NAMED[kind] if isinstance(kind, str) else kind) for name, kind in fields.items()])
