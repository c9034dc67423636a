"""Parquet tables that change by whole files.

A table is a folder with ``data/table_version=<n>/...`` and ``manifests/version=<n>``. A manifest is one
JSON row that names the folders which make up the table at a version and ends with the mark ``complete``. Writers
only add: new data folders first, then the manifest, so a reader sees the old version or the new one, and a job that dies
in between leaves nothing but an unnamed folder that its retry overwrites. No success marker of the file
committer is needed: a manifest counts if its row reads whole. One writer per table.

A manifest also keeps the shape that each folder was written in, so that a table whose columns were added to or widened reads its
older folders under the new shape, and the print of the rules that its rows went through.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.sources.evolution import require_readable

# A folder's ``shape`` is a place in ``shapes``, each the JSON of a schema; manifests from before shapes were kept lack both.
MANIFEST = """
    stream STRING, batch_id BIGINT, live ARRAY<STRUCT<part: ARRAY<STRING>, dir: STRING, level: INT, shape: INT>>,
    shapes ARRAY<STRING>, rules STRING, complete BOOLEAN
"""


# Fixed value: the folder name Spark gives a NULL partition value.
_NULL_PART = "__HIVE_DEFAULT_PARTITION__"


class Folder(NamedTuple):
    """A folder of rows, how often its rows have been merged, and the shape they were written in (JSON)."""

    dir: str
    level: int = 0
    shape: str | None = None


@dataclass
class Version:
    """A committed state: which folders hold each part, and the batch that led to it.

    Parts are few: calendar periods, or one.
    """

    number: int = 0
    stream: str = ""
    batch_id: int = -1
    live: dict[tuple, list[Folder]] = field(default_factory=dict)
    rules: str | None = None

    def folders(self) -> list[Folder]:
        return [folder for own in self.live.values() for folder in own]


def whole(folder: str, schema: T.StructType) -> dict[tuple, list[Folder]]:
    """A table that is one folder."""
    return {("all",): [Folder(folder, shape=schema.json())]}


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Versions that have a manifest, newest first, from file names alone."""
    if not exists(spark, f"{root}/manifests"):
        return []
    files = spark.read.schema(MANIFEST).json(f"{root}/manifests").inputFiles()
    return sorted({int(n) for file in files for n in re.findall(r"/version=(\d+)/", file)}, reverse=True)


def current(spark: SparkSession, root: str) -> Version:
    for number in _numbers(spark, root):
        row = spark.read.schema(MANIFEST).json(f"{root}/manifests/version={number}").first()
        if row and row.complete:
            live: dict[tuple, list[Folder]] = {}
            for entry in row.live or []:
                shape = row.shapes[entry.shape] if entry.shape is not None else None
                live.setdefault(tuple(entry.part), []).append(Folder(entry.dir, entry.level, shape))
            return Version(number, row.stream, row.batch_id, live, row.rules)
    return Version()


def commit(spark: SparkSession, root: str, version: Version) -> None:
    shapes = sorted({folder.shape for folder in version.folders() if folder.shape})
    at = {shape: i for i, shape in enumerate(shapes)}
    live = [(list(part), f.dir, f.level, at.get(f.shape)) for part, own in version.live.items() for f in own]
    row = spark.createDataFrame([(version.stream, version.batch_id, live, shapes, version.rules, True)], MANIFEST)
    row.coalesce(1).write.mode("overwrite").json(f"{root}/manifests/version={version.number}")
    if current(spark, root).number != version.number:
        raise RuntimeError(f"{root}: version {version.number} was written but is not the current one")


def read(spark: SparkSession, root: str, schema: T.StructType, folders: Sequence[Folder]) -> DataFrame:
    """The named folders as one table of the given shape; partition columns come from the paths with the declared types.

    Folders of an older shape read like the others if columns were only added, widened or left out.
    """
    if not folders:
        return spark.createDataFrame([], schema)
    for shape in {folder.shape for folder in folders if folder.shape}:
        require_readable(T.StructType.fromJson(json.loads(shape)), schema, root)
    paths = [f"{root}/{folder.dir}" for folder in folders]
    return spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*paths).select(*schema.names)


def written_parts(spark: SparkSession, root: str, number: int, by: Sequence[str]) -> dict[tuple, str]:
    """Part values and folder of everything a version wrote, from the file listing; no row is read."""
    written = spark.read.schema("x INT").parquet(f"{root}/data/table_version={number}").inputFiles()
    folders = {file.rsplit("/", 1)[0] for file in written}
    parts = {}
    for folder in folders:
        tail = unquote(folder.rsplit("/data/", 1)[1])
        values = dict(step.split("=", 1) for step in tail.split("/"))
        part = tuple(None if values[c] == _NULL_PART else unquote(values[c]) for c in by)
        parts[part] = f"data/{tail}"
    return parts


def superseded(spark: SparkSession, root: str) -> list[str]:
    """Folders of earlier versions that the current one no longer names; safe to expire."""
    manifests = [f"{root}/manifests/version={n}" for n in _numbers(spark, root)]
    if not manifests:
        return []
    named = spark.read.schema(MANIFEST).json(manifests).select(F.explode("live.dir").alias("dir")).distinct()
    alive = [folder.dir for folder in current(spark, root).folders()]
    return sorted(r.dir for r in named.where(~F.col("dir").isin(alive)).collect())


def delete(spark: SparkSession, root: str, folders: Sequence[str]) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in folders:
        files.delete(hadoop.Path(f"{root}/{folder}"), True)


def subfolders(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Folders below ``root`` that match a path pattern, relative to it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(root)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop.Path(f"{root}/{pattern}")) or []
    depth = len(pattern.split("/"))
    return ["/".join(status.getPath().toString().split("/")[-depth:]) for status in found]


def expire(spark: SparkSession, root: str) -> list[str]:
    """Delete what only earlier versions name, and their manifests, so that listings stay short.

    Nobody may be reading an earlier version meanwhile.
    """
    now, gone = current(spark, root), superseded(spark, root)
    delete(spark, root, [*gone, *(f"manifests/version={n}" for n in _numbers(spark, root) if n < now.number)])
    return gone
