"""What payloads hold beside their declared shape.

Parsing by a written-out shape ignores unknown fields and nulls values of another kind. Here every text becomes a VARIANT, whose schemas
merge to one over all files; what that schema has beyond the declared shape is counted by path, in one more pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class Field:
    """A place in the payload, ``[]`` standing for the elements of an array."""

    path: tuple[str, ...]
    declared: str | None = None

    @property
    def name(self) -> str:
        return ".".join(self.path).replace(".[]", "[]")


def kind(t: T.DataType) -> str:
    """Kind of a JSON value; ``mixed`` where files differ, ``null`` where no file has a value."""
    if isinstance(t, T.StructType):
        return "object"
    if isinstance(t, T.ArrayType):
        return "array"
    if isinstance(t, NUMBERS):
        return "number"
    return {T.StringType: "text", T.BooleanType: "boolean", T.VariantType: "mixed", T.NullType: "null"}.get(type(t), "text")


def differences(declared: T.DataType, seen: T.DataType, path: tuple[str, ...] = ()) -> Iterator[Field]:
    """Unknown fields (the topmost only) and fields that have, or in some files have, another kind than declared.

    A declared text takes any value, and a value that is null everywhere fits anything.
    """
    if isinstance(declared, T.StructType) and isinstance(seen, T.StructType):
        for name in seen.names:
            if name not in declared.names:
                yield Field((*path, name))
            else:
                yield from differences(declared[name].dataType, seen[name].dataType, (*path, name))
    elif isinstance(declared, T.ArrayType) and isinstance(seen, T.ArrayType):
        yield from differences(declared.elementType, seen.elementType, (*path, "[]"))
    elif kind(declared) != "text" and kind(seen) not in (kind(declared), "null"):
        yield Field(path, kind(declared))


def merged_shape(raw: DataFrame) -> T.DataType:
    """The schema that covers all readable texts: one row to the driver, as large as the schema."""
    found = raw.select(F.try_parse_json("raw_json").alias("v")).agg(F.schema_of_variant_agg("v")).first()[0]
    return T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", found or "VOID"))


def _values(variant: Column, path: Sequence[str]) -> Column:
    """Values at a path, as an array of variants; steps that a value lacks give none."""
    def at(place: str, kind: str):
        return lambda x: F.try_variant_get(x, place, kind)

    def member(name: str):
        return lambda x: F.try_element_at(F.try_variant_get(x, "$", "map<string, variant>"), F.lit(name))

    found = F.array(variant)
    for step in path:
        if step == "[]":
            found = F.flatten(F.filter(F.transform(found, at("$", "array<variant>")), F.isnotnull))
        else:
            # a path can quote any name but one with quotes
            plain = step and not set(step) & set("'\"")
            found = F.transform(found, at(f"$['{step}']", "variant") if plain else member(step))
    return F.filter(found, lambda x: x.isNotNull() & ~F.is_variant_null(x))


def _kind_of(value: Column) -> Column:
    told = F.schema_of_variant(value)
    return (
        F.when(told.startswith("OBJECT"), "object").when(told.startswith("ARRAY"), "array").when(told == "STRING", "text")
        .when(told == "BOOLEAN", "boolean").otherwise("number")
    )


def unknown_fields(raw: DataFrame, shape: str, family: str) -> DataFrame:
    """(family, path, declared, found, files, times): fields beyond the shape, and values of another kind than declared.

    ``declared`` is null for an unknown field. ``times`` counts values and ``files`` the files that have any; nulls
    do not count. Unreadable texts are left to the quarantine. Both passes scan; nothing is shuffled but a row per task.
    """
    schema = "family string, path string, declared string, found string, files bigint, times bigint"
    fields = list(differences(T.StructType.fromDDL(re.sub(r"\s+", " ", shape).strip()), merged_shape(raw)))
    if not fields:
        return raw.sparkSession.createDataFrame([], schema)
    parsed = raw.select(F.try_parse_json("raw_json").alias("v")).where("v IS NOT NULL")
    cells = []
    for field in fields:
        values = _values(F.col("v"), field.path)
        kinds = F.transform(values, _kind_of)
        if field.declared:
            kinds = F.filter(kinds, F.lit(field.declared).__ne__)
        cells.append(F.struct(F.lit(family).alias("family"), F.lit(field.name).alias("path"), F.lit(field.declared).alias("declared"), kinds.alias("kinds")))
    found = parsed.select(F.inline(F.array(*cells))).where(F.size("kinds") > 0)
    by_kind = found.select("family", "path", "declared", F.explode(F.array_distinct("kinds")).alias("found"), "kinds")
    times = F.size(F.filter("kinds", lambda k: k == F.col("found"))).cast("bigint")
    return by_kind.groupBy("family", "path", "declared", "found").agg(F.count(F.lit(1)).alias("files"), F.sum(times).alias("times"))
