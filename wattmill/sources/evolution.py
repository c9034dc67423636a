"""Tables whose declared columns change while their files stay.

Added columns and widened types are read straight from files of the older shape: the parquet reader fills columns that a file
lacks with NULL and widens its numbers as it decodes them, so no row is written again. A column that goes away is not read.
Anything else (a narrower or different type) has no reading that keeps the values, and asks for a replay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import types as T

# What the reader widens, by type of the file.
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampNTZType,),
}

ADDED, WIDENED, DROPPED, CHANGED = "added", "widened", "dropped", "changed"


@dataclass(frozen=True)
class Change:
    """What became of one column; ``path`` leads into structs, arrays ([]) and maps ({})."""

    path: str
    kind: str
    before: str | None
    after: str | None


class ReplayNeeded(ValueError):
    """Files that cannot be read under the new shape or rules; history has to be replayed into a new target."""


def widens(old: T.DataType, new: T.DataType) -> bool:
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return isinstance(new, WIDER.get(type(old), ()))


def changes(old: T.DataType, new: T.DataType, path: str = "") -> Iterator[Change]:
    """The changes from one shape to another, column by column. Comments and nullability do not count."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        lead = f"{path}." if path else ""
        for name in old.names:
            if name not in new.names:
                yield Change(lead + name, DROPPED, old[name].dataType.simpleString(), None)
        for name in new.names:
            if name not in old.names:
                yield Change(lead + name, ADDED, None, new[name].dataType.simpleString())
            else:
                yield from changes(old[name].dataType, new[name].dataType, lead + name)
    elif isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        yield from changes(old.elementType, new.elementType, f"{path}[]")
    elif isinstance(old, T.MapType) and isinstance(new, T.MapType):
        yield from changes(old.keyType, new.keyType, f"{path}{{key}}")
        yield from changes(old.valueType, new.valueType, f"{path}{{}}")
    elif old != new:
        yield Change(path, WIDENED if widens(old, new) else CHANGED, old.simpleString(), new.simpleString())


def require_readable(old: T.StructType, new: T.StructType, what: str) -> None:
    """Raises unless files of the old shape read whole under the new one."""
    found = [c for c in changes(old, new) if c.kind == CHANGED]
    if found:
        told = ", ".join(f"{c.path}: {c.before} to {c.after}" for c in found)
        raise ReplayNeeded(f"{what} holds files of another shape ({told}); replay it into a new target")
