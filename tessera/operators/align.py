"""Schema alignment across copies of one logical table.

Tenant copies drift: a column is missing in one, typed ``int`` in another and
``string`` in a third. Spark's own union rules (ANSI on) widen some pairs,
cast strings to numbers at run time (and fail on a bad value), and reject
others at analysis. A *policy* picks one behaviour up front:

* ``"lossless"`` (default) — the narrowest type that holds every input's
  values exactly (``int`` + ``bigint`` is ``bigint``); text if there is none.
* ``"string"`` — a column whose type differs between inputs is text in every
  input, so no value can fail the union.
* ``"widen"``  — leave it to Spark's union type coercion.
* ``"fail"``   — raise ``SchemaConflict`` naming the column and the types.

Text of nested values is JSON, of binary values base64.

Everything here is driver-side schema arithmetic that ends in ``select``
expressions; no data moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, MapType, NullType, ShortType, StructField, StructType,
                               TimestampNTZType)

POLICIES = ("lossless", "string", "widen", "fail")

# Integer types from narrow to wide, with the decimal digits each needs.
_INTEGERS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}


class SchemaConflict(ValueError):
    """Two inputs disagree on a column's type under policy ``fail``."""


def _key(name: str) -> str:
    # Spark resolves column names case-insensitively by default.
    return name.lower()


def column_types(frames: Sequence[DataFrame]) -> dict[str, list[DataType]]:
    """Distinct types per (case-folded) column name, in first-seen order."""
    seen: dict[str, list[DataType]] = {}
    for df in frames:
        for field in df.schema.fields:
            types = seen.setdefault(_key(field.name), [])
            if field.dataType not in types:
                types.append(field.dataType)
    return seen


def compatible(a: DataType, b: DataType) -> bool:
    """Same leaf types; structs may lack fields (a by-name union null-fills them)."""
    if isinstance(a, StructType) and isinstance(b, StructType):
        fb = {f.name.lower(): f.dataType for f in b.fields}
        return all(compatible(f.dataType, fb[f.name.lower()]) for f in a.fields if f.name.lower() in fb)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return compatible(a.elementType, b.elementType)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return compatible(a.keyType, b.keyType) and compatible(a.valueType, b.valueType)
    return a == b


def conflicting_columns(frames: Sequence[DataFrame]) -> dict[str, list[DataType]]:
    """Columns whose types differ between inputs beyond missing struct fields."""
    out = {}
    for k, types in column_types(frames).items():
        if any(not compatible(a, b) for i, a in enumerate(types) for b in types[i + 1:]):
            out[k] = types
    return out


def widened(a: DataType, b: DataType) -> DataType | None:
    """The narrowest type that holds all values of both exactly, or None."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        out, theirs = [], {f.name.lower(): f for f in b.fields}
        for f in a.fields:
            other = theirs.pop(f.name.lower(), None)
            to = f.dataType if other is None else widened(f.dataType, other.dataType)
            if to is None:
                return None
            out.append(StructField(f.name, to))
        return StructType(out + [StructField(f.name, f.dataType) for f in theirs.values()])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        to = widened(a.elementType, b.elementType)
        return None if to is None else ArrayType(to)
    if isinstance(a, MapType) and isinstance(b, MapType):
        key, value = widened(a.keyType, b.keyType), widened(a.valueType, b.valueType)
        return None if key is None or value is None else MapType(key, value)
    if a in _INTEGERS and b in _INTEGERS:
        return max(a, b, key=_INTEGERS.get)
    if {a, b} <= {FloatType(), DoubleType()}:
        return DoubleType()
    for x, y in ((a, b), (b, a)):
        if x in _INTEGERS and isinstance(y, (FloatType, DoubleType)):
            # A double has 15 digits for sure: enough for 32 bits; a float for 16.
            return None if x == LongType() else DoubleType() if isinstance(y, DoubleType) or x == IntegerType() else y
        if x == DateType() and isinstance(y, TimestampNTZType):
            return y
    if all(t in _INTEGERS or isinstance(t, DecimalType) for t in (a, b)):
        whole, scale = zip(*((_INTEGERS[t], 0) if t in _INTEGERS else (t.precision - t.scale, t.scale) for t in (a, b)))
        return DecimalType(max(whole) + max(scale), max(scale)) if max(whole) + max(scale) <= 38 else None
    return None


def _as_text(column: Column, kind: DataType) -> Column:
    if isinstance(kind, (StructType, ArrayType, MapType)):
        return F.to_json(column)
    return F.base64(column) if isinstance(kind, BinaryType) else column.cast("string")


def _own_shape(own: DataType, to: DataType) -> DataType:
    """``to`` cut down to the fields ``own`` has: a by-name union fills in the others."""
    if isinstance(own, StructType) and isinstance(to, StructType):
        theirs = {f.name.lower(): f.dataType for f in to.fields}
        return StructType([StructField(f.name, _own_shape(f.dataType, theirs[f.name.lower()])) for f in own.fields])
    if isinstance(own, ArrayType) and isinstance(to, ArrayType):
        return ArrayType(_own_shape(own.elementType, to.elementType))
    if isinstance(own, MapType) and isinstance(to, MapType):
        return MapType(_own_shape(own.keyType, to.keyType), _own_shape(own.valueType, to.valueType))
    return to


def align(frames: Sequence[DataFrame], on_conflict: str = "lossless") -> list[DataFrame]:
    """Apply the conflict policy; returns frames ready for a union."""
    if on_conflict not in POLICIES:
        raise ValueError(f"on_conflict must be one of {POLICIES}, got {on_conflict!r}")
    conflicts = conflicting_columns(frames)
    if not conflicts or on_conflict == "widen":
        return list(frames)
    if on_conflict == "fail":
        detail = ", ".join(f"{c}: {[t.simpleString() for t in ts]}" for c, ts in conflicts.items())
        raise SchemaConflict(f"column types differ between inputs: {detail}")
    common: dict[str, DataType | None] = {}
    for name, types in conflicts.items():
        to: DataType | None = types[0]
        for t in types[1:]:
            to = widened(to, t) if to is not None else None
        common[name] = to if on_conflict == "lossless" else None
    out = []
    for df in frames:
        cols = []
        for f in df.schema.fields:
            at = F.col(f"`{f.name}`")
            if _key(f.name) in common:
                to = common[_key(f.name)]
                at = (_as_text(at, f.dataType) if to is None else at.cast(_own_shape(f.dataType, to))).alias(f.name)
            cols.append(at)
        out.append(df.select(*cols))
    return out


def union_column_order(frames: Sequence[DataFrame]) -> list[str]:
    """Columns of the first input, then columns first seen in later inputs."""
    order: list[str] = []
    keys: set[str] = set()
    for df in frames:
        for name in df.columns:
            if _key(name) not in keys:
                keys.add(_key(name))
                order.append(name)
    return order
