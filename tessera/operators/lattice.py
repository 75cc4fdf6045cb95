"""Types of many inputs joined as an aggregate.

A schema is taken apart into one row per place in it: a path of field names, ``[]`` for the elements of a
list and ``{}`` for the values of a map, with the kind of type found there and the digits it needs. Joining
schemas is then a grouped aggregate of sets and maxima: it is associative, so partial results merge in any
order, on any number of tasks. The joined rows are put together again into types: at each place
the narrowest that holds every value exactly, the same as ``align.widened`` gives for two.

Where no type holds all (text and numbers, say), the place has none: ``joined_schema`` lists it as a
conflict and makes its whole column text.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               MapType, NullType, ShortType, StringType, StructField, StructType, TimestampNTZType)

#: Digits that an integer type needs, the narrowest first.
_INTEGERS = ((3, ByteType()), (5, ShortType()), (10, IntegerType()), (19, LongType()))
#: One place of a schema; ``path`` has lower-cased names, ``name`` the field as it is written.
PLACES = "path array<string>, name string, position array<int>, kind string, digits int, whole int, scale int"


def places(kind: DataType, path: tuple[str, ...] = (), name: str = "", position: tuple[int, ...] = ()) -> Iterable[tuple]:
    """Rows of ``PLACES`` of a type, the whole before its parts."""
    digits = next((d for d, t in _INTEGERS if t == kind), None)
    if digits:
        yield list(path), name, list(position), "integer", digits, None, None
    elif isinstance(kind, DecimalType):
        yield list(path), name, list(position), "decimal", None, kind.precision - kind.scale, kind.scale
    elif isinstance(kind, StructType):
        yield list(path), name, list(position), "struct", None, None, None
        for k, f in enumerate(kind.fields):
            yield from places(f.dataType, (*path, f.name.lower()), f.name, (*position, k))
    elif isinstance(kind, ArrayType):
        yield list(path), name, list(position), "array", None, None, None
        yield from places(kind.elementType, (*path, "[]"), "[]", (*position, 0))
    elif isinstance(kind, MapType):
        yield list(path), name, list(position), "map", None, None, None
        yield from places(kind.keyType, (*path, "{key}"), "{key}", (*position, 0))
        yield from places(kind.valueType, (*path, "{}"), "{}", (*position, 1))
    else:
        yield list(path), name, list(position), kind.json(), None, None, None


def schema_places(schemas: DataFrame, column: str = "schema") -> DataFrame:
    """One row per place of each schema (JSON text) in ``column``, beside the other columns."""
    others = [f for f in schemas.schema.fields if f.name != column]
    names = [p.split()[0] for p in PLACES.split(", ")]

    def run(batches):
        import pandas as pd
        for batch in batches:
            out = [(*row[:-1], *at) for row in batch.itertuples(index=False)
                   for at in places(StructType.fromJson(json.loads(row[-1]))) if at[0]]
            yield pd.DataFrame(out, columns=[*(f.name for f in others), *names], dtype=object)

    out = StructType([*others, *StructType.fromDDL(PLACES).fields])
    return schemas.select(*(f.name for f in others), column).mapInPandas(run, out)


def join_places(found: DataFrame, order, *by: str) -> DataFrame:
    """One row per place (and group of ``by``): what was seen there. ``order`` says which field name comes first."""
    first = F.struct(order, "position", "name")
    return (found.groupBy(*by, "path").agg(
        F.min(first).alias("first"), F.collect_set("kind").alias("kinds"), F.max("digits").alias("digits"),
        F.max("whole").alias("whole"), F.max("scale").alias("scale"),
        F.count_distinct("kind", *(F.coalesce(c, F.lit(-1)) for c in ("digits", "whole", "scale"))).alias("types"))
        .withColumn("name", F.col("first.name")))


def leaf(kinds: set[str], digits: int | None, whole: int | None, scale: int | None) -> DataType | None:
    """The narrowest type for all that was seen at a place without parts, or None."""
    kinds = kinds - {NullType().json()}
    floats = {FloatType().json(), DoubleType().json()}
    if not kinds:
        return NullType()
    if kinds == {"integer"}:
        return next(t for d, t in _INTEGERS if d >= digits)
    if kinds <= {"integer", "decimal"}:
        whole = max(whole or 0, digits or 0)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if kinds <= floats | {"integer"}:
        if digits and digits > 10:
            return None  # no double holds every 64-bit integer
        return FloatType() if DoubleType().json() not in kinds and (digits or 0) <= 5 else DoubleType()
    if kinds == {DateType().json(), TimestampNTZType().json()}:
        return TimestampNTZType()
    if len(kinds) > 1 or kinds & {"struct", "array", "map"}:
        return None
    # A plain type's JSON is its name: read back as the type of a field.
    named = {"type": "struct", "fields": [{"name": "x", "type": json.loads(next(iter(kinds))), "nullable": True, "metadata": {}}]}
    return StructType.fromJson(named).fields[0].dataType


@dataclass
class Joined:
    """``schema``: every column, in order; ``conflicts``: columns without a common type → the kinds seen at the places that
    clash; ``uniform``: whether every place had one type alone."""
    schema: StructType
    conflicts: dict[str, list[str]] = field(default_factory=dict)
    uniform: bool = True


def joined_schema(rows: Iterable) -> Joined:
    """Put joined places (``join_places`` of one group, collected: as many rows as the schema has places) together."""
    below: dict[tuple, list] = {}
    for r in rows:
        below.setdefault(tuple(r["path"][:-1]), []).append(r)
    for children in below.values():
        children.sort(key=lambda r: r["first"])
    clashes: dict[str, list[str]] = {}

    def kind_of(r) -> DataType | None:
        kinds = set(r["kinds"]) - {NullType().json()}
        path = tuple(r["path"])
        parts = {c["path"][-1]: c for c in below.get(path, ())}
        if kinds == {"struct"}:
            fields = [(c["name"], kind_of(c)) for c in below.get(path, ())]
            return None if any(t is None for _, t in fields) else StructType([StructField(n, t) for n, t in fields])
        if kinds == {"array"}:
            inner = kind_of(parts["[]"])
            return None if inner is None else ArrayType(inner)
        if kinds == {"map"}:
            key, value = kind_of(parts["{key}"]), kind_of(parts["{}"])
            return None if key is None or value is None else MapType(key, value)
        out = leaf(set(r["kinds"]), r["digits"], r["whole"], r["scale"])
        if out is None:
            clashes.setdefault(path[0], []).extend(sorted(k.strip('"') for k in kinds))
        return out

    fields = []
    for r in below.get((), ()):
        to = kind_of(r)
        fields.append(StructField(r["name"], StringType() if to is None else to))
    return Joined(StructType(fields), clashes, all(r["types"] == 1 for rs in below.values() for r in rs))
