"""Typed-attribute item exports (``{"Item": {"attr": {"<TYPE>": value}}}`` per line).

Export files are gzip JSON lines under nested folders; gzip is decoded by the
text/JSON sources transparently (a gzip file is one split, so many export
files are what keeps the read parallel).

Two ways to read them:

* known attributes → ``read_typed_items``: an explicit nested schema, no
  inference pass, then one column per attribute in its target type, nested
  maps and lists included;
* unknown attributes → ``read_typed_items_raw``: each item as
  ``map<attribute, map<type, value-text>>`` (nested ``M``/``L`` values stay
  JSON text), for profiling or generic pass-through copies.

Items carry their types themselves, so one attribute may be ``S`` in one item
and ``N`` in another: a scalar is taken from whichever code it has. ``NULL`` is
null. ``N`` is exact decimal text unless the caller names a type.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DecimalType, LongType, MapType, StringType, StructField, StructType

from tessera.operators.fitting import converted, number_digits
from tessera.session import scratch_path

# The attribute type descriptors of the format.
TYPE_CODES = ("S", "N", "B", "BOOL", "NULL", "M", "L", "SS", "NS", "BS")

# What an attribute is read as unless the caller names a type; M and L stay typed JSON text.
_DEFAULT_TYPES = {
    "S": StringType(), "N": StringType(), "B": StringType(), "BOOL": BooleanType(), "NULL": BooleanType(),
    "SS": ArrayType(StringType()), "NS": ArrayType(StringType()), "BS": ArrayType(StringType()),
}
_SCALARS = ("S", "N", "B", "BOOL")
_SETS = ("SS", "NS", "BS")


#: Not a descriptor of the format: an attribute (or struct field with this key in its metadata) read as typed JSON text.
AS_JSON = "JSON"


def _written(to: DataType) -> StructType:
    """How a value of type ``to`` is written: its type codes around it, at every level; other codes as raw text."""
    own: dict[str, DataType] = {}
    if isinstance(to, ArrayType):
        own = {"L": ArrayType(_written(to.elementType)), **{c: ArrayType(StringType()) for c in _SETS}}
    elif isinstance(to, MapType):
        own = {"M": MapType(StringType(), _written(to.valueType))}
    elif isinstance(to, StructType):
        own = {"M": StructType([StructField(f.name, StringType() if AS_JSON in f.metadata else _written(f.dataType)) for f in to.fields])}
    return StructType([StructField(c, own.get(c, StringType())) for c in TYPE_CODES if c != "NULL"])


def _simple(to: DataType) -> bool:
    return not isinstance(to, (ArrayType, MapType, StructType))


def _codes(to: DataType) -> tuple[str, ...]:
    """Type codes that a value of type ``to`` may have."""
    if isinstance(to, ArrayType):
        return ("L", *(_SETS if _simple(to.elementType) else ()))
    return ("M",) if not _simple(to) else _SCALARS


def _value(at: Column, to: DataType) -> Column:
    """The plain value under the type codes; null where it does not convert."""
    if isinstance(to, ArrayType):
        lists = F.transform(at.getField("L"), lambda e: _value(e, to.elementType))
        return F.coalesce(lists, *(F.transform(at.getField(c), lambda e: e.try_cast(to.elementType)) for c in _SETS
                                   if _simple(to.elementType)))
    if isinstance(to, MapType):
        return F.transform_values(at.getField("M"), lambda _, v: _value(v, to.valueType))
    if isinstance(to, StructType):
        m = at.getField("M")
        return F.when(m.isNotNull(), F.struct(*((m.getField(f.name) if AS_JSON in f.metadata else _value(m.getField(f.name), f.dataType))
                                                .alias(f.name) for f in to.fields)))
    return F.coalesce(*(at.getField(c) for c in _SCALARS)).try_cast(to)


def _misfits(at: Column, to: DataType, path: Column) -> Column:
    """Paths of the values under ``at`` that ``to`` does not hold: of another kind, or not convertible without loss."""
    none = F.array().cast("array<string>")
    others = [at.getField(c).isNotNull() for c in TYPE_CODES if c not in ("NULL", *_codes(to))]
    found = [F.when(functools.reduce(lambda a, b: a | b, others), F.array(path)).otherwise(none)]

    def text(value: Column, kind: DataType, place: Column) -> Column:
        return F.when(converted(value, StringType(), kind)[1], F.array(place)).otherwise(none)

    if isinstance(to, ArrayType):
        each = F.transform(at.getField("L"), lambda e, i: _misfits(e, to.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        found.append(F.coalesce(F.flatten(each), none))
        if _simple(to.elementType):
            for c in _SETS:
                members = F.transform(at.getField(c), lambda e, i: text(e, to.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
                found.append(F.coalesce(F.flatten(members), none))
    elif isinstance(to, MapType):
        each = F.transform(F.map_entries(at.getField("M")),
                           lambda e: _misfits(e["value"], to.valueType, F.concat(path, F.lit("{"), e["key"], F.lit("}"))))
        found.append(F.coalesce(F.flatten(each), none))
    elif isinstance(to, StructType):
        m = at.getField("M")
        found += [_misfits(m.getField(f.name), f.dataType, F.concat(path, F.lit("." + f.name))) for f in to.fields if AS_JSON not in f.metadata]
    else:
        found += [text(F.coalesce(*(at.getField(c) for c in _SCALARS)), to, path)]
    return F.when(at.isNull(), none).otherwise(F.concat(*found))


def _type(attribute: str, code: str, cast: Mapping[str, str | DataType] | None) -> DataType | None:
    if code == AS_JSON:
        return None
    if code not in TYPE_CODES:
        raise ValueError(f"unknown type code {code!r} for {attribute!r}")
    if cast and attribute in cast:
        return cast[attribute] if isinstance(cast[attribute], DataType) else DataType.fromDDL(cast[attribute])
    return _DEFAULT_TYPES.get(code)


def typed_item_schema(attributes: Mapping[str, str], cast: Mapping[str, str | DataType] | None = None) -> StructType:
    """``Item struct<attr: struct<CODE: …>, …>`` for attribute → type code."""
    fields = []
    for name, code in attributes.items():
        to = _type(name, code, cast)
        plain = StringType() if code == AS_JSON else StructType([StructField(code, StringType())])
        fields.append(StructField(name, plain if to is None else _written(to)))
    return StructType([StructField("Item", StructType(fields))])


def read_typed_items(spark: SparkSession, path: str, attributes: Mapping[str, str],
                     cast: Mapping[str, str | DataType] | None = None, misfits: str | None = None) -> DataFrame:
    """One column per attribute (absent or ``NULL`` attribute → null).

    ``cast`` names target types (a type or DDL), e.g. ``{"n": "decimal(20,4)", "m": "struct<q:int,tags:array<string>>"}``;
    nested maps and lists are decoded to it. A value that is there but does not convert is null, at any depth. With
    ``misfits`` that array column lists the paths of all values that the target does not hold exactly, e.g. as a
    check for rejects: ``n``, ``m.q`` (field), ``l[2]`` (element), ``m.more{key}`` (map value). ``attributes`` as code
    ``JSON`` are read as typed JSON text.
    """
    raw = (spark.read.option("recursiveFileLookup", "true")
           .schema(typed_item_schema(attributes, cast)).json(path))
    cols, bad = [], []
    for name, code in attributes.items():
        at, to = F.col("Item").getField(name), _type(name, code, cast)
        value = (at if code == AS_JSON else at.getField(code) if to is None else F.lit(None).cast(to) if code == "NULL" else _value(at, to))
        cols.append(value.alias(name))
        if to is not None and code != "NULL":
            bad.append(_misfits(at, to, F.lit(name)))
    if misfits:
        cols.append((F.concat(*bad) if bad else F.array().cast("array<string>")).alias(misfits))
    return raw.select(*cols)


def read_typed_items_raw(spark: SparkSession, path: str) -> DataFrame:
    """Each line as ``item: map<attribute, map<type, value-text>>``."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    # One JSON parse per line (the wrapping object is part of the schema).
    parsed = F.from_json("value", "Item map<string,map<string,string>>")
    return lines.select(parsed.getField("Item").alias("item"))


def profile_items(raw: DataFrame) -> DataFrame:
    """Items per (attribute, type code): the de-facto schema of an export."""
    # explode_outer + a null filter, not explode: for a plain explode the
    # optimizer infers ``size(item) > 0`` and pushes it below the projection,
    # which would parse every JSON line twice.
    attrs = (raw.select(F.explode_outer("item").alias("attribute", "typed"))
                .where(F.col("attribute").isNotNull()))
    codes = attrs.select("attribute", F.explode_outer(F.map_keys("typed")).alias("type_code"))
    return (codes.where(F.col("type_code").isNotNull())
                 .groupBy("attribute", "type_code").agg(F.count(F.lit(1)).alias("n_items")))


def discover_items(spark: SparkSession, path: str, max_fields: int = 200) -> DataFrame:
    """The de-facto type of an export at every depth: ``path, code, n, whole, scale, plain``, written.

    ``path`` is an array: attribute, then a field name of a map, ``[]`` for the elements of a list, or ``{}`` for the values
    of a map that has more than ``max_fields`` different keys. ``n`` counts the values of that code there; ``whole`` and
    ``scale`` are the digits that its numbers need before and after the point, ``plain`` whether all of them are numbers.

    Level by level, by JVM expressions: a round counts what it finds by place and code, then takes the maps and lists out.
    Only these are written to the shared folder, to be taken apart by the next round. Keys that are data are put together
    in the counts, a row per place, and renamed in what is written.
    """
    maps, lists = "map<string,map<string,string>>", "array<map<string,string>>"
    typed, places = "path array<string>, code string, value string", "path array<string>, code string, n bigint, whole int, scale int, plain boolean"
    out, depth = scratch_path(spark, "discovered"), 0
    level = (read_typed_items_raw(spark, path).select(F.explode_outer("item").alias("name", "typed")).where(F.col("name").isNotNull())
             .select(F.array("name").alias("path"), F.explode_outer("typed").alias("code", "value")).where(F.col("code").isNotNull()))
    parent = F.slice("path", 1, F.size("path") - 1)
    while True:
        whole, scale = number_digits(F.when(F.col("code") == "N", F.col("value")))
        members = F.when(F.col("code") == "NS", F.from_json("value", "array<string>"))
        counted = level.groupBy("path", "code").agg(
            F.count(F.lit(1)).alias("n"), F.max(whole).cast("int").alias("whole"), F.max(scale).cast("int").alias("scale"),
            F.coalesce(F.bool_and(F.when(F.col("code") == "N", scale.isNotNull())), F.bool_and(members.isNull()), F.lit(True)).alias("plain"))
        renamed = lambda rows: rows
        if depth:
            tally = scratch_path(spark, "discover-tally")
            counted.write.parquet(tally)
            counted = spark.read.schema(places).parquet(tally)
            # Keys that are data, not names: their values are one place. At most a row per place of the level before.
            wide = (counted.select("path").distinct().where(F.element_at("path", -1) != "[]").groupBy(parent.alias("parent"))
                    .agg(F.count(F.lit(1)).alias("names")).where(F.col("names") > max_fields).select("parent", F.lit(True).alias("wide")))

            def renamed(rows, wide=wide):
                own = [c for c in rows.columns if c != "path"]
                return (rows.withColumn("parent", parent).join(F.broadcast(wide), "parent", "left")
                        .select(F.when(F.col("wide"), F.concat("parent", F.array(F.lit("{}")))).otherwise(F.col("path")).alias("path"), *own))
            counted = renamed(counted).groupBy("path", "code").agg(
                F.sum("n").alias("n"), F.max("whole").alias("whole"), F.max("scale").alias("scale"), F.bool_and("plain").alias("plain"))
        counted.write.parquet(f"{out}/level={depth}")
        if spark.read.schema(places).parquet(f"{out}/level={depth}").where("code IN ('M', 'L')").isEmpty():
            break
        staged = scratch_path(spark, "discover-level")
        renamed(level.where("code IN ('M', 'L')")).write.parquet(staged)
        nested = spark.read.schema(typed).parquet(staged)
        fields = nested.where("code = 'M'").select("path", F.explode_outer(F.from_json("value", maps)).alias("name", "typed"))
        elements = nested.where("code = 'L'").select("path", F.explode_outer(F.from_json("value", lists)).alias("typed"))
        inner = (fields.where(F.col("name").isNotNull()).select(F.concat("path", F.array("name")).alias("path"), "typed")
                 .unionByName(elements.select(F.concat("path", F.array(F.lit("[]"))).alias("path"), "typed")))
        level = inner.select("path", F.explode_outer("typed").alias("code", "value")).where(F.col("code").isNotNull())
        depth += 1
    return spark.read.schema(places).option("recursiveFileLookup", "true").parquet(out)


def propose_types(discovered: DataFrame) -> tuple[dict[str, str], dict[str, DataType]]:
    """(attributes, cast) for ``read_typed_items`` under which no value of what was discovered is lost.

    Numbers become ``bigint`` or the decimal that has all their digits, text where none does; different scalars at one
    place become text; maps become structs (maps, where the keys are data), lists and sets arrays. A place with
    both nested and plain values, and what no such type holds, is read as typed JSON text.
    """
    rows = {}
    for r in discovered.collect():  # a row per place and code, not per value
        rows.setdefault(tuple(r["path"]), {})[r["code"]] = r
    below: dict[tuple, list[str]] = {}
    for path in sorted(rows):
        below.setdefault(path[:-1], []).append(path[-1])

    def scalar(found: dict) -> DataType:
        if set(found) != {"N"} or not found["N"]["plain"]:
            return BooleanType() if set(found) == {"BOOL"} else StringType()
        whole, scale = found["N"]["whole"], found["N"]["scale"]
        if not scale and whole <= 18:
            return LongType()
        return DecimalType(max(1, whole + scale), scale) if whole + scale <= 38 else StringType()

    def kind(path: tuple) -> DataType | None:
        """The type at a place; None if only typed JSON text holds it."""
        found = {c: r for c, r in rows[path].items() if c != "NULL"}
        codes = set(found)
        if codes <= set(_SCALARS):
            return scalar(found) if codes else StringType()
        if codes == {"M"}:
            names = below.get(path, [])
            if names == ["{}"]:
                value = kind((*path, "{}"))
                return None if value is None else MapType(StringType(), value)
            if len({n.lower() for n in names}) < len(names):
                return None  # Spark's field names don't tell case apart
            fields = []
            for n in names:
                inner = kind((*path, n))
                fields.append(StructField(n, StringType() if inner is None else inner, True, {AS_JSON: True} if inner is None else {}))
            return StructType(fields) if fields else MapType(StringType(), StringType())
        if codes <= {"L", *_SETS}:
            if "[]" not in below.get(path, []):
                return ArrayType(StringType())
            inner = kind((*path, "[]"))
            if inner is None or codes != {"L"} and not _simple(inner):
                return None
            return ArrayType(inner if codes == {"L"} else StringType())
        return None

    attributes, cast = {}, {}
    for name in below.get((), []):
        codes = [c for c in rows[(name,)] if c != "NULL"]
        to = kind((name,))
        if not codes or to is None:
            attributes[name] = AS_JSON if codes else "NULL"
            continue
        attributes[name] = sorted(codes)[0]
        cast[name] = to
    return attributes, cast


def typed_item_json(attributes: Mapping[str, str]) -> Column:
    """Row → ``{"Item": {...}}`` text; a null column omits the attribute."""
    fields = []
    for name, code in attributes.items():
        c = F.col(name)
        if code in ("N", "S", "B"):
            value = c.cast("string")
        elif code in ("SS", "NS", "BS"):
            value = F.transform(c, lambda x: x.cast("string"))
        else:
            value = c
        fields.append(F.when(c.isNotNull(), F.struct(value.alias(code))).alias(name))
    return F.to_json(F.struct(F.struct(*fields).alias("Item")))


def export_typed_items(df: DataFrame, path: str, attributes: Mapping[str, str],
                       compression: str = "gzip") -> None:
    """Write ``df`` as a typed-attribute JSON export (gzip lines)."""
    (df.select(typed_item_json(attributes).alias("value"))
       .write.mode("errorifexists").option("compression", compression).text(path))
