"""Convert values to another type without changing them.

``converted`` gives a value in the wanted type and whether something of it would be lost: a digit, a
time of day, a time zone, a field. What is lost is decided per pair of types, all in JVM expressions:

* numbers, dates, timestamps, booleans, binary to text: the result converted back must be the value;
* text to decimals and integers: the places the text needs must be there (no rounding);
* text to doubles and floats: the shortest decimal that gives the result must have the text's digits
  (texts of 15 digits and fewer, 6 for a float, always come back);
* text to dates and timestamps: no time of day, zone or digits of a second that the type does not hold;
* text to booleans: ``true`` and ``false`` only;
* arrays, maps and structs: element by element and field by field (by name); a field that the wanted
  type lacks must be null. Nested values do not fit types that are not nested, nor the other way round.

Null always fits.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegralType, MapType, StringType, StructType, TimestampNTZType, TimestampType)

_NESTED = (ArrayType, MapType, StructType)
_FLOATING = (FloatType, DoubleType)
_NUMBER = r"^\s*[+-]?0*(\d*?)(?:\.(\d*?)0*)?(?:[eE]([+-]?\d+))?\s*$"
_USUAL = r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]*[1-9])?\z"
_ZONE = r"(?i)(?:\d\s*(?:z|[+-]\d{1,2}(?::?\d{2}){0,2})|[a-z]{2,}\S*)\s*$"
_AFTER_MICROS = r"\.\d{6}\d*[1-9]"


def free_name(taken, base: str) -> str:
    """A column name like ``base`` that is not among ``taken`` (compared as Spark does, without case)."""
    have, name = {c.lower() for c in taken}, base
    while name.lower() in have:
        name += "_"
    return name


def _castable(own: DataType, to: DataType) -> bool:
    try:
        SparkSession.active().range(0).select(F.lit(None).cast(own).try_cast(to)).schema  # noqa: B018 — resolves the cast
        return True
    except AnalysisException:
        return False


def _digits(text: Column) -> Column:
    """Significant digits of a number's text."""
    plain = F.regexp_replace(F.regexp_replace(text, r"[eE].*$", ""), r"[^0-9]", "")
    return F.regexp_replace(F.regexp_replace(plain, "^0+", ""), "0+$", "")


def _places(text: Column) -> Column:
    """Decimal places that the number in ``text`` needs; null if it is no plain or scientific number."""
    whole, part, power = (F.regexp_extract(text, _NUMBER, k) for k in (1, 2, 3))
    zeros = F.length(whole) - F.length(F.regexp_replace(whole, "0+$", ""))
    shift = F.when(power == "", F.lit(0)).otherwise(power.try_cast("int"))
    needed = F.when(part != "", F.length(part)).otherwise(-zeros) - shift
    return F.when(text.rlike(_NUMBER), F.when((whole == "") & (part == ""), F.lit(0)).otherwise(needed))


def number_digits(text: Column) -> tuple[Column, Column]:
    """Digits before and after the point that the number in ``text`` needs; null where it is no number."""
    # Most numbers have no sign but minus, no needless zeros and no power: their digits are counted without taking them apart.
    usual, dot, size = text.rlike(_USUAL), F.instr(text, "."), F.length(text)
    before = F.when(text.startswith("0") | text.startswith("-0"), F.lit(0)).otherwise(
        F.when(dot > 0, dot - 1).otherwise(size) - text.startswith("-").cast("int"))
    whole, part, power = (F.regexp_extract(text, _NUMBER, k) for k in (1, 2, 3))
    shift = F.when(power == "", F.lit(0)).otherwise(power.try_cast("int"))
    lead = F.when(whole != "", F.length(whole)).otherwise(F.length(F.regexp_replace(part, "^0+", "")) - F.length(part))
    scale = F.greatest(_places(text), F.lit(0))
    return (F.when(usual, before).otherwise(F.when(scale.isNotNull(), F.greatest(lead + shift, F.lit(0)))),
            F.when(usual, F.when(dot > 0, size - dot).otherwise(F.lit(0))).otherwise(scale))


def _text_as(text: Column, value: Column, to: DataType) -> Column:
    """Whether ``value`` is the whole of what ``text`` says."""
    if isinstance(to, (IntegralType, DecimalType)):
        scale = to.scale if isinstance(to, DecimalType) else 0
        # A number written with no more places than these needs no more; only other texts are taken apart.
        return text.rlike(r"^[+-]?[0-9]+(?:\.[0-9]{0,%d})?\z" % scale) | (_places(text) <= scale)
    if isinstance(to, (DoubleType, FloatType)):
        own = _digits(text)
        normal = 2.3e-308 if isinstance(to, DoubleType) else 1.2e-38
        few = (F.length(own) <= (15 if isinstance(to, DoubleType) else 6)) & ((F.abs(value) >= normal) | (own == ""))
        finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
        named = text.rlike(r"(?i)^\s*(nan|[+-]?inf(inity)?)\s*$")
        return F.when(finite, few | (own == _digits(value.cast("string")))).otherwise(named)
    if isinstance(to, BooleanType):
        return F.lower(F.trim(text)) == value.cast("string")
    if isinstance(to, DateType):
        zone = F.length(F.trim(text)) > 10
        return F.when(zone & text.rlike(_ZONE), False).otherwise(
            text.try_cast(TimestampNTZType()).eqNullSafe(value.cast(TimestampNTZType())) & ~text.rlike(_AFTER_MICROS))
    if isinstance(to, TimestampNTZType):
        return ~text.rlike(_AFTER_MICROS) & ~((F.length(F.trim(text)) > 10) & text.rlike(_ZONE))
    if isinstance(to, TimestampType):
        return ~text.rlike(_AFTER_MICROS)
    return F.lit(True)


def converted(at: Column, own: DataType, to: DataType) -> tuple[Column, Column]:
    """``at`` (of type ``own``) as ``to``, and whether something of it is lost by that (never null)."""
    if own == to:
        return at, F.lit(False)
    if isinstance(own, ArrayType) and isinstance(to, ArrayType):
        value = F.transform(at, lambda x: converted(x, own.elementType, to.elementType)[0])
        return value, F.coalesce(F.exists(at, lambda x: converted(x, own.elementType, to.elementType)[1]), F.lit(False))
    if isinstance(own, MapType) and isinstance(to, MapType) and own.keyType == to.keyType:
        value = F.transform_values(at, lambda _, v: converted(v, own.valueType, to.valueType)[0])
        return value, F.coalesce(F.exists(F.map_values(at), lambda v: converted(v, own.valueType, to.valueType)[1]), F.lit(False))
    if isinstance(own, StructType) and isinstance(to, StructType):
        have = {f.name.lower(): f for f in own.fields}
        fields, lost = [], F.lit(False)
        for f in to.fields:
            mine = have.pop(f.name.lower(), None)
            if mine is None:
                fields.append(F.lit(None).cast(f.dataType).alias(f.name))
                continue
            value, gone = converted(at.getField(mine.name), mine.dataType, f.dataType)
            fields.append(value.alias(f.name))
            lost = lost | gone
        for f in have.values():
            lost = lost | at.getField(f.name).isNotNull()
        return F.when(at.isNotNull(), F.struct(*fields)), F.coalesce(lost, F.lit(False))
    if isinstance(own, _NESTED) or isinstance(to, _NESTED) or not _castable(own, to):
        return F.lit(None).cast(to), at.isNotNull()
    value = at.try_cast(to)
    if isinstance(own, StringType):
        same = _text_as(at, value, to)
    elif isinstance(to, StringType):
        # A cast takes any bytes for text.
        same = F.is_valid_utf8(value) if isinstance(own, BinaryType) else F.lit(True)
    elif isinstance(own, IntegralType) and isinstance(to, _FLOATING):
        # A cast to an integer type stops at its largest value, so 2^63 would come back as 2^63 - 1. (Not by way of
        # a double: the optimizer takes integer to float to double for integer to double.)
        same = value.try_cast("bigint").eqNullSafe(at.cast("bigint")) & (value < F.lit(2.0 ** 63))
    elif isinstance(own, _FLOATING) and isinstance(to, IntegralType):
        same = value.cast("double").eqNullSafe(at.cast("double")) & (at < F.lit(2.0 ** 63))
    else:
        same = value.try_cast(own).eqNullSafe(at) if _castable(to, own) else F.lit(False)
    return value, at.isNotNull() & (value.isNull() | ~F.coalesce(same, F.lit(False)))
