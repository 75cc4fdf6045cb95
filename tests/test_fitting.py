"""Conversions that change nothing, or say so."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tessera.operators.fitting import converted

T = dt.datetime


@pytest.mark.parametrize(("own", "to", "fits", "lost"), [
    ("string", "decimal(10,2)", ["1.2", "1.20", " 7 ", "-0.50", "1200e-2", "1.239e1", "000.10", "0.000"], ["1.239", "1e-3", "x", "", "12345678901", "1.2.3"]),
    ("string", "int", ["5", "-7", " 8 "], ["5.5", "x", "3000000000", ""]),
    ("string", "double", ["0.1", "1e5", "100", "9007199254740992", "0.30000000000000004", "NaN", "-Infinity", "0", "-0.0", "1.50"],
     ["9007199254740993", "1e999", "1e-999", "x", "0.1000000000000000055511151231257827"]),
    ("string", "float", ["0.5", "16777216", "1.1"], ["16777217", "1.123456789"]),
    ("string", "boolean", ["true", "FALSE"], ["yes", "1", "x"]),
    ("string", "date", ["2024-01-01", "2024-01-01 00:00:00"], ["2024-01-01 23:59:59", "2024-01-01T00:00:00Z", "2024-02-30", "x"]),
    ("string", "timestamp_ntz", ["2024-01-01 10:00:00", "2024-01-01", "2024-01-01 10:00:00.123456000"], ["2024-01-01 10:00:00.1234567", "2024-01-01 10:00:00+02:00", "x"]),
    ("bigint", "double", [1, 2 ** 53], [2 ** 53 + 1, 2 ** 63 - 1]),
    ("bigint", "int", [1, -5], [2 ** 40]),
    ("double", "float", [0.5, float("inf"), 3.0], [0.1]),
    ("double", "decimal(10,2)", [0.1, 2.0], [0.1 + 0.2, 1.239, float("nan")]),
    ("double", "int", [9.0], [9.5, float("inf")]),
    ("double", "bigint", [2.0 ** 62, -2.0 ** 63], [2.0 ** 63]),
    ("float", "int", [5.0], [2.0 ** 31]),
    ("int", "float", [2 ** 24], [2 ** 24 + 1, 2 ** 31 - 1]),
    ("decimal(10,2)", "decimal(10,1)", [Decimal("1.50")], [Decimal("1.55")]),
    ("timestamp_ntz", "date", [T(2024, 1, 1)], [T(2024, 1, 1, 23, 59, 59)]),
    ("date", "timestamp_ntz", [dt.date(2024, 1, 1)], []),
    ("int", "string", [5], []),
    ("binary", "string", [bytearray(b"abc")], [bytearray(b"\xff\xfe")]),
    ("int", "boolean", [0, 1], [2]),
    ("array<string>", "array<int>", [["1", None], []], [["1", "x"], ["1.5"]]),
    ("map<string,double>", "map<string,int>", [{"a": 1.0}], [{"a": 1.5}]),
    ("struct<a:string,b:int>", "struct<b:bigint>", [(None, 1)], [("x", 1)]),
    ("struct<a:int>", "string", [], [(1,)]),
    ("string", "array<int>", [], ["[1]"]),
])
def test_what_fits_and_what_is_lost(spark, own, to, fits, lost):
    values = [*((v, False) for v in fits), *((v, True) for v in lost), (None, False)]
    df = spark.createDataFrame(values, f"v {own}, gone boolean")
    value, gone = converted(F.col("v"), DataType.fromDDL(own), DataType.fromDDL(to))
    out = df.select("v", "gone", value.alias("value"), gone.alias("found"))
    assert out.schema["value"].dataType.simpleString() == DataType.fromDDL(to).simpleString()
    for r in out.collect():
        assert r["found"] == r["gone"], r
        assert r["gone"] or (r["value"] is None) == (r["v"] is None), r


def test_usual_and_unusual_numbers_count_the_same_digits(spark):
    from pyspark.sql import functions as F
    from pyspark.sql.types import DecimalType, LongType, StringType

    from tessera.operators.fitting import converted, number_digits
    # (text, digits before the point, digits after it, fits bigint, fits decimal(6,2))
    cases = [("0", 0, 0, True, True), ("-0", 0, 0, True, True), ("7", 1, 0, True, True), ("-120", 3, 0, True, True), ("120.5", 3, 1, False, True),
             ("-0.025", 0, 3, False, False), ("120.50", 3, 1, False, True), ("+12", 2, 0, True, True), ("007", 1, 0, True, True),
             ("1e2", 3, 0, False, True), ("12.", 2, 0, False, True), (" 12 ", 2, 0, True, True), ("12.345", 2, 3, False, False),
             ("12.340", 2, 2, False, True)]
    df = spark.createDataFrame([(c[0],) for c in cases], "t string")
    lost = [~converted(F.col("t"), StringType(), to)[1] for to in (LongType(), DecimalType(6, 2))]
    got = {r[0]: tuple(r)[1:] for r in df.select("t", *number_digits(F.col("t")), *lost).collect()}
    assert got == {c[0]: c[1:] for c in cases}
