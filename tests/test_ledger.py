"""The schema ledger reads every footer once; joining schemas is an aggregate."""

import functools
import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import SMALL, rows
from tessera.operators.align import SchemaConflict, widened
from tessera.operators.lattice import join_places, joined_schema, schema_places
from tessera.sources.files import read_parquet_groups
from tessera.sources.ledger import SchemaLedger, Store, listed_by_executors, s3_options, store_of

TYPES = ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(10,2)", "decimal(38,0)", "decimal(5,5)", "string", "binary",
         "boolean", "date", "timestamp", "timestamp_ntz", "array<int>", "array<bigint>", "struct<a:int>", "struct<a:bigint,b:string>",
         "struct<a:string>", "map<string,int>", "map<string,double>", "void"]


def joined(spark, schemas):
    df = spark.createDataFrame([(i, s.json()) for i, s in enumerate(schemas)], "n int, schema string")
    return joined_schema(join_places(schema_places(df), F.col("n")).collect())


def test_joining_equals_folding_two_at_a_time(spark):
    draw = random.Random(1)
    sets = list(itertools.combinations(TYPES, 2)) + [tuple(draw.sample(TYPES, 3)) for _ in range(60)]
    # All sets in one job: a column per set.
    frames = []
    for k in range(3):
        fields = [f"c{i} {s[k]}" for i, s in enumerate(sets) if k < len(s)]
        frames.append(StructType.fromDDL(", ".join(fields)))
    got = joined(spark, frames)
    for i, s in enumerate(sets):
        types = [StructType.fromDDL(f"x {t}").fields[0].dataType for t in s]
        orders = {str(functools.reduce(lambda a, b: None if a is None else widened(a, b), p)) for p in itertools.permutations(types)}
        mine = None if f"c{i}" in got.conflicts else got.schema[f"c{i}"].dataType
        # Folding may depend on the order; the aggregate does not, and agrees with the fold wherever that is settled.
        assert str(mine) in orders and (len(orders) > 1 or {str(mine)} == orders), (s, mine, orders)


def test_order_and_case_of_columns(spark):
    a, b = StructType.fromDDL("B int, a struct<x:int>"), StructType.fromDDL("c string, b bigint, A struct<Y:date,x:smallint>")
    assert joined(spark, [a, b]).schema.simpleString() == "struct<B:bigint,a:struct<x:int,Y:date>,c:string>"


def test_only_unseen_footers_are_read(spark, tmp_base):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    roots = {"a": f"{tmp_base}/in/a", "b": f"{tmp_base}/in/b"}
    orders.select("o_orderkey", "o_custkey").repartition(3).write.parquet(f"{roots['a']}/batch 1")
    orders.selectExpr("o_orderkey", "CAST(o_custkey AS int) AS o_custkey", "o_orderstatus").repartition(2).write.parquet(f"{roots['b']}/x=1")
    ledger = SchemaLedger(spark, f"{tmp_base}/ledger")
    assert ledger.update(roots) == 5 and ledger.update(roots) == 0
    assert SchemaLedger(spark, f"{tmp_base}/ledger", listed_by_executors).update(roots) == 0   # both listings name files alike
    assert ledger.common_schema(roots).simpleString() == "struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>"
    orders.selectExpr("o_orderkey", "o_totalprice").coalesce(1).write.parquet(f"{roots['b']}/x=2")
    assert SchemaLedger(spark, f"{tmp_base}/ledger").update(roots) == 1
    assert ledger.common_schema(roots).names == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    assert {(r["table_name"], r["n_files"]) for r in ledger.schemas(roots).collect()} == {("a", 3), ("b", 2), ("b", 1)}
    # Files that are gone do not count; a replaced file is read again.
    orders.selectExpr("o_orderkey").coalesce(1).write.mode("overwrite").parquet(f"{roots['b']}/x=2")
    assert ledger.update(roots) == 1
    assert ledger.common_schema(roots).names == ["o_orderkey", "o_custkey", "o_orderstatus"]


def test_types_that_nothing_joins(spark, tmp_base):
    spark.range(3).write.parquet(f"{tmp_base}/t/one")
    spark.range(3).selectExpr("id % 2 = 0 AS id").write.parquet(f"{tmp_base}/t/two")
    spark.range(3, 5).write.mode("append").parquet(f"{tmp_base}/t/two")
    spark.range(9, 10).write.parquet(f"{tmp_base}/t/two/deep er")
    ledger = SchemaLedger(spark, f"{tmp_base}/ledger")
    roots = {"t": f"{tmp_base}/t"}
    ledger.update(roots)
    assert ledger.joined(roots).conflicts == {"id": ["boolean", "integer"]}
    with pytest.raises(SchemaConflict):
        ledger.common_schema(roots)
    groups = {df.schema.simpleString(): rows(df) for df in read_parquet_groups(spark, f"{tmp_base}/t")}
    assert groups["struct<id:boolean>"] == rows(spark.range(3).selectExpr("id % 2 = 0"))
    assert groups["struct<id:bigint>"] == rows(spark.createDataFrame([(i,) for i in (0, 1, 2, 3, 4, 9)], "id long"))
    places = [p for _, group in ledger.groups(f"{tmp_base}/t") for p in group]
    assert sum(not p.endswith(".parquet") for p in places) == 2   # ``one`` and ``deep er`` by folder, ``two`` by file


def test_stores_that_only_spark_lists(spark, tmp_base):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.ledger.link./in", tmp_base if tmp_base.startswith("file:") else f"file://{tmp_base}")
    spark.range(4).repartition(2).write.parquet(f"{tmp_base}/v/some where")
    root = "viewfs://ledger/in/v"
    assert store_of(spark, root).scheme == "file"
    ledger = SchemaLedger(spark, f"{tmp_base}/ledger")
    assert ledger.update({"v": root}) == 2
    assert ledger.common_schema({"v": root}).simpleString() == "struct<id:bigint>"


def test_contents_are_read_where_pyarrow_cannot(spark, tmp_base, monkeypatch):
    from tessera.sources import ledger as L
    spark.range(4).repartition(2).write.parquet(f"{tmp_base}/c")
    monkeypatch.setattr(L, "store_of", lambda *_: None)
    ledger = SchemaLedger(spark, f"{tmp_base}/ledger")
    assert ledger.update({"c": f"{tmp_base}/c"}) == 2 and ledger.common_schema({"c": f"{tmp_base}/c"}).names == ["id"]


def test_s3_paths_and_settings():
    store = Store("s3a://bkt/db", "s3a://bkt/db", "s3", {})
    assert store.place("s3a://bkt/db/t/part 1.parquet") == "bkt/db/t/part 1.parquet"
    conf = {"fs.s3a.access.key": "k", "fs.s3a.secret.key": "s", "fs.s3a.endpoint": "http://h:9000"}
    assert s3_options(conf.get) == {"access_key": "k", "secret_key": "s", "endpoint_override": "http://h:9000", "scheme": "http"}


def test_an_empty_root(spark, tmp_base):
    spark.range(1).limit(0).write.parquet(f"{tmp_base}/e")
    ledger = SchemaLedger(spark, f"{tmp_base}/ledger")
    ledger.update({"e": f"{tmp_base}/e"})
    assert ledger.common_schema({"e": f"{tmp_base}/e"}).names == ["id"]
