"""Keyed tables: puts touch only the buckets of their keys."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from tessera.operators.copying import DuplicateKeys
from tessera.operators.indexes import IndexSpec, index_projection
from tessera.operators.keyed import (_bucket_locations, copy_keyed, create_keyed_index, create_keyed_table, keyed_table, read_keyed,
                                     rewrite_buckets, sweep)
from tessera.sinks.tables import ensure_database


@pytest.fixture()
def name(spark, tmp_base):
    ensure_database(spark, "t_keyed")
    return "t_keyed.k_" + tmp_base.rsplit("-", 1)[-1]


def files(base):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(base) for f in fs if f.endswith(".parquet")}


def test_a_put_writes_the_touched_buckets_alone(spark, tmp_base, name):
    c = spark.read.parquet(f"{SMALL}/customer.parquet")
    first = copy_keyed(spark, c, name, "c_custkey", buckets=32, location=tmp_base)
    assert (first.copied, first.rejected) == (c.count(), 0) and first.rewritten + first.kept == 32
    assert rows(read_keyed(spark, name)) == rows(c)
    before = files(tmp_base)
    some = c.where("c_custkey IN (3, 77)").withColumn("c_name", F.lit("changed"))
    result = copy_keyed(spark, some, name, "c_custkey")
    assert result.rewritten <= 2 and result.rewritten + result.kept == 32
    after = files(tmp_base)
    new = {f: n for f, n in after.items() if f not in before}
    assert 0 < sum(new.values()) < 0.25 * sum(before.values())
    # What was replaced is gone, what was not touched is the same file.
    assert len(after) <= len(before) + len(new) and len(set(before) & set(after)) >= len(before) - 2 * 2
    assert rows(read_keyed(spark, name)) == rows(c.where("c_custkey NOT IN (3, 77)").unionByName(some))
    assert sweep(spark, name) == 0


def test_one_bucket_is_read_for_a_key(spark, tmp_base, name):
    c = spark.read.parquet(f"{SMALL}/customer.parquet")
    copy_keyed(spark, c, name, "c_custkey", buckets=16, location=tmp_base)
    found = read_keyed(spark, name, {"c_custkey": 5})
    assert rows(found) == rows(c.where("c_custkey = 5"))
    assert len(found.inputFiles()) <= 1 or "PartitionFilters: [isnotnull(key_bucket" in found._jdf.queryExecution().toString()


def test_the_source_is_read_once(spark, tmp_base, name):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(k):
        seen.add(1)
        return k
    rows_in = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    copy_keyed(spark, rows_in, name, "k", buckets=8, location=tmp_base)
    source = spark.range(500, 1500, 1, 4).select(counted("id").alias("k"), F.col("id").alias("v"))
    copy_keyed(spark, source, name, "k")
    assert seen.value == 1000 and read_keyed(spark, name).count() == 1500


def test_rejects_duplicates_and_latest(spark, tmp_base, name):
    copy_keyed(spark, spark.createDataFrame([(1, "a", 1.5)], "k int, v string, _reason double"), name, "k", buckets=4, location=tmp_base)
    mixed = spark.createDataFrame([("1", "b", 2.0), ("x", "c", 3.0), (None, "d", 4.0), ("2", "e", 5.0)], "k string, v string, _reason double")
    result = copy_keyed(spark, mixed, name, "k")
    assert (result.copied, result.rejected) == (2, 2)
    assert rows(read_keyed(spark, name)) == [(1, "b", 2.0), (2, "e", 5.0)]
    assert rows(spark.read.parquet(result.rejects_path)) == [("x", "c", 3.0, "k does not fit int"), (None, "d", 4.0, "missing key k")]
    twice = spark.createDataFrame([(5, "b", 1.0), (5, "c", 2.0)], "k int, v string, _reason double")
    with pytest.raises(DuplicateKeys):
        copy_keyed(spark, twice, name, "k")
    assert read_keyed(spark, name).count() == 2
    copy_keyed(spark, twice, name, "k", order_by="_reason")
    assert (5, "c", 2.0) in rows(read_keyed(spark, name))
    # A column of the source alone is added, one it lacks is null.
    copy_keyed(spark, spark.createDataFrame([(9, "n")], "k int, more string"), name, "k")
    assert (9, None, None, "n") in rows(read_keyed(spark, name)) and (1, "b", 2.0, None) in rows(read_keyed(spark, name))
    assert copy_keyed(spark, spark.createDataFrame([], "k int, v string"), name, "k").rewritten == 0
    with pytest.raises(ValueError):
        copy_keyed(spark, twice, name, "v")


def test_names_and_several_keys(spark, tmp_base, name):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (2, 2, "c")], "a int, key_bucket int, writable string")
    first = copy_keyed(spark, df, name, ["a", "key_bucket"], buckets=4, location=tmp_base)
    assert (first.copied, first.rejected) == (2, 1)
    assert rows(read_keyed(spark, name)) == [(1, 2, "b"), (2, 2, "c")]
    assert keyed_table(spark, name).bucket == "key_bucket_"


def test_removing_keys_drops_empty_buckets(spark, tmp_base, name):
    schema = spark.createDataFrame([], "k int, v string").schema
    table = create_keyed_table(spark, name, schema, "k", 8, tmp_base)
    add = spark.createDataFrame([(i, str(i)) for i in range(20)], schema)
    rewrite_buckets(spark, table, add)
    rewrite_buckets(spark, table, add.limit(0), removed=add.where("k <> 7"))
    assert rows(read_keyed(spark, table)) == [(7, "7")]
    assert len(_bucket_locations(spark, table, range(8))) == 1


def test_a_copy_that_died_is_finished_by_the_next(spark, tmp_base, name, monkeypatch):
    from tessera.operators import keyed
    copy_keyed(spark, spark.range(100).selectExpr("id AS k", "'old' AS v"), name, "k", buckets=8, location=tmp_base)
    new = spark.range(50, 150).selectExpr("id AS k", "'new' AS v")
    real = keyed._repoint

    def dies(spark_, table, generation, touched):
        real(spark_, table, generation, touched[:3])
        raise RuntimeError("lost")
    monkeypatch.setattr(keyed, "_repoint", dies)
    with pytest.raises(RuntimeError):
        copy_keyed(spark, new, name, "k")
    monkeypatch.undo()
    half = read_keyed(spark, name)
    assert half.select("k").distinct().count() == half.count()   # no key twice, whatever was reached
    copy_keyed(spark, new, name, "k")
    want = [(i, "old") for i in range(50)] + [(i, "new") for i in range(50, 150)]
    assert rows(read_keyed(spark, name)) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert sweep(spark, name) > 0 and rows(read_keyed(spark, name)) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_indexes_follow_the_copy(spark, tmp_base, name):
    c = spark.read.parquet(f"{SMALL}/customer.parquet")
    copy_keyed(spark, c.where("c_mktsegment <> 'BUILDING'"), name, "c_custkey", buckets=8, location=f"{tmp_base}/t")
    specs = {name + "_n": IndexSpec("by_nation", "c_nationkey", "c_acctbal", "INCLUDE", ["c_name"]),
             name + "_s": IndexSpec("by_segment", "c_mktsegment", None, "KEYS_ONLY")}
    for index, spec in specs.items():
        create_keyed_index(spark, name, spec, index, 16, f"{tmp_base}/{spec.name}")
    change = (c.where("c_mktsegment IN ('MACHINERY', 'BUILDING')")
              .withColumn("c_nationkey", F.when(F.col("c_custkey") % 3 > 0, (F.col("c_nationkey") + 1) % 25).cast("int"))
              .withColumn("c_name", F.when(F.col("c_custkey") % 2 == 0, F.lit("x")).otherwise(F.col("c_name"))))
    copy_keyed(spark, change, name, "c_custkey", indexes=specs)
    for index, spec in specs.items():
        assert rows(read_keyed(spark, index)) == rows(index_projection(read_keyed(spark, name), spec, ["c_custkey"]))
    # A change of a column that the index does not carry leaves it alone.
    at = _bucket_locations(spark, keyed_table(spark, name + "_s"), range(16))
    copy_keyed(spark, change.withColumn("c_acctbal", F.lit(1.0)), name, "c_custkey", indexes=specs)
    assert _bucket_locations(spark, keyed_table(spark, name + "_s"), range(16)) == at
    assert rows(read_keyed(spark, name + "_n")) == rows(index_projection(read_keyed(spark, name), specs[name + "_n"], ["c_custkey"]))
