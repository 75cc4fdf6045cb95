"""Upsert, duplicate keys, rejects, counts, snapshot/restore patterns."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators.copying import DuplicateKeys, copy_table, latest_per_key, upsert
from tessera.operators.snapshot import pattern_filter, restore_snapshot, snapshot_tables
from tessera.sinks.tables import ensure_database


def test_upsert_semantics(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    src = spark.createDataFrame([(2, "B", 1), (3, "C", 1)], "k int, v string, extra int")
    out = upsert(tgt, src, "k")
    assert out.columns == ["k", "v", "extra"]
    assert rows(out) == [(1, "a", None), (2, "B", 1), (3, "C", 1), (None, "n", None)]


def test_upsert_duplicate_source_keys(spark):
    tgt = spark.createDataFrame([(1, "a", 0)], "k int, v string, ts int")
    src = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, v string, ts int")
    with pytest.raises(DuplicateKeys):
        upsert(tgt, src, "k")
    assert rows(upsert(tgt, src, "k", order_by="ts")) == [(1, "y", 2)]


def test_latest_per_key_hot_key(spark):
    # One key holds most rows: partial aggregation keeps the shuffle small.
    df = spark.range(0, 20000).select(F.when(F.col("id") < 15000, 0).otherwise(F.col("id")).alias("k"),
                                      F.col("id").alias("ts"))
    out = latest_per_key(df, "k", "ts")
    assert out.count() == 5001
    assert out.where("k = 0").first().ts == 14999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_copy_table_rejects_and_counts(spark, tmp_base):
    ensure_database(spark, "t_copy")
    name = "t_copy.c_" + tmp_base.rsplit("-", 1)[-1]
    src = spark.createDataFrame([(1, "10"), (None, "5"), (3, "x")], "k int, price string")
    res = copy_table(spark, src, name, "k", checks={"bad price": F.col("price").try_cast("int").isNull()},
                     location=tmp_base)
    assert (res.copied, res.rejected) == (1, 2)
    assert rows(spark.table(name)) == [(1, "10")]
    assert rows(spark.read.parquet(res.rejects_path)) == [(3, "x", "bad price"), (None, "5", "missing key k")]
    # A second copy upserts into the same table through a new generation.
    res2 = copy_table(spark, spark.createDataFrame([(1, "11"), (4, "1")], "k int, price string"), name, "k",
                      location=tmp_base)
    assert res2.path != res.path
    assert (res2.copied, res2.rejected) == (2, 0)
    assert spark.read.parquet(res2.rejects_path).count() == 0
    assert rows(spark.table(name)) == [(1, "11"), (4, "1")]


def test_pattern_filter(spark):
    df = spark.createDataFrame([(n,) for n in [".system_1", ".security", ".audit-x",
                                               "my-index", "other"]], "table_name string")
    def pick(p):
        return sorted(r[0] for r in df.where(pattern_filter(p)).collect())
    assert pick("-.system*,-.security,-.audit-*") == ["my-index", "other"]
    assert pick("my-index") == ["my-index"]
    assert pick("*") == sorted(r[0] for r in df.collect())
    assert pick("my*,-my-index") == []


def test_snapshot_restore(spark, tmp_base):
    t = {"a": spark.range(5).toDF("x"), "b": spark.range(3).toDF("y")}
    manifest = snapshot_tables(spark, t, tmp_base, "s1")
    assert {r.table_name: r.n_rows for r in manifest.collect()} == {"a": 5, "b": 3}
    restored = restore_snapshot(spark, tmp_base, "s1", "-b")
    assert list(restored) == ["a"] and restored["a"].count() == 5
    with pytest.raises(Exception):
        snapshot_tables(spark, t, tmp_base, "s1")


def test_copy_duplicate_source_keys_leave_table_unchanged(spark, tmp_base):
    ensure_database(spark, "t_copy")
    name = "t_copy.d_" + tmp_base.rsplit("-", 1)[-1]
    copy_table(spark, spark.createDataFrame([(1, "a")], "k int, v string"), name, "k", location=tmp_base)
    with pytest.raises(DuplicateKeys):
        copy_table(spark, spark.createDataFrame([(2, "b"), (2, "c")], "k int, v string"), name, "k",
                   location=tmp_base)
    assert rows(spark.table(name)) == [(1, "a")]
    with pytest.raises(DuplicateKeys):
        copy_table(spark, spark.createDataFrame([(2, "b"), (2, "c")], "k int, v string"), name + "_new", "k",
                   location=tmp_base + "_new")
    res = copy_table(spark, spark.createDataFrame([(2, "b", 1), (2, "c", 2)], "k int, v string, ts int"),
                     name, "k", order_by="ts", location=tmp_base)
    assert res.copied == 2
    assert rows(spark.table(name)) == [(1, "a", None), (2, "c", 2)]


def test_upserted_keys_unique_and_restore_equals_source(spark, tmp_base):
    ensure_database(spark, "t_copy")
    name = "t_copy.u_" + tmp_base.rsplit("-", 1)[-1]
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    copy_table(spark, c.where("c_mktsegment <> 'BUILDING'"), name, "c_custkey", location=tmp_base)
    copy_table(spark, c.where("c_mktsegment IN ('BUILDING', 'MACHINERY')"), name, "c_custkey", location=tmp_base)
    out = spark.table(name)
    assert out.count() == out.select("c_custkey").distinct().count() == c.count()
    snapshot_tables(spark, {"customer": c}, tmp_base, "s")
    assert rows(restore_snapshot(spark, tmp_base, "s", "cust*")["customer"]) == rows(c)


def test_bucketed_target_is_never_shuffled(spark, tmp_base):
    ensure_database(spark, "t_copy")
    name = "t_copy.b_" + tmp_base.rsplit("-", 1)[-1]
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    copy_table(spark, c.where("c_mktsegment <> 'BUILDING'"), name, "c_custkey", location=tmp_base, buckets=n)
    src = c.where("c_mktsegment IN ('BUILDING', 'MACHINERY')").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    from tessera.session import RUNTIME_BROADCAST_ONLY, scoped_conf
    with scoped_conf(spark, RUNTIME_BROADCAST_ONLY):   # the settings copy_table writes under
        plan = upsert(spark.table(name), src, "c_custkey", check_unique=False)._jdf.queryExecution().executedPlan()
    scan_side = plan.toString().split("LeftAnti")[1].split("Exchange")[0]
    assert "Bucketed: true" in scan_side      # the target reaches the join without an exchange
    copy_table(spark, src, name, "c_custkey", location=tmp_base)
    out = spark.table(name)
    assert out.count() == out.select("c_custkey").distinct().count() == c.count()
    assert rows(out.where("c_mktsegment = 'MACHINERY'")) == rows(
        src.where("c_mktsegment = 'MACHINERY'"))
    desc = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert desc.get("Num Buckets") == str(n)


def test_snapshot_resumes_after_partial_run(spark, tmp_base):
    t = {"a": spark.range(5).toDF("x"), "b": spark.range(3).toDF("y")}
    # A previous run died after copying "a" only (and left debris for "b").
    t["a"].write.parquet(f"{tmp_base}/s2/a")
    spark.range(1).toDF("junk").write.parquet(f"{tmp_base}/s2/b/_temporary/0")
    manifest = snapshot_tables(spark, t, tmp_base, "s2")
    assert {r.table_name: r.n_rows for r in manifest.collect()} == {"a": 5, "b": 3}
    assert rows(restore_snapshot(spark, tmp_base, "s2")["b"]) == rows(t["b"])


def test_latest_per_key_with_null_order(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 5), (2, "c", None)], "k int, v string, ts int")
    assert rows(latest_per_key(df, "k", "ts")) == [(1, "b", 5), (2, "c", None)]


def test_copy_all_tables_with_order_by(spark, tmp_base):
    from tessera.operators.copying import copy_all_tables
    db = "t_all_" + tmp_base.rsplit("-", 1)[-1]
    ensure_database(spark, db)
    dup = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, v string, ts int")
    uniq = spark.createDataFrame([(5, "x")], "k int, v string")
    report, _ = copy_all_tables(spark, {"d": (dup, "k", "ts"), "u": (uniq, "k")}, db)
    assert {r.table_name: (r.copied, r.rejected) for r in report.collect()} == {"d": (2, 0), "u": (1, 0)}
    assert rows(spark.table(f"{db}.d")) == [(1, "b", 2)]


def _target(spark, name):
    return f"tessera_scratch.{name}_{__import__('uuid').uuid4().hex[:8]}"


def test_copy_into_an_empty_table_and_from_an_empty_source(spark, tmp_base):
    from tessera.sinks.tables import ensure_database
    ensure_database(spark, "tessera_scratch")
    name = _target(spark, "empty")
    empty = spark.createDataFrame([], "k int, v string")
    assert copy_table(spark, empty, name, "k", location=tmp_base).copied == 0
    some = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert copy_table(spark, some, name, "k", location=tmp_base).copied == 2
    result = copy_table(spark, empty, name, "k", location=tmp_base)
    assert (result.copied, result.rejected) == (0, 0) and rows(spark.table(name)) == [(1, "a"), (2, None)]
    result = copy_table(spark, spark.createDataFrame([(None, "x")], "k int, v string"), name, "k", location=tmp_base)
    assert (result.copied, result.rejected) == (0, 1) and spark.table(name).count() == 2


def test_values_that_do_not_fit_the_target_are_rejected_one_by_one(spark, tmp_base):
    from tessera.sinks.tables import ensure_database
    ensure_database(spark, "tessera_scratch")
    name = _target(spark, "drift")
    copy_table(spark, spark.createDataFrame([(0, 7, 1.5)], "k int, v int, d float"), name, "k", location=tmp_base)
    for rows_in, schema in (([(1, 8, 0.25), (2, 2 ** 40, 0.5)], "k bigint, v bigint, d double"),
                            ([(3, 9.0, 1.0), (4, 9.5, 1.0)], "k int, v double, d double"),
                            ([(5, "10", 1.0), (6, "x", 1.0), (7, None, 1.0)], "k int, v string, d double")):
        copy_table(spark, spark.createDataFrame(rows_in, schema), name, "k", location=tmp_base)
    assert [(r["k"], r["v"]) for r in spark.table(name).orderBy("k").collect()] == [(0, 7), (1, 8), (3, 9), (5, 10), (7, None)]
    result = copy_table(spark, spark.createDataFrame([("y", 1, 1.0)], "k string, v int, d double"), name, "k", location=tmp_base)
    assert rows(spark.read.parquet(result.rejects_path)) == [("y", 1, 1.0, "k does not fit int")]
