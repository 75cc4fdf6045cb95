"""Incremental combine: a re-run takes only new files, exactly once."""

from pyspark.sql import functions as F

from conftest import SMALL
from tessera.streaming.incremental import run_once


def test_incremental_runs(spark, tmp_base):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    orders.where("o_orderstatus = 'P'").write.parquet(f"{tmp_base}/in/a_order/batch 1")
    orders.where("o_orderstatus = 'F'").drop("o_totalprice").write.parquet(f"{tmp_base}/in/b_order/b1")
    roots = {"a_order": f"{tmp_base}/in/a_order", "b_order": f"{tmp_base}/in/b_order"}
    sink = f"{tmp_base}/out"
    run_once(spark, roots, sink, partition_levels=1)
    first = spark.read.parquet(sink)
    assert first.count() == orders.where("o_orderstatus IN ('P', 'F')").count()
    assert first.where("source_table = 'b_order'").where(F.col("o_totalprice").isNotNull()).count() == 0
    run_once(spark, roots, sink, partition_levels=1)           # nothing new: nothing added
    assert spark.read.parquet(sink).count() == first.count()
    orders.where("o_orderstatus = 'O'").drop("o_totalprice").write.parquet(f"{tmp_base}/in/b_order/b2")
    run_once(spark, roots, sink, partition_levels=1)
    out = spark.read.parquet(sink)
    assert out.count() == orders.count()
    assert {r[0] for r in out.select("partition_0").distinct().collect()} == {"batch 1", "b1", "b2"}


def test_incremental_combine_with_normalisation(spark, tmp_base):
    from tessera.functions.normalize import normalize_column
    from tessera.functions.phpserial import php_to_json
    spark.createDataFrame([(1, 'a:1:{s:1:"k";i:5;}'), (2, "plain")], "id int, value string").write.parquet(
        f"{tmp_base}/in/a_conf")
    spark.createDataFrame([(3, "N;"), (4, "d:0.5;")], "id int, value string").write.parquet(f"{tmp_base}/in/b_conf")
    roots = {n: f"{tmp_base}/in/{n}" for n in ["a_conf", "b_conf"]}
    run_once(spark, roots, f"{tmp_base}/out", transform=lambda df: normalize_column(df, "value"))
    got = {r.id: r.value for r in spark.read.parquet(f"{tmp_base}/out").collect()}
    assert got == {1: php_to_json('a:1:{s:1:"k";i:5;}'), 2: "plain", 3: "null", 4: "0.5"}


def test_available_now_with_file_rate_limit(spark, tmp_base):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    for s in "PFO":
        orders.where(f"o_orderstatus = '{s}'").coalesce(1).write.parquet(f"{tmp_base}/in/x_order/{s}")
    run_once(spark, {"x_order": f"{tmp_base}/in/x_order"}, f"{tmp_base}/out", max_files_per_trigger=1)
    assert spark.read.parquet(f"{tmp_base}/out").count() == orders.count()


def _ids(spark, sink):
    from tessera.streaming.incremental import read_combined
    return sorted((r["source_table"], r["id"]) for r in read_combined(spark, sink).select("source_table", "id").collect())


def test_tables_added_reordered_old_files_and_new_columns(spark, tmp_base):
    import glob
    import os

    from tessera.streaming.incremental import read_combined
    root = lambda n: f"{tmp_base}/in/{n}"
    for k, n in enumerate(("a_order", "b_order")):
        spark.createDataFrame([(k,)], "id int").write.parquet(f"{root(n)}/b1")
    sink = f"{tmp_base}/out"
    run_once(spark, {n: root(n) for n in ("a_order", "b_order")}, sink)
    run_once(spark, {n: root(n) for n in ("b_order", "a_order")}, sink)
    assert _ids(spark, sink) == [("a_order", 0), ("b_order", 1)]
    spark.createDataFrame([(2, "x")], "id int, late string").write.parquet(f"{root('c_order')}/b1")
    spark.createDataFrame([(3, "y")], "id int, late string").write.parquet(f"{root('a_order')}/b2")
    for f in glob.glob(f"{root('a_order')}/b2/*.parquet"):
        os.utime(f, (1, 1))  # a file with a very old date
    run_once(spark, {n: root(n) for n in ("c_order", "b_order", "a_order")}, sink)
    assert _ids(spark, sink) == [("a_order", 0), ("a_order", 3), ("b_order", 1), ("c_order", 2)]
    assert {r["late"] for r in read_combined(spark, sink).collect()} == {None, "x", "y"}


def test_foreign_checkpoint_and_unreadable_type_are_refused(spark, tmp_base):
    import pytest

    from tessera.operators.align import SchemaConflict
    spark.createDataFrame([(1,)], "id int").write.parquet(f"{tmp_base}/in/a_order/b1")
    roots, sink = {"a_order": f"{tmp_base}/in/a_order"}, f"{tmp_base}/out"
    run_once(spark, roots, sink)
    with pytest.raises(ValueError, match="another checkpoint"):
        run_once(spark, roots, sink, checkpoint=f"{tmp_base}/elsewhere")
    with pytest.raises(ValueError, match="no longer"):
        run_once(spark, roots, f"{tmp_base}/other", checkpoint=f"{sink}/_checkpoint")
    spark.createDataFrame([("x",)], "id string").write.parquet(f"{tmp_base}/in/a_order/b2")
    with pytest.raises(SchemaConflict):
        run_once(spark, roots, sink)
