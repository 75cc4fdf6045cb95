"""Sources: packing, recursive trees, object listings, catalog enumeration, indexes."""

from pyspark.sql import functions as F

from conftest import SMALL, rows
from tessera.operators.indexes import IndexSpec, index_columns, index_projection, write_index
from tessera.sinks.tables import ensure_database
from tessera.sources.catalog import list_table_names, tables_by_suffix
from tessera.sources.files import packed_scan, read_parquet_tree
from tessera.sources.inventory import list_objects


def test_packed_scan_controls_task_count(spark, tmp_base):
    spark.read.parquet(f"{SMALL}/orders.parquet").repartition(200).write.parquet(tmp_base)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with packed_scan(spark, 1 << 20, 1 << 16):
        packed = read_parquet_tree(spark, tmp_base).rdd.getNumPartitions()
    with packed_scan(spark, 1 << 20, 4 << 20):
        one_per_file = read_parquet_tree(spark, tmp_base).rdd.getNumPartitions()
    assert packed < 20 and one_per_file == 200
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_recursive_tree(spark, tmp_base):
    df = spark.range(10)
    df.where("id < 3").write.parquet(f"{tmp_base}/a")
    df.where("id >= 3").write.parquet(f"{tmp_base}/b/c/d")
    assert read_parquet_tree(spark, tmp_base).count() == 10


def test_list_objects_reads_no_content(spark, tmp_base):
    spark.range(10).repartition(3).write.parquet(tmp_base)
    listing = list_objects(spark, tmp_base, glob="*.parquet")
    assert listing.count() == 3 and listing.columns == ["key", "size", "last_modified"]
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_catalog_enumeration(spark, tmp_base):
    ensure_database(spark, "t_cat")
    for n in ["x_order", "x_order_totals", "reorder"]:
        spark.range(2).write.option("path", f"{tmp_base}/{n}").saveAsTable(f"t_cat.{n}")
    assert sorted(list_table_names(spark, "t_cat")) == ["reorder", "x_order", "x_order_totals"]
    assert sorted(tables_by_suffix(spark, "t_cat", "order")) == ["reorder", "x_order"]


def test_index_projection_kinds(spark, tmp_base):
    df = spark.createDataFrame([(1, 10, "a", 1.0), (2, None, "b", 2.0)], "k int, h int, r string, v double")
    spec = IndexSpec("i", "h", "r", "KEYS_ONLY")
    assert index_columns(df, spec, ["k"]) == ["h", "r", "k"]
    assert rows(index_projection(df, spec, ["k"])) == [(10, "a", 1)]
    assert index_columns(df, IndexSpec("i", "h", projection="INCLUDE", include=["v"]), ["k"]) == ["h", "k", "v"]
    ensure_database(spark, "t_idx")
    name = "t_idx.i_" + tmp_base.rsplit("-", 1)[-1]
    out = write_index(df, IndexSpec("i", "h", "r"), ["k"], name, buckets=4, path=f"{tmp_base}/i")
    assert rows(out) == [(10, "a", 1, 1.0)]
    desc = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert desc.get("Num Buckets") == "4"


def test_index_write_splits_a_hot_key(spark, tmp_base):
    # A third of all rows share one hash key; REBALANCE lets AQE split that
    # bucket over several tasks (several files of one bucket id).
    import glob
    import re as _re

    from tessera.session import scoped_conf
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("h"),
        F.col("id").alias("k"), F.lit("x" * 50).alias("pad"))
    ensure_database(spark, "t_idx")
    name = "t_idx.hot_" + tmp_base.rsplit("-", 1)[-1]
    with scoped_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}):
        out = write_index(df, IndexSpec("hot", "h", projection="ALL"), ["k"], name, buckets=8, path=f"{tmp_base}/i")
    assert out.count() == 30000
    hot_bucket = spark.sql("SELECT pmod(hash(CAST(7 AS BIGINT)), 8) AS b").first().b
    files = glob.glob(f"{tmp_base}/i/*.parquet".replace("file:", ""))
    per_bucket = {}
    for f in files:
        b = int(_re.search(r"_(\d{5})(?:\.c\d+)?\.[^/]*parquet$", f).group(1))
        per_bucket[b] = per_bucket.get(b, 0) + 1
    assert per_bucket[hot_bucket] > 1


def test_overlapping_settings_are_restored(spark):
    import threading

    from tessera.session import scoped_conf
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    one_in, two_in, one_out = threading.Event(), threading.Event(), threading.Event()

    def first():
        with scoped_conf(spark, {key: "11m"}):
            one_in.set()
            two_in.wait(10)
        one_out.set()

    thread = threading.Thread(target=first)
    thread.start()
    one_in.wait(10)
    with scoped_conf(spark, {key: "12m"}):
        two_in.set()
        one_out.wait(10)
        assert spark.conf.get(key) == "12m"
    thread.join()
    assert spark.conf.get(key) == before


def test_no_local_folder_on_a_cluster(monkeypatch):
    import pytest

    from tessera.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_large_files_are_not_cut_finer_by_packing(spark, tmp_base):
    from tessera.sources.files import packed_scan, read_parquet_tree
    spark.range(2_000_000).selectExpr("id", "uuid() AS u").coalesce(1).write.parquet(tmp_base)
    plain = read_parquet_tree(spark, tmp_base).rdd.getNumPartitions()
    with packed_scan(spark, 1 << 20):
        assert read_parquet_tree(spark, tmp_base).rdd.getNumPartitions() <= plain


def test_frontier_listing_is_the_files(spark, tmp_base):
    from tessera.sources.inventory import list_objects, list_objects_frontier
    for at in ("a", "a/deep er/x=1", "b%20c/é"):
        spark.range(20).repartition(2).write.parquet(f"{tmp_base}/l/{at}")
    mine = list_objects_frontier(spark, f"{tmp_base}/l")
    assert rows(mine) == rows(list_objects(spark, f"{tmp_base}/l")) and mine.count() == 6
    assert list_objects_frontier(spark, f"{tmp_base}/l", hidden=True).where("key LIKE '%_SUCCESS'").count() == 3
    import os
    os.makedirs(f"{tmp_base.removeprefix('file:')}/empty")
    assert list_objects_frontier(spark, f"{tmp_base}/empty").count() == 0
