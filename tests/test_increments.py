"""Incremental snapshots: changed files only, exact restores, references that keep blobs alive."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from tessera.operators.increments import drop_snapshot, list_snapshots, restore_files, sweep_blobs, take_snapshot


def blobs(base):
    at = f"{base.removeprefix('file:')}/blobs"
    return {f: os.path.getsize(f"{at}/{f}") for f in os.listdir(at) if not f.startswith(".")}


def test_changed_files_only(spark, tmp_base):
    c = spark.read.parquet(f"{SMALL}/customer.parquet")
    src, repo = f"{tmp_base}/src", f"{tmp_base}/repo"
    c.coalesce(1).write.partitionBy("c_mktsegment").parquet(f"{src}/customer")
    c.limit(5).coalesce(1).write.parquet(f"{src}/few/un named/é 1")
    roots = {"customer": f"{src}/customer", "few": f"{src}/few"}
    first = take_snapshot(spark, roots, repo, "one")
    assert (first.files, first.copied) == (6, 6)
    was, had = rows(spark.read.parquet(roots["customer"])), blobs(repo)
    again = take_snapshot(spark, roots, repo, "same")
    assert (again.files, again.copied) == (6, 0) and blobs(repo) == had
    one = c.where("c_mktsegment = 'BUILDING'").withColumn("c_name", F.lit("changed")).drop("c_mktsegment")
    one.coalesce(1).write.mode("overwrite").parquet(f"{src}/customer/c_mktsegment=BUILDING")
    second = take_snapshot(spark, roots, repo, "two")
    assert (second.files, second.copied) == (6, 1) and len(blobs(repo)) == len(had) + 1
    # The source may go: a snapshot holds all it needs.
    assert rows(restore_files(spark, repo, "one", f"{tmp_base}/r1")["customer"]) == was
    drop_snapshot(spark, repo, "one")
    assert sweep_blobs(spark, repo) == 0                      # "same" has them all
    drop_snapshot(spark, repo, "same")
    assert sweep_blobs(spark, repo) == 1 and sweep_blobs(spark, repo) == 0
    back = restore_files(spark, repo, "two", f"{tmp_base}/r2")
    assert rows(back["customer"]) == rows(spark.read.parquet(roots["customer"])) and rows(back["few"]) == rows(c.limit(5))
    assert os.path.isdir(f"{tmp_base.removeprefix('file:')}/r2/few/un named/é 1")
    assert [r["snapshot"] for r in list_snapshots(spark, repo).select("snapshot").distinct().collect()] == ["two"]
    with pytest.raises(FileNotFoundError):
        restore_files(spark, repo, "one", f"{tmp_base}/r3")
    with pytest.raises(FileExistsError):
        restore_files(spark, repo, "two", f"{tmp_base}/r2")


def test_equal_contents_are_one_blob_and_patterns_choose(spark, tmp_base):
    spark.range(3).coalesce(1).write.parquet(f"{tmp_base}/a")
    spark.range(3).coalesce(1).write.parquet(f"{tmp_base}/b")
    spark.range(0).write.parquet(f"{tmp_base}/c")
    repo = f"{tmp_base}/repo"
    take_snapshot(spark, {n: f"{tmp_base}/{n}" for n in "abc"}, repo, "s")
    with pytest.raises(FileExistsError):
        take_snapshot(spark, {"a": f"{tmp_base}/a"}, repo, "s")
    back = restore_files(spark, repo, "s", f"{tmp_base}/out", "-a")
    assert sorted(back) == ["b", "c"] and rows(back["b"]) == [(0,), (1,), (2,)] and back["c"].count() == 0
    equal = {open(f"{tmp_base.removeprefix('file:')}/{n}/{f}", "rb").read() for n in "ab" for f in os.listdir(f"{tmp_base.removeprefix('file:')}/{n}") if f.startswith("part")}
    assert len([b for b in blobs(repo)]) <= len(equal) + 1


def test_an_interrupted_snapshot_is_taken_again(spark, tmp_base):
    spark.range(30).repartition(3).write.parquet(f"{tmp_base}/t")
    repo = f"{tmp_base}/repo"
    take_snapshot(spark, {"t": f"{tmp_base}/t"}, repo, "s")
    local = repo.removeprefix("file:")
    os.rename(f"{local}/snapshots/s/files", f"{local}/snapshots/s/half")    # as if it had died before the last step
    open(f"{local}/blobs/.partial-x", "w").close()
    assert take_snapshot(spark, {"t": f"{tmp_base}/t"}, repo, "s").copied == 0    # contents that are there are kept
    assert sweep_blobs(spark, repo) == 1
    assert restore_files(spark, repo, "s", f"{tmp_base}/r")["t"].count() == 30
