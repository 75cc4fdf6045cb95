"""Sinks: CTAS failure on re-create, file-count bounds, JSON nulls, manifests."""

import glob

import pytest
from pyspark.errors import AnalysisException

from conftest import SMALL, rows
from tessera.sinks.files import compact_write, write_json, write_manifest
from tessera.sinks.tables import create_table_as, ensure_database
from tessera.sources.files import read_lines


def _parquet_files(path):
    return glob.glob(path.replace("file:", "") + "/*.parquet")


def test_ctas_twice_fails(spark, tmp_base):
    ensure_database(spark, "t_sinks")
    df = spark.read.parquet(f"{SMALL}/region.parquet")
    name = "t_sinks.r_" + tmp_base.rsplit("-", 1)[-1]
    out = create_table_as(df, name, path=f"{tmp_base}/r")
    assert rows(out) == rows(df)
    with pytest.raises(AnalysisException):
        create_table_as(df, name, path=f"{tmp_base}/r2")


@pytest.mark.parametrize("shuffle", [True, False])
def test_compact_write_file_count(spark, tmp_base, shuffle):
    df = spark.read.parquet(f"{SMALL}/lineitem.parquet").repartition(24)
    compact_write(df, f"{tmp_base}/o", num_files=10, shuffle=shuffle)
    assert len(_parquet_files(f"{tmp_base}/o")) == 10
    assert spark.read.parquet(f"{tmp_base}/o").count() == df.count()


def test_compact_write_by_size(spark, tmp_base):
    df = spark.read.parquet(f"{SMALL}/lineitem.parquet").repartition(24)
    compact_write(df, f"{tmp_base}/o", target_file_bytes=64 << 20)
    assert 1 <= len(_parquet_files(f"{tmp_base}/o")) < 24
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") != str(64 << 20)


def test_json_null_fields(spark, tmp_base):
    df = spark.createDataFrame([(1, None)], "id int, v string")
    write_json(df, f"{tmp_base}/drop")
    write_json(df, f"{tmp_base}/keep", ignore_null_fields=False)
    assert spark.read.text(f"{tmp_base}/drop").first()[0] == '{"id":1}'
    assert spark.read.text(f"{tmp_base}/keep").first()[0] == '{"id":1,"v":null}'


def test_manifest_roundtrip(spark, tmp_base):
    df = spark.createDataFrame([("a/b c",), ("d",)], "key string")
    write_manifest(df, f"{tmp_base}/m")
    assert rows(read_lines(spark, f"{tmp_base}/m")) == [("a/b c",), ("d",)]
