"""Queries for scans and sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.operators.inspect import preview
from tessera.plans.fixtures import document_files, inventory, small_files
from tessera.plans.registry import register, table
from tessera.session import scratch_path
from tessera.sinks.files import write_manifest
from tessera.sinks.tables import create_table_as, ensure_database
from tessera.sources.catalog import read_table
from tessera.sources.files import packed_scan, read_lines, read_parquet_tree
from tessera.sources.inventory import cold_object_keys, keys_by_prefix, list_objects, list_objects_frontier

SCRATCH_DB = "tessera_scratch"


def scratch_table(spark, stem: str) -> tuple[str, str]:
    """A fresh (table name, location) pair in the scratch database."""
    ensure_database(spark, SCRATCH_DB)
    name = f"{stem}_{uuid.uuid4().hex[:10]}"
    return name, scratch_path(spark, name)


@register("scan_catalog_table", "SELECT * FROM orders")
def scan_catalog_table(spark, sf_dir):
    # Register orders as a catalog table, then read it by "db"."table" name.
    name, path = scratch_table(spark, "orders")
    create_table_as(table(spark, sf_dir, "orders"), f"{SCRATCH_DB}.{name}", path=path)
    return read_table(spark, SCRATCH_DB, name)


@register("scan_parquet_recursive", "SELECT * FROM orders")
def scan_parquet_recursive(spark, sf_dir):
    # Files at two different un-named depths below one root; a plain read
    # cannot infer a schema there, the recursive read finds every file.
    root = scratch_path(spark, "nested")
    orders = table(spark, sf_dir, "orders")
    orders.where("o_orderstatus = 'P'").write.parquet(f"{root}/2024/export-a")
    orders.where("o_orderstatus <> 'P'").write.parquet(f"{root}/2025/10/export-b")
    return read_parquet_tree(spark, root)


@register("scan_small_files_packed", "SELECT * FROM orders")
def scan_small_files_packed(spark, sf_dir):
    # 200 small files, rewritten: the scan takes many of them per task.
    # The settings hold while the block runs, so the action is in it.
    out = scratch_path(spark, "packed")
    with packed_scan(spark, 16 << 20):
        read_parquet_tree(spark, small_files(spark, sf_dir)).write.parquet(out)
    return spark.read.parquet(out)


@register("cold_object_keys", """
SELECT 'docs/' || lang || '/' || doc_id || '.txt' AS key FROM documents WHERE lang = 'de'
""")
def cold_object_keys_q(spark, sf_dir):
    return cold_object_keys(spark.read.parquet(inventory(spark, sf_dir)))


@register("keys_by_prefix", """
SELECT 'docs/' || lang || '/' || doc_id || '.txt' AS key, 'STANDARD' AS storage_class,
       CAST(strlen(text) AS BIGINT) AS size
FROM documents WHERE lang = 'fr'
""")
def keys_by_prefix_q(spark, sf_dir):
    return keys_by_prefix(spark.read.parquet(inventory(spark, sf_dir)), "docs/fr/")


@register("manifest_roundtrip", """
SELECT 'docs/' || lang || '/' || doc_id || '.txt' AS key FROM documents WHERE lang = 'de'
""")
def manifest_roundtrip(spark, sf_dir):
    # Cold keys → one-key-per-line text manifest → read back line by line.
    path = scratch_path(spark, "manifest")
    write_manifest(cold_object_keys(spark.read.parquet(inventory(spark, sf_dir))), path)
    return read_lines(spark, path, "key")


@register("preview_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def preview_limit(spark, sf_dir):
    return preview(table(spark, sf_dir, "orders"), 5, order_by=["o_orderkey"])


@register("list_objects_bytes", """
SELECT lang, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY lang
""")
def list_objects_bytes(spark, sf_dir):
    # No inventory: list the objects themselves (metadata only, file contents
    # are never read) and total their sizes per folder.
    root = document_files(spark, sf_dir)
    listing = list_objects(spark, root)
    lang = F.regexp_extract("key", r"/lang=([^/]+)/", 1)
    return listing.groupBy(lang.alias("lang")).agg(F.sum("size").cast("bigint").alias("n_bytes"))


@register("list_objects_frontier", """
SELECT lang, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY lang
""")
def list_objects_frontier_q(spark, sf_dir):
    # The same totals from a listing that the executors make, one level of folders per round.
    lang = F.regexp_extract("key", r"/lang=([^/]+)/", 1)
    listing = list_objects_frontier(spark, document_files(spark, sf_dir))
    return listing.groupBy(lang.alias("lang")).agg(F.sum("size").cast("bigint").alias("n_bytes"))
