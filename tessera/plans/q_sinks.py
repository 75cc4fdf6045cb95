"""Queries for sinks (B1-B5, B8, G1): write, then read back what was written."""

from __future__ import annotations

from tessera.operators.combine import combine_by_suffix
from tessera.plans.fixtures import drift_tenants, read_tables, tenant_case_sql
from tessera.plans.q_combine import _DRIFT_ORACLE
from tessera.plans.q_sources import SCRATCH_DB, scratch_table
from tessera.plans.registry import register, table
from tessera.session import scratch_path
from tessera.sinks.files import compact_write, write_json
from tessera.sinks.tables import create_table_as

_CTAS_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate"]


@register("ctas_combined", f"""
SELECT {tenant_case_sql()} AS source, o_orderkey, o_custkey, o_orderdate FROM orders
""")
def ctas_combined(spark, sf_dir):
    # CREATE TABLE … AS <generated union>, at a chosen external location.
    tables = read_tables(spark, drift_tenants(spark, sf_dir))
    union = combine_by_suffix(tables, {"_order": "combined_orders"}, columns={"_order": _CTAS_COLUMNS},
                              tag_col="source")["combined_orders"]
    name, path = scratch_table(spark, "combined_orders")
    return create_table_as(union, f"{SCRATCH_DB}.{name}", path=path)


@register("compact_write", _DRIFT_ORACLE)
def compact_write_q(spark, sf_dir):
    # Combined tenants written in files of the target size, read back.
    tables = read_tables(spark, drift_tenants(spark, sf_dir))
    combined = combine_by_suffix(tables, {"_order": "combined_order"})["combined_order"]
    path = scratch_path(spark, "combined_order")
    compact_write(combined, path)
    return spark.read.parquet(path)


@register("compact_write_counted", """
SELECT n_files, n_rows FROM (VALUES (10), (4)) AS f(n_files), (SELECT count(*) AS n_rows FROM customer)
""")
def compact_write_counted(spark, sf_dir):
    # A stated number of files: spread by an exchange, or (small inputs) by fewer tasks without one.
    from pyspark.sql import functions as F
    customers = table(spark, sf_dir, "customer").repartition(12)
    out = []
    for n, shuffle in ((10, True), (4, False)):
        path = scratch_path(spark, "customers_counted")
        compact_write(customers, path, num_files=n, shuffle=shuffle)
        written = spark.read.parquet(path).withColumn("file", F.input_file_name())
        out.append(written.agg(F.count_distinct("file").cast("int").alias("n_files"), F.count(F.lit(1)).alias("n_rows")))
    return out[0].unionByName(out[1])


@register("json_sink_roundtrip", "SELECT * FROM orders")
def json_sink_roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders_json")
    write_json(orders, path)
    return spark.read.schema(orders.schema).json(path)
