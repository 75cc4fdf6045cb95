"""Queries for keyed tables, exact conversions and what is kept up with a copy."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.copying import copy_table
from tessera.operators.indexes import IndexSpec
from tessera.operators.keyed import copy_keyed, create_keyed_index, read_keyed
from tessera.plans.q_sources import SCRATCH_DB, scratch_table
from tessera.plans.registry import register, table


@register("copy_lossy_casts", """
WITH s AS (
  SELECT o_orderkey AS k, CAST(o_custkey AS DECIMAL(10,2)) + 0.5 AS price, CAST(o_orderdate AS DATE) AS day, o_orderkey AS big,
         CASE WHEN o_orderkey % 3 = 0 THEN 'price does not fit decimal(10,2)' WHEN o_orderkey % 5 = 0 THEN 'day does not fit date'
              WHEN o_orderkey % 7 = 0 THEN 'big does not fit double' END AS reason
  FROM orders)
SELECT 'table' AS place, k, CAST(price AS DOUBLE) AS price, day, CAST(big AS DOUBLE) AS big, NULL AS reason FROM s WHERE reason IS NULL
UNION ALL SELECT 'rejects', k, NULL, NULL, NULL, reason FROM s WHERE reason IS NOT NULL
""")
def copy_lossy_casts(spark, sf_dir):
    # Every value that the target's type would round, cut or change is a reject: text with more places than the
    # decimal has, a time of day into a date, an integer that no double holds.
    o = table(spark, sf_dir, "orders")
    name, path = scratch_table(spark, "lossy")
    target = f"{SCRATCH_DB}.{name}"
    copy_table(spark, o.limit(0).selectExpr("o_orderkey AS k", "CAST(0 AS decimal(10,2)) AS price", "CAST(o_orderdate AS date) AS day",
                                            "CAST(0 AS double) AS big"), target, "k", location=path)
    source = o.selectExpr(
        "o_orderkey AS k", "o_custkey || CASE WHEN o_orderkey % 3 = 0 THEN '.505' ELSE '.5' END AS price",
        "CAST(CAST(o_orderdate AS date) AS timestamp_ntz) + CASE WHEN o_orderkey % 5 = 0 THEN INTERVAL '23:59:59' HOUR TO SECOND "
        "ELSE INTERVAL '0:00:00' HOUR TO SECOND END AS day",
        "CASE WHEN o_orderkey % 7 = 0 THEN 9007199254740993 ELSE o_orderkey END AS big")
    result = copy_table(spark, source, target, "k", location=path)
    kept = spark.table(target).selectExpr("'table' AS place", "k", "CAST(price AS double) AS price", "day", "big", "CAST(NULL AS string) AS reason")
    return kept.unionByName(spark.read.parquet(result.rejects_path).selectExpr("'rejects' AS place", "k", "reason"), allowMissingColumns=True)


@register("copy_touched_buckets", """
SELECT 'row' AS what, c_custkey AS k, CASE WHEN c_custkey = (SELECT min(c_custkey) FROM customer) THEN 'first' ELSE c_name END AS name,
       c_acctbal + 1 AS acctbal, NULL AS kept, NULL AS rewritten FROM customer
UNION ALL SELECT 'one key', NULL, NULL, NULL, 7, 1
UNION ALL SELECT 'every key', NULL, NULL, NULL, 0, 8
""")
def copy_touched_buckets(spark, sf_dir):
    # A put of one key rewrites the one bucket that has it; a put of every key rewrites all of them.
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_name AS name", "c_acctbal AS acctbal")
    name, path = scratch_table(spark, "touched")
    target = f"{SCRATCH_DB}.{name}"
    copy_keyed(spark, c, target, "k", buckets=8, location=path)
    every = copy_keyed(spark, c.withColumn("acctbal", F.col("acctbal") + 1), target, "k")
    first = read_keyed(spark, target).orderBy("k").limit(1).withColumn("name", F.lit("first"))
    one = copy_keyed(spark, first, target, "k")
    report = spark.createDataFrame([("one key", one.kept, one.rewritten), ("every key", every.kept, every.rewritten)],
                                   "what string, kept int, rewritten int")
    return read_keyed(spark, target).withColumn("what", F.lit("row")).unionByName(report, allowMissingColumns=True)


@register("index_after_copy", """
WITH now AS (
  SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN
           CASE WHEN c_custkey % 3 > 0 THEN (c_nationkey + 1) % 25 END ELSE c_nationkey END AS c_nationkey
  FROM customer)
SELECT 'by_nation' AS index_name, CAST(c_nationkey AS BIGINT) AS hash_key, c_acctbal AS range_key, c_custkey, c_name FROM now WHERE c_nationkey IS NOT NULL
UNION ALL SELECT 'by_customer', c_custkey, NULL, c_custkey, NULL FROM now
""")
def index_after_copy(spark, sf_dir):
    # Two indexes follow a copy that moves rows between hash keys, adds rows and takes the hash key from some.
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey", "c_mktsegment")
    name, path = scratch_table(spark, "indexed")
    target = f"{SCRATCH_DB}.{name}"
    copy_keyed(spark, c.where("c_mktsegment <> 'BUILDING'"), target, "c_custkey", buckets=8, location=path)
    specs = {f"{target}_n": IndexSpec("by_nation", "c_nationkey", "c_acctbal", "INCLUDE", ("c_name",)),
             f"{target}_c": IndexSpec("by_customer", "c_custkey", None, "KEYS_ONLY", kind="local")}
    for index, spec in specs.items():
        create_keyed_index(spark, target, spec, index, 8, f"{path}-{spec.name}")
    change = c.where("c_mktsegment IN ('MACHINERY', 'BUILDING')").withColumn(
        "c_nationkey", F.expr("CASE WHEN c_custkey % 3 > 0 THEN CAST((c_nationkey + 1) % 25 AS int) END"))
    copy_keyed(spark, change, target, "c_custkey", indexes=specs)
    return (read_keyed(spark, f"{target}_n").selectExpr("'by_nation' AS index_name", "CAST(c_nationkey AS bigint) AS hash_key", "c_acctbal AS range_key",
                                                        "c_custkey", "c_name")
            .unionByName(read_keyed(spark, f"{target}_c").selectExpr("'by_customer' AS index_name", "c_custkey AS hash_key", "c_custkey"),
                         allowMissingColumns=True))
