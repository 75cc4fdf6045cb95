"""Queries for copy / upsert / rejects / counts / snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.copying import copy_all_tables, copy_database, copy_table
from tessera.operators.snapshot import restore_snapshot, restore_to_tables, snapshot_tables
from tessera.plans.q_sources import SCRATCH_DB, scratch_table
from tessera.plans.registry import register, table
from tessera.session import scratch_path
from tessera.sinks.tables import ensure_database

# Which market segments form the copy source and the existing
# target (they overlap in MACHINERY; together they cover every customer).
SOURCE_SEGMENTS = ("BUILDING", "AUTOMOBILE", "MACHINERY")
TARGET_SEGMENTS = ("MACHINERY", "HOUSEHOLD", "FURNITURE")


def _customer_items(spark, sf_dir):
    """Customers as items; an item with a negative balance lost its key."""
    c = table(spark, sf_dir, "customer")
    return c.withColumn("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")))


@register("copy_table_upsert", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer
WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')
UNION ALL
SELECT * FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'FURNITURE')
""")
def copy_table_upsert(spark, sf_dir):
    # Existing target, then a keyed copy whose items replace same-key rows.
    # The target is bucketed by key (as a keyed store partitions by hash
    # key), so the upsert's anti join shuffles only the changed items.
    c = table(spark, sf_dir, "customer")
    name, path = scratch_table(spark, "customer_copy")
    target = f"{SCRATCH_DB}.{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    copy_table(spark, c.where(F.col("c_mktsegment").isin(*TARGET_SEGMENTS)), target, "c_custkey", location=path,
               buckets=buckets)
    changed = (c.where(F.col("c_mktsegment").isin(*SOURCE_SEGMENTS))
                .withColumn("c_acctbal", F.col("c_acctbal") + 1))
    copy_table(spark, changed, target, "c_custkey", location=path)
    return spark.table(target)


@register("copy_rejects", """
SELECT c_name, 'missing key c_custkey' AS reason FROM customer WHERE c_acctbal < 0
""")
def copy_rejects(spark, sf_dir):
    name, path = scratch_table(spark, "customer_items")
    result = copy_table(spark, _customer_items(spark, sf_dir), f"{SCRATCH_DB}.{name}", "c_custkey", location=path)
    return spark.read.parquet(result.rejects_path).select("c_name", "reason")


@register("copy_into_empty_target", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal >= 0
""")
def copy_into_empty_target(spark, sf_dir):
    # The target exists and holds nothing, as when tables are recreated before a copy.
    items = _customer_items(spark, sf_dir)
    name, path = scratch_table(spark, "customer_empty")
    target = f"{SCRATCH_DB}.{name}"
    copy_table(spark, items.limit(0), target, "c_custkey", location=path)
    copy_table(spark, items, target, "c_custkey", location=path)
    copy_table(spark, items.limit(0), target, "c_custkey", location=path)  # an empty source changes nothing
    return spark.table(target)


@register("copy_type_drift", """
SELECT 'table' AS place, o_orderkey AS k, CAST(o_custkey AS BIGINT) AS v, CAST(NULL AS VARCHAR) AS reason FROM orders
WHERE o_orderkey % 5 <> 0 AND o_orderpriority <> '1-URGENT'
UNION ALL
SELECT 'rejects', o_orderkey, NULL, 'v does not fit int' FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderpriority = '1-URGENT'
UNION ALL
SELECT 'table', o_orderkey, CAST(o_custkey AS BIGINT), NULL FROM orders WHERE o_orderkey % 5 = 0
""")
def copy_type_drift(spark, sf_dir):
    # The target's v is int, the source's is text: fitting values are cast, the others are rejected row by row.
    o = table(spark, sf_dir, "orders")
    name, path = scratch_table(spark, "order_drift")
    target = f"{SCRATCH_DB}.{name}"
    copy_table(spark, o.where("o_orderkey % 5 = 0").selectExpr("o_orderkey AS k", "CAST(o_custkey AS int) AS v"), target, "k",
               location=path)
    text = o.where("o_orderkey % 5 <> 0").selectExpr(
        "o_orderkey AS k", "CASE WHEN o_orderpriority = '1-URGENT' THEN 'x' || o_custkey ELSE CAST(o_custkey AS string) END AS v")
    result = copy_table(spark, text, target, "k", location=path)
    kept = spark.table(target).selectExpr("'table' AS place", "k", "CAST(v AS bigint) AS v", "CAST(NULL AS string) AS reason")
    rejects = spark.read.parquet(result.rejects_path).selectExpr("'rejects' AS place", "k", "CAST(NULL AS bigint) AS v", "reason")
    return kept.unionByName(rejects)


@register("copy_all_rejected", """
SELECT 'table' AS place, s_suppkey AS k, s_name AS name, NULL AS reason FROM supplier
UNION ALL SELECT 'rejects', NULL, s_name, 'missing key s_suppkey' FROM supplier
""")
def copy_all_rejected(spark, sf_dir):
    # No row of the second copy has a key: the target keeps its rows, every row is a reject.
    s = table(spark, sf_dir, "supplier")
    name, path = scratch_table(spark, "supplier_rejected")
    target = f"{SCRATCH_DB}.{name}"
    copy_table(spark, s, target, "s_suppkey", location=path)
    result = copy_table(spark, s.withColumn("s_suppkey", F.lit(None).cast(s.schema["s_suppkey"].dataType)), target, "s_suppkey",
                        location=path)
    kept = spark.table(target).selectExpr("'table' AS place", "s_suppkey AS k", "s_name AS name", "CAST(NULL AS string) AS reason")
    rejects = spark.read.parquet(result.rejects_path).selectExpr("'rejects' AS place", "s_suppkey AS k", "s_name AS name", "reason")
    return kept.unionByName(rejects)


@register("copy_database", """
SELECT 'customer' AS table_name, c_custkey AS k, c_name AS name, NULL AS failed FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier
UNION ALL SELECT 'keyless', NULL, NULL, 'no key given'
UNION ALL SELECT 'nation', NULL, NULL, 'DuplicateKeys'
""")
def copy_database_q(spark, sf_dir):
    # Every table of a catalog database; one has no key, one has duplicate keys: both are rows of the report.
    suffix = scratch_path(spark, "x").rsplit("-", 1)[-1]
    source_db, target_db = f"tessera_from_{suffix}", f"tessera_to_{suffix}"
    ensure_database(spark, source_db)
    ensure_database(spark, target_db)
    for name, source in (("customer", "customer"), ("supplier", "supplier"), ("nation", "nation"), ("keyless", "region")):
        spark.catalog.createTable(f"{source_db}.{name}", path=f"{sf_dir.rstrip('/')}/{source}.parquet", source="parquet")
    report = copy_database(spark, source_db, target_db, {"customer": "c_custkey", "supplier": "s_suppkey", "nation": "n_regionkey"})
    copied = [spark.table(f"{target_db}.{n}").selectExpr(f"'{n}' AS table_name", f"{k} AS k", f"{v} AS name", "CAST(NULL AS string) AS failed")
              for n, k, v in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"))]
    failed = report.where("error IS NOT NULL").selectExpr(
        "table_name", "CAST(NULL AS bigint) AS k", "CAST(NULL AS string) AS name", "split(error, ':')[0] AS failed")
    return copied[0].unionByName(copied[1]).unionByName(failed)


@register("copy_counts", """
SELECT 'customer' AS table_name, count(*) FILTER (WHERE c_acctbal >= 0) AS copied,
       count(*) FILTER (WHERE c_acctbal < 0) AS rejected FROM customer
UNION ALL SELECT 'nation', count(*), 0 FROM nation
UNION ALL SELECT 'supplier', count(*), 0 FROM supplier
""")
def copy_counts(spark, sf_dir):
    # Copy every table of a "database" into another; report copied/rejected.
    db = f"{SCRATCH_DB}_copy"
    ensure_database(spark, db)
    suffix = scratch_path(spark, "x").rsplit("-", 1)[-1]
    sources = {"customer": (_customer_items(spark, sf_dir), "c_custkey"),
               "nation": (table(spark, sf_dir, "nation"), "n_nationkey"),
               "supplier": (table(spark, sf_dir, "supplier"), "s_suppkey")}
    report, _ = copy_all_tables(spark, sources, db, rename={n: f"{n}_{suffix}" for n in sources})
    return report.withColumn("table_name", F.regexp_replace("table_name", f"_{suffix}$", ""))


@register("snapshot_restore", """
SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
UNION ALL SELECT 'region', count(*) FROM region
UNION ALL SELECT 'supplier', count(*) FROM supplier
""")
def snapshot_restore(spark, sf_dir):
    # Snapshot four tables, restore all but those matching ``n*``; count the
    # restored rows from the restored data itself.
    names = ["region", "nation", "supplier", "customer"]
    base = scratch_path(spark, "snapshots")
    snapshot_tables(spark, {n: table(spark, sf_dir, n) for n in names}, base, "snap-001")
    restored = restore_snapshot(spark, base, "snap-001", "-n*")
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
              for n, df in restored.items()]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out


@register("restore_to_tables", """
SELECT 'customer' AS table_name, c_custkey AS k, c_name AS name, NULL AS failed FROM customer
UNION ALL SELECT 'region', r_regionkey, r_name, NULL FROM region
UNION ALL SELECT 'supplier', NULL, NULL, 'failed' 
""")
def restore_to_tables_q(spark, sf_dir):
    # Into catalog tables, all but ``n*``; one target exists already and is reported, the others hold their rows.
    base, suffix = scratch_path(spark, "snapshots"), scratch_path(spark, "x").rsplit("-", 1)[-1]
    db = f"tessera_restored_{suffix}"
    ensure_database(spark, db)
    snapshot_tables(spark, {n: table(spark, sf_dir, n) for n in ("region", "nation", "supplier", "customer")}, base, "snap-001")
    table(spark, sf_dir, "nation").write.saveAsTable(f"{db}.supplier")
    report = restore_to_tables(spark, base, "snap-001", db, "-n*")
    return (spark.table(f"{db}.customer").selectExpr("'customer' AS table_name", "c_custkey AS k", "c_name AS name", "CAST(NULL AS string) AS failed")
            .unionByName(spark.table(f"{db}.region").selectExpr("'region' AS table_name", "CAST(r_regionkey AS bigint) AS k", "r_name AS name",
                                                                 "CAST(NULL AS string) AS failed"))
            .unionByName(report.where("status <> 'restored'").selectExpr("table_name", "CAST(NULL AS bigint) AS k", "CAST(NULL AS string) AS name",
                                                                         "split(status, ':')[0] AS failed")))


@register("snapshot_incremental", """
SELECT 'first' AS what, o_orderkey, o_totalprice, CAST(o_orderstatus AS VARCHAR) AS o_orderstatus, NULL AS files, NULL AS copied FROM orders
UNION ALL SELECT 'second', o_orderkey, CASE WHEN o_orderstatus = 'P' THEN -1 ELSE o_totalprice END, o_orderstatus, NULL, NULL FROM orders
UNION ALL SELECT 'taken first', NULL, NULL, NULL, 4, 4
UNION ALL SELECT 'taken second', NULL, NULL, NULL, 4, 1
""")
def snapshot_incremental(spark, sf_dir):
    # The second snapshot copies the one file that changed. Both restore as they were taken, the second after the
    # first is dropped and its blobs are swept.
    from tessera.operators.increments import drop_snapshot, restore_files, sweep_blobs, take_snapshot
    base = scratch_path(spark, "increments")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    roots = {"orders": f"{base}/db/orders", "region": f"{base}/db/region"}
    orders.coalesce(1).write.partitionBy("o_orderstatus").parquet(roots["orders"])
    table(spark, sf_dir, "region").coalesce(1).write.parquet(roots["region"])
    first = take_snapshot(spark, roots, f"{base}/repo", "first")
    (orders.where("o_orderstatus = 'P'").select("o_orderkey", F.lit(-1.0).alias("o_totalprice")).coalesce(1)
           .write.mode("overwrite").parquet(f"{roots['orders']}/o_orderstatus=P"))
    second = take_snapshot(spark, roots, f"{base}/repo", "second")
    was = restore_files(spark, f"{base}/repo", "first", f"{base}/back/first", "orders")["orders"]
    drop_snapshot(spark, f"{base}/repo", "first")
    sweep_blobs(spark, f"{base}/repo")
    now = restore_files(spark, f"{base}/repo", "second", f"{base}/back/second", "orders")["orders"]
    report = spark.createDataFrame([("taken first", first.files, first.copied), ("taken second", second.files, second.copied)],
                                   "what string, files int, copied int")
    return (was.withColumn("what", F.lit("first")).unionByName(now.withColumn("what", F.lit("second")))
            .unionByName(report, allowMissingColumns=True))


@register("copy_database_resumed", """
SELECT 'customer' AS table_name, c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'new' END AS name, NULL AS run, NULL AS state FROM customer
UNION ALL SELECT 'nation', n_nationkey, n_name, NULL, NULL FROM nation
UNION ALL SELECT * FROM (VALUES ('customer', NULL, NULL, 1, 'done'), ('nation', NULL, NULL, 1, 'failed'), ('supplier', NULL, NULL, 1, 'done'),
  ('customer', NULL, NULL, 2, 'done'), ('nation', NULL, NULL, 2, 'done'), ('supplier', NULL, NULL, 2, 'unchanged'),
  ('customer', NULL, NULL, 3, 'unchanged'), ('nation', NULL, NULL, 3, 'unchanged'), ('supplier', NULL, NULL, 3, 'unchanged'))
""")
def copy_database_resumed(spark, sf_dir):
    # The first run fails on one table. Then its key is put right and another table gets new files: the second run
    # copies these two, the third none.
    suffix = scratch_path(spark, "x").rsplit("-", 1)[-1]
    source_db, target_db, base = f"tessera_open_{suffix}", f"tessera_done_{suffix}", scratch_path(spark, "resumed")
    ensure_database(spark, source_db)
    ensure_database(spark, target_db)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    c.where("c_custkey % 2 = 0").write.parquet(f"{base}/customer")
    spark.catalog.createTable(f"{source_db}.customer", path=f"{base}/customer", source="parquet")
    for name in ("supplier", "nation"):
        spark.catalog.createTable(f"{source_db}.{name}", path=f"{sf_dir.rstrip('/')}/{name}.parquet", source="parquet")
    keys = {"customer": "c_custkey", "supplier": "s_suppkey", "nation": "n_regionkey"}
    reports = [copy_database(spark, source_db, target_db, keys, ledger=f"{base}/ledger")]
    c.where("c_custkey % 2 = 1").withColumn("c_name", F.lit("new")).write.mode("append").parquet(f"{base}/customer")
    spark.catalog.refreshTable(f"{source_db}.customer")
    keys["nation"] = "n_nationkey"
    reports += [copy_database(spark, source_db, target_db, keys, ledger=f"{base}/ledger") for _ in range(2)]
    out = (spark.table(f"{target_db}.customer").selectExpr("'customer' AS table_name", "c_custkey AS k", "c_name AS name")
           .unionByName(spark.table(f"{target_db}.nation").selectExpr("'nation' AS table_name", "CAST(n_nationkey AS bigint) AS k", "n_name AS name")))
    for run, report in enumerate(reports, 1):
        out = out.unionByName(report.select("table_name", F.lit(run).alias("run"), "state"), allowMissingColumns=True)
    return out
