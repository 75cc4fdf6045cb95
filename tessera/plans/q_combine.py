"""Queries for the union / combine operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.combine import (combine_by_suffix, combine_parquet_tables, match_suffix, suffix_match_counts,
                                       union_by_name, union_same_table, union_tagged)
from tessera.plans.fixtures import drift_tenants, partitioned_tenants, read_tables, tenant_case_sql
from tessera.plans.registry import register, table


@register("union_all_tagged", """
SELECT 'customer' AS source, c_custkey AS id, c_name AS name FROM customer
UNION ALL SELECT 'supplier' AS source, s_suppkey AS id, s_name AS name FROM supplier
UNION ALL SELECT 'part' AS source, p_partkey AS id, p_name AS name FROM part
""")
def union_all_tagged(spark, sf_dir):
    # Three branches, explicit ordered column list, leading literal tag,
    # positional UNION ALL (names from the first branch).
    branches = [
        ("customer", table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name")),
        ("supplier", table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "s_name")),
        ("part", table(spark, sf_dir, "part").selectExpr("p_partkey", "p_name")),
    ]
    return union_tagged(branches)


@register("union_same_table", """
SELECT 'alpha' AS source, c_custkey, c_name FROM customer
UNION ALL SELECT 'beta' AS source, c_custkey, c_name FROM customer
UNION ALL SELECT 'table' AS source, c_custkey, c_name FROM customer
""")
def union_same_table_q(spark, sf_dir):
    # One table read under three tags: one scan + a generator, not three scans.
    return union_same_table(table(spark, sf_dir, "customer"), ["alpha", "beta", "table"],
                            columns=["c_custkey", "c_name"])


@register("union_by_suffix_columns", f"""
SELECT {tenant_case_sql()} AS source, o_orderkey, o_custkey FROM orders
""")
def union_by_suffix_columns(spark, sf_dir):
    # Generated union for one suffix with a configured column list; the
    # decoy ``shop_p_order_totals`` must not match ``_order``.
    tables = read_tables(spark, drift_tenants(spark, sf_dir))
    out = combine_by_suffix(tables, {"_order": "combined_order"},
                            columns={"_order": ["o_orderkey", "o_custkey"]}, tag_col="source")
    return out["combined_order"]


@register("union_by_name_missing", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, s_nationkey AS nation FROM supplier
""")
def union_by_name_missing(spark, sf_dir):
    # Partly overlapping columns: each side's missing ones are null-filled.
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS name", "s_acctbal AS balance", "s_nationkey AS nation")
    return union_by_name([customers, suppliers])


_DRIFT_ORACLE = f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority,
       {tenant_case_sql()} AS source_table,
       CASE WHEN o_orderstatus = 'O' THEN o_orderpriority = '1-URGENT' END AS o_urgent
FROM orders
"""


@register("combine_by_suffix", _DRIFT_ORACLE)
def combine_by_suffix_q(spark, sf_dir):
    # By-name fold over drifting tenants: missing o_totalprice null-filled,
    # extra o_urgent null elsewhere, tag appended as ``source_table``.
    tables = read_tables(spark, drift_tenants(spark, sf_dir))
    out = combine_by_suffix(tables, {"_order": "combined_order", "_order_totals": "combined_order_totals",
                                     "_conf": "combined_conf"})
    return out["combined_order"]


@register("suffix_match_counts", f"""
SELECT {tenant_case_sql()} AS source_table, count(*) AS n_rows, CAST(3 AS BIGINT) AS n_tables
FROM orders GROUP BY 1
""")
def suffix_match_counts_q(spark, sf_dir):
    tables = read_tables(spark, drift_tenants(spark, sf_dir))
    combined = combine_by_suffix(tables, {"_order": "combined_order"})["combined_order"]
    return suffix_match_counts(combined, names=match_suffix(tables, "_order"))


@register("combine_single_scan", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       {tenant_case_sql()} AS source_table
FROM orders
""")
def combine_single_scan(spark, sf_dir):
    # The many-table plan forced on: one multi-root scan, tag from file path.
    roots = partitioned_tenants(spark, sf_dir)
    return combine_parquet_tables(spark, roots, plan="scan")


@register("scan_path_partition", f"""
SELECT {tenant_case_sql()} AS source_table, 'o_orderpriority=' || o_orderpriority AS partition_0,
       count(*) AS n_rows
FROM orders GROUP BY 1, 2
""")
def scan_path_partition(spark, sf_dir):
    # partition_0 = the un-named directory level below each table root.
    roots = partitioned_tenants(spark, sf_dir)
    combined = combine_parquet_tables(spark, roots, plan="scan", partition_levels=1)
    return combined.groupBy("source_table", "partition_0").agg(F.count(F.lit(1)).alias("n_rows"))


@register("combined_conf_flow", """
SELECT CASE o_orderstatus WHEN 'P' THEN 'alpha_conf' WHEN 'F' THEN 'beta_conf' ELSE 'gamma_conf' END AS source,
       count(*) AS n_rows,
       count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS n_json,
       CAST(sum(o_custkey) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS BIGINT) AS custkey_sum,
       count(DISTINCT year(o_orderdate)) AS n_partitions
FROM orders GROUP BY 1
""")
def combined_conf_flow(spark, sf_dir):
    # Flagship: tenant conf exports → combined, normalised catalog table → SQL.
    from tessera.plans.consolidation import CONF_COLUMNS, conf_report, consolidate
    from tessera.plans.fixtures import conf_tenants
    from tessera.plans.q_sources import SCRATCH_DB, scratch_table
    name, path = scratch_table(spark, "combined_conf")
    consolidate(spark, conf_tenants(spark, sf_dir), "_conf", f"{SCRATCH_DB}.{name}", location=path,
                columns=CONF_COLUMNS)
    return conf_report(spark, f"{SCRATCH_DB}.{name}")


@register("combine_incremental", _DRIFT_ORACLE)
def combine_incremental(spark, sf_dir):
    # The same by-name combine as a file stream run with availableNow: the
    # checkpoint makes the next run take only files that are new to it.
    from tessera.session import scratch_path
    from tessera.streaming.incremental import read_combined, run_once
    roots = {n: r for n, r in drift_tenants(spark, sf_dir).items() if n.endswith("_order")}
    sink = scratch_path(spark, "combined_order_stream")
    names = sorted(roots)
    run_once(spark, {n: roots[n] for n in names[1:]}, sink)
    run_once(spark, roots, sink)  # a table that was added between two runs
    return read_combined(spark, sink)


@register("combine_catalog_suffix", _DRIFT_ORACLE)
def combine_catalog_suffix(spark, sf_dir):
    # Table names come from the session catalog: every table of a database
    # whose name ends in ``_order`` (the decoy ``…_order_totals`` does not).
    import uuid

    from tessera.sinks.tables import ensure_database
    from tessera.sources.catalog import tables_by_suffix
    db = f"tessera_tenants_{uuid.uuid4().hex[:10]}"
    ensure_database(spark, db)
    for name, root in drift_tenants(spark, sf_dir).items():
        spark.catalog.createTable(f"{db}.{name}", path=root, source="parquet")
    return combine_by_suffix(tables_by_suffix(spark, db, "_order"), {"_order": "combined_order"})["combined_order"]


_MONTHLY_ORACLE = """
SELECT 'shop_' || strftime(o_orderdate, '%Y%m') || '_order' AS source_table, count(*) AS n_rows,
       CAST(sum(o_custkey) AS BIGINT) AS custkey_sum
FROM orders GROUP BY 1
"""


@register("combine_many_tables", _MONTHLY_ORACLE)
def combine_many_tables(spark, sf_dir):
    # ~80 tenant tables: the automatic plan is one multi-root scan.
    from tessera.plans.fixtures import monthly_tenants
    combined = combine_parquet_tables(spark, monthly_tenants(spark, sf_dir))
    return combined.groupBy("source_table").agg(F.count(F.lit(1)).alias("n_rows"),
                                                F.sum("o_custkey").cast("bigint").alias("custkey_sum"))


@register("combine_many_tables_fold", _MONTHLY_ORACLE)
def combine_many_tables_fold(spark, sf_dir):
    # The same tables through the per-table fold (one scan per table).
    from tessera.plans.fixtures import monthly_tenants
    combined = combine_parquet_tables(spark, monthly_tenants(spark, sf_dir), plan="fold")
    return combined.groupBy("source_table").agg(F.count(F.lit(1)).alias("n_rows"),
                                                F.sum("o_custkey").cast("bigint").alias("custkey_sum"))


@register("combine_aliased_roots", _MONTHLY_ORACLE.strip() + """
UNION ALL
SELECT alias, count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders, (VALUES ('alpha'), ('beta'), ('table')) AS a(alias)
WHERE strftime(o_orderdate, '%Y%m') = (SELECT min(strftime(o_orderdate, '%Y%m')) FROM orders)
GROUP BY 1
""")
def combine_aliased_roots(spark, sf_dir):
    # One folder under several names, among ~80 tables: its rows come once per name under either plan.
    from tessera.plans.fixtures import monthly_tenants
    roots = dict(monthly_tenants(spark, sf_dir))
    first = roots[min(roots)]
    combined = combine_parquet_tables(spark, {**roots, "alpha": first, "beta": first, "table": first + "/"})
    return combined.groupBy("source_table").agg(F.count(F.lit(1)).alias("n_rows"),
                                                F.sum("o_custkey").cast("bigint").alias("custkey_sum"))


@register("combine_batch_drift", f"""
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, CASE WHEN year(o_orderdate) >= 1995 THEN o_orderpriority END AS o_orderpriority,
       {tenant_case_sql()} AS source_table
FROM orders
""")
def combine_batch_drift(spark, sf_dir):
    # Every table's later batch has one more column and a wider key type: nothing of it is lost.
    from tessera.session import scratch_path
    orders, base, roots = table(spark, sf_dir, "orders"), scratch_path(spark, "batch-drift"), {}
    for status in "PFO":
        name = f"shop_{status.lower()}_order"
        roots[name] = f"{base}/{name}"
        own = orders.where(F.col("o_orderstatus") == status)
        (own.where("year(o_orderdate) < 1995").selectExpr("o_orderkey", "CAST(o_custkey AS int) AS o_custkey")
            .write.parquet(f"{roots[name]}/batch 1"))
        (own.where("year(o_orderdate) >= 1995").selectExpr("o_orderkey", "CAST(o_custkey AS bigint) AS o_custkey", "o_orderpriority")
            .write.parquet(f"{roots[name]}/batch 2"))
    return combine_parquet_tables(spark, roots)


@register("union_type_drift", """
SELECT 'a' AS source, CAST(c_custkey AS BIGINT) AS id, CAST(CAST(c_acctbal AS DECIMAL(9,2)) AS DECIMAL(14,4)) AS balance,
       c_mktsegment AS note, CAST(c_nationkey AS DOUBLE) AS nation FROM customer
UNION ALL
SELECT 'b', c_custkey * 1000000000, CAST(c_acctbal AS DECIMAL(14,4)), CAST(c_nationkey AS VARCHAR), c_nationkey + 0.5 FROM customer
""")
def union_type_drift(spark, sf_dir):
    # int + bigint, two decimals and int + double widen without loss; text + int becomes text.
    c = table(spark, sf_dir, "customer")
    a = c.selectExpr("CAST(c_custkey AS int) AS id", "CAST(c_acctbal AS decimal(9,2)) AS balance", "c_mktsegment AS note",
                     "CAST(c_nationkey AS int) AS nation")
    b = c.selectExpr("c_custkey * 1000000000L AS id", "CAST(c_acctbal AS decimal(14,4)) AS balance", "CAST(c_nationkey AS int) AS note",
                     "CAST(c_nationkey + 0.5 AS double) AS nation")
    return union_tagged([("a", a), ("b", b)])


@register("combine_database_job", f"""
SELECT 'combined_order' AS out, {tenant_case_sql()} AS source_table, o_orderkey, o_custkey, count(*) OVER () AS n_rows FROM orders
UNION ALL
SELECT 'combined_order_totals', 'shop_p_order_totals', NULL, NULL, count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'combined_conf', 'no match', NULL, NULL, 0
""")
def combine_database_job(spark, sf_dir):
    # From a catalog database to catalog tables, one suffix with a column list; contents and report.
    import uuid

    from tessera.plans.consolidation import consolidate_database
    from tessera.sinks.tables import ensure_database
    run = uuid.uuid4().hex[:10]
    db, target = f"tessera_raw_{run}", f"tessera_combined_{run}"
    ensure_database(spark, db)
    ensure_database(spark, target)
    for name, root in drift_tenants(spark, sf_dir).items():
        spark.catalog.createTable(f"{db}.{name}", path=root, source="parquet")
    report = consolidate_database(spark, db, {"_order": "combined_order", "_order_totals": "combined_order_totals", "_conf": "combined_conf"},
                                  target, columns={"_order": ["o_orderkey", "o_custkey"]})
    n_rows = {r["suffix"]: F.lit(r["n_rows"]).alias("n_rows") for r in report.collect()}  # one row per suffix
    orders = spark.table(f"{target}.combined_order").select(F.lit("combined_order").alias("out"), "*", n_rows["_order"])
    totals = spark.table(f"{target}.combined_order_totals").select("source_table").distinct().select(
        F.lit("combined_order_totals").alias("out"), "*", n_rows["_order_totals"])
    missing = report.where("status = 'no match'").selectExpr("output_table AS out", "status AS source_table", "n_rows")
    return orders.unionByName(totals, allowMissingColumns=True).unionByName(missing, allowMissingColumns=True)


@register("combine_job_report", """
SELECT '_order' AS suffix, 'combined_order' AS output_table, CAST(3 AS BIGINT) AS n_tables,
       count(*) AS n_rows, 'written' AS status FROM orders
UNION ALL
SELECT '_order_totals', 'combined_order_totals', 1, count(*), 'written' FROM orders WHERE o_orderstatus = 'P'
UNION ALL
SELECT '_conf', 'combined_conf', 0, 0, 'no match'
""")
def combine_job_report(spark, sf_dir):
    # The whole combine job over tenant roots: per suffix, combine, write
    # size-based Parquet, report tables and observed rows; a suffix with no
    # tables is reported, not an error.
    from tessera.plans.consolidation import consolidate_by_suffix
    from tessera.session import scratch_path
    return consolidate_by_suffix(
        spark, drift_tenants(spark, sf_dir),
        {"_order": "combined_order", "_order_totals": "combined_order_totals", "_conf": "combined_conf"},
        scratch_path(spark, "combined"), group_bytes=16 << 20)


# A CTAS written the way the reference's SQL files are (quoted identifiers,
# inline comments, trailing ';'); {db} is filled in per run.
TRINO_STYLE_CTAS = """
CREATE TABLE "{db}"."combined_orders" AS --the combined table
SELECT
    'alpha' AS source, --where the row came from
    o_orderkey,
    o_custkey,
    o_orderdate
FROM
    "{db}"."shop_p_order"

UNION ALL

SELECT 'beta' AS source, o_orderkey, o_custkey, o_orderdate
FROM "{db}"."shop_f_order"

UNION ALL

SELECT 'order' AS source, o_orderkey, o_custkey, o_orderdate
FROM "{db}"."shop_o_order"; --end of statement
"""


@register("sql_ctas_union", """
SELECT CASE o_orderstatus WHEN 'P' THEN 'alpha' WHEN 'F' THEN 'beta' ELSE 'order' END AS source,
       o_orderkey, o_custkey, o_orderdate
FROM orders
""")
def sql_ctas_union(spark, sf_dir):
    # The SQL route: tenant tables in a catalog database, then the CTAS text
    # run by Spark SQL itself, then a quoted-identifier SELECT.
    import uuid

    from tessera.plans.sql import run_statement
    from tessera.sinks.tables import ensure_database
    db = f"tessera_sql_{uuid.uuid4().hex[:10]}"
    ensure_database(spark, db)
    for name, root in drift_tenants(spark, sf_dir).items():
        spark.catalog.createTable(f"{db}.{name}", path=root, source="parquet")
    run_statement(spark, TRINO_STYLE_CTAS.format(db=db))
    return run_statement(spark, f'SELECT * FROM "{db}"."combined_orders"')


@register("schema_ledger_runs", """
SELECT 'row' AS what, o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority,
       lower(o_orderstatus) || '_order' AS source_table, NULL AS footers FROM orders
UNION ALL SELECT 'first run', NULL, NULL, NULL, NULL, 3
UNION ALL SELECT 'second run', NULL, NULL, NULL, NULL, 1
UNION ALL SELECT 'third run', NULL, NULL, NULL, NULL, 0
""")
def schema_ledger_runs(spark, sf_dir):
    # Three files; then one more with a new column; then nothing new. Each run opens the new footers alone, and the
    # combine's columns follow from the ledger.
    from tessera.operators.combine import combine_parquet_tables
    from tessera.session import scratch_path
    from tessera.sources.ledger import SchemaLedger
    orders, base = table(spark, sf_dir, "orders"), scratch_path(spark, "ledger")
    roots = {f"{s.lower()}_order": f"{base}/in/{s.lower()}_order" for s in "FOP"}
    late = (F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 2 == 0)
    for s in "FOP":
        (orders.where((F.col("o_orderstatus") == s) & ~late).select("o_orderkey", "o_totalprice").coalesce(1)
               .write.parquet(f"{roots[f'{s.lower()}_order']}/batch 1"))
    ledger = SchemaLedger(spark, f"{base}/schemas")
    reads = [("first run", ledger.update(roots))]
    orders.where(late).select("o_orderkey", "o_totalprice", "o_orderpriority").coalesce(1).write.parquet(f"{roots['o_order']}/batch 2")
    reads += [("second run", ledger.update(roots)), ("third run", ledger.update(roots))]
    combined = combine_parquet_tables(spark, roots, ledger=ledger).withColumn("what", F.lit("row"))
    return combined.unionByName(spark.createDataFrame(reads, "what string, footers int"), allowMissingColumns=True)
