"""Inputs the registered queries derive from the driver's tables.

Tenant copies come from ``orders`` split on ``o_orderstatus`` (P/F/O, about a
third each). Every fixture is written once per (checkpoint folder, data dir)
under the session's checkpoint folder and memoised for the process; the
files are immutable, so a re-run reads the same inputs.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.registry import table
from tessera.session import checkpoint_root, scratch_path

# Tenant table names and the status each one holds.
TENANT_STATUS = {"shop_p_order": "P", "shop_f_order": "F", "shop_o_order": "O"}
DECOY_TABLE = "shop_p_order_totals"

_cache: dict[tuple, object] = {}
_lock = threading.Lock()


def _memo(spark: SparkSession, sf_dir: str, name: str, build):
    key = (checkpoint_root(spark), sf_dir.rstrip("/"), name)
    with _lock:
        if key not in _cache:
            _cache[key] = build()
        return _cache[key]


def tenant_column() -> F.Column:
    """The tenant table an order row belongs to (the same rule as the writer)."""
    expr = None
    for name, status in TENANT_STATUS.items():
        cond = F.col("o_orderstatus") == status
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def tenant_case_sql(col: str = "o_orderstatus") -> str:
    arms = " ".join(f"WHEN '{s}' THEN '{n}'" for n, s in TENANT_STATUS.items())
    return f"CASE {col} {arms} END"


def partitioned_tenants(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Tenants written in one pass: ``base/tenant=<name>/o_orderpriority=<p>/part-*``.

    Returns table name → root. The priority level is a directory the tables
    do not name (the data files lack the column), i.e. a crawler's
    ``partition_0``. Values contain spaces, so paths exercise URI decoding.
    """
    def build():
        base = scratch_path(spark, "tenants")
        (table(spark, sf_dir, "orders").withColumn("tenant", tenant_column())
            .write.partitionBy("tenant", "o_orderpriority").parquet(base))
        return {name: f"{base}/tenant={name}" for name in TENANT_STATUS}
    return _memo(spark, sf_dir, "partitioned_tenants", build)


def drift_tenants(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Tenant tables whose schemas drift, plus a suffix decoy.

    * ``shop_p_order`` — all order columns;
    * ``shop_f_order`` — lacks ``o_totalprice``;
    * ``shop_o_order`` — adds ``o_urgent boolean``;
    * ``shop_p_order_totals`` — a different table whose name only *contains*
      the ``_order`` suffix.
    """
    def build():
        base = scratch_path(spark, "drift")
        orders = table(spark, sf_dir, "orders")
        shapes = {
            "shop_p_order": orders.where("o_orderstatus = 'P'"),
            "shop_f_order": orders.where("o_orderstatus = 'F'").drop("o_totalprice"),
            "shop_o_order": orders.where("o_orderstatus = 'O'")
                                  .withColumn("o_urgent", F.col("o_orderpriority") == "1-URGENT"),
            DECOY_TABLE: orders.where("o_orderstatus = 'P'")
                               .select("o_orderkey", F.col("o_totalprice").alias("total")),
        }
        roots = {}
        for name, df in shapes.items():
            roots[name] = f"{base}/db/{name}"
            df.write.parquet(roots[name])
        return roots
    return _memo(spark, sf_dir, "drift_tenants", build)


def read_tables(spark: SparkSession, roots: dict[str, str]) -> dict[str, DataFrame]:
    from tessera.sources.files import read_parquet_tree
    return {name: read_parquet_tree(spark, root) for name, root in roots.items()}


def inventory(spark: SparkSession, sf_dir: str) -> str:
    """An object inventory derived from ``documents``.

    ``key = docs/<lang>/<doc_id>.txt``; German documents sit in the archive
    class ``GLACIER``, the rest in ``STANDARD``; ``size`` is the text's bytes.
    """
    def build():
        path = scratch_path(spark, "inventory")
        docs = table(spark, sf_dir, "documents")
        (docs.select(F.concat(F.lit("docs/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"),
                              F.lit(".txt")).alias("key"),
                     F.when(F.col("lang") == "de", "GLACIER").otherwise("STANDARD").alias("storage_class"),
                     F.octet_length("text").cast("bigint").alias("size"))
             .write.parquet(path))
        return path
    return _memo(spark, sf_dir, "inventory", build)


# The attributes of the customer item export and their types.
ITEM_ATTRIBUTES = {"id": "N", "name": "S", "nation": "N", "acctbal": "N", "segment": "S", "vip": "BOOL"}


def customer_item_export(spark: SparkSession, sf_dir: str) -> str:
    """``customer`` as a gzip typed-attribute export in nested folders.

    Household customers carry no ``segment`` attribute (items differ in
    their attribute sets).
    """
    def build():
        from tessera.sources.items import export_typed_items
        base = scratch_path(spark, "item_export")
        c = table(spark, sf_dir, "customer")
        items = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                         F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("acctbal"),
                         F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("segment"),
                         (F.col("c_acctbal") > 9000).alias("vip"))
        export_typed_items(items, f"{base}/exports/01-customer/data", ITEM_ATTRIBUTES)
        return base
    return _memo(spark, sf_dir, "customer_item_export", build)


# Tenant ``conf`` tables and the order status each one holds.
CONF_TENANTS = {"alpha_conf": "P", "beta_conf": "F", "gamma_conf": "O"}
CONF_SERIALIZED_PRIORITIES = ("1-URGENT", "2-HIGH")


def conf_tenants(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Per-tenant ``conf`` tables derived from ``orders``, one write.

    ``id, name, value, serialize, name_jp, memo`` per row; urgent and high
    priority orders carry a serialized array in ``value`` (``serialize = 1``),
    the rest plain text. Files sit one un-named level below each table root
    (``export=<year>``), which becomes ``partition_0``.
    """
    def build():
        base = scratch_path(spark, "conf")
        orders = table(spark, sf_dir, "orders")
        tenant = None
        for name, status in CONF_TENANTS.items():
            cond = F.col("o_orderstatus") == status
            tenant = F.when(cond, name) if tenant is None else tenant.when(cond, name)
        serialized = F.col("o_orderpriority").isin(*CONF_SERIALIZED_PRIORITIES)
        value = F.when(serialized, F.concat(
            F.lit('a:2:{s:7:"custkey";i:'), F.col("o_custkey").cast("string"),
            F.lit(';s:6:"status";s:1:"'), F.col("o_orderstatus"), F.lit('";}'))
        ).otherwise(F.lower("o_orderpriority"))
        conf = orders.select(
            F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), value.alias("value"),
            serialized.cast("int").alias("serialize"), F.lit(None).cast("string").alias("name_jp"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("memo"),
            tenant.alias("tenant"), F.year("o_orderdate").alias("export"))
        conf.write.partitionBy("tenant", "export").parquet(base)
        return {name: f"{base}/tenant={name}" for name in CONF_TENANTS}
    return _memo(spark, sf_dir, "conf_tenants", build)


def small_files(spark: SparkSession, sf_dir: str, n_files: int = 200) -> str:
    """``orders`` scattered over ``n_files`` small Parquet files."""
    def build():
        root = scratch_path(spark, "small_files")
        table(spark, sf_dir, "orders").repartition(n_files).write.parquet(root)
        return root
    return _memo(spark, sf_dir, f"small_files_{n_files}", build)


def document_files(spark: SparkSession, sf_dir: str) -> str:
    """Every document's text as a line of a text file under ``lang=<lang>/``."""
    def build():
        root = scratch_path(spark, "document_files")
        table(spark, sf_dir, "documents").select("text", "lang").write.partitionBy("lang").text(root)
        return root
    return _memo(spark, sf_dir, "document_files", build)


def monthly_tenants(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Many tenant tables: ``orders`` split by order month, one write.

    ``base/ym=<yyyymm>/part-*`` → table ``shop_<yyyymm>_order`` (about 80
    tables). The month is a directory, not a data column.
    """
    def build():
        base = scratch_path(spark, "monthly")
        orders = table(spark, sf_dir, "orders")
        orders.withColumn("ym", F.date_format("o_orderdate", "yyyyMM")).write.partitionBy("ym").parquet(base)
        months = [r.ym for r in spark.read.parquet(base).select("ym").distinct().collect()]
        return {f"shop_{m}_order": f"{base}/ym={m}" for m in sorted(months)}
    return _memo(spark, sf_dir, "monthly_tenants", build)


def customer_item_export_keyless(spark: SparkSession, sf_dir: str) -> str:
    """Like ``customer_item_export``, but items with a negative balance lack
    their ``id`` attribute (the key), as a broken export would."""
    def build():
        from tessera.sources.items import export_typed_items
        base = scratch_path(spark, "item_export_keyless")
        c = table(spark, sf_dir, "customer")
        items = c.select(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("id"),
                         F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
                         F.col("c_acctbal").alias("acctbal"),
                         F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("segment"),
                         (F.col("c_acctbal") > 9000).alias("vip"))
        export_typed_items(items, f"{base}/exports/02-customer/data", ITEM_ATTRIBUTES)
        return base
    return _memo(spark, sf_dir, "customer_item_export_keyless", build)
