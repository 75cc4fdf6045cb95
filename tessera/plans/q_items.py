"""Queries for typed-attribute exports and index projections."""

from __future__ import annotations

import re

from tessera.operators.indexes import IndexSpec, write_index
from tessera.plans.fixtures import ITEM_ATTRIBUTES, customer_item_export
from tessera.plans.q_sources import SCRATCH_DB, scratch_table
from tessera.plans.registry import register, table
from tessera.sources.items import profile_items, read_typed_items, read_typed_items_raw


@register("typed_items_decode", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS acctbal,
       CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS segment,
       c_acctbal > 9000 AS vip
FROM customer
""")
def typed_items_decode(spark, sf_dir):
    # Known attribute set: explicit nested schema over the gzip export.
    path = customer_item_export(spark, sf_dir)
    return read_typed_items(spark, path, ITEM_ATTRIBUTES,
                            cast={"id": "bigint", "nation": "int", "acctbal": "double"})


@register("typed_items_profile", """
SELECT 'id' AS attribute, 'N' AS type_code, count(*) AS n_items FROM customer
UNION ALL SELECT 'name', 'S', count(*) FROM customer
UNION ALL SELECT 'nation', 'N', count(*) FROM customer
UNION ALL SELECT 'acctbal', 'N', count(*) FROM customer
UNION ALL SELECT 'segment', 'S', count(*) FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
UNION ALL SELECT 'vip', 'BOOL', count(*) FROM customer
""")
def typed_items_profile(spark, sf_dir):
    # Unknown attribute set: generic map form, then items per attribute/type.
    return profile_items(read_typed_items_raw(spark, customer_item_export(spark, sf_dir)))


@register("typed_items_mixed", """
SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE c_mktsegment END AS label,
       CAST(NULL AS BOOLEAN) AS gone, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS INTEGER) END AS nation,
       CASE WHEN c_custkey % 5 = 0 THEN 'nation' ELSE '' END AS misfits
FROM customer
""")
def typed_items_mixed(spark, sf_dir):
    # One attribute is N in some items and S in others, one is NULL, and one has values that are no number.
    from pyspark.sql import functions as F

    from tessera.session import scratch_path
    path = scratch_path(spark, "mixed-items")
    table(spark, sf_dir, "customer").selectExpr("""
        '{"Item":{"id":{"N":"' || c_custkey || '"},"gone":{"NULL":true},"label":{' ||
        CASE WHEN c_custkey % 3 = 0 THEN '"N":"' || c_nationkey ELSE '"S":"' || c_mktsegment END || '"},"nation":{"S":"' ||
        CASE WHEN c_custkey % 5 = 0 THEN 'none' ELSE CAST(c_nationkey AS string) END || '"}}}' AS value""").write.text(path)
    items = read_typed_items(spark, path, {"id": "N", "label": "S", "gone": "NULL", "nation": "N"},
                             cast={"id": "bigint", "nation": "int"}, misfits="misfits")
    return items.withColumn("misfits", F.array_join("misfits", ","))


@register("typed_items_nested", """
SELECT o_orderkey AS id, o_custkey AS customer, o_orderpriority AS priority, CAST(o_orderkey AS VARCHAR) || '.000000000000001234' AS exact,
       o_orderstatus || ',' || o_orderkey AS list, CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS inner_key
FROM orders
""")
def typed_items_nested(spark, sf_dir):
    # Maps and lists decode to plain structs and arrays; numbers keep every digit.
    from pyspark.sql import functions as F

    from tessera.session import scratch_path
    path = scratch_path(spark, "nested-items")
    table(spark, sf_dir, "orders").selectExpr("""
        '{"Item":{"id":{"N":"' || o_orderkey || '"},"exact":{"N":"' || o_orderkey || '.000000000000001234"},"m":{"M":{"customer":{"N":"' ||
        o_custkey || '"},"priority":{"S":"' || o_orderpriority || '"},"more":{"M":{' ||
        CASE WHEN o_orderstatus = 'O' THEN '"k":{"N":"' || o_custkey || '"}' ELSE '' END || '}}}},"l":{"L":[{"S":"' || o_orderstatus ||
        '"},{"N":"' || o_orderkey || '"}]}}}' AS value""").write.text(path)
    items = read_typed_items(spark, path, {"id": "N", "exact": "N", "m": "M", "l": "L"},
                             cast={"id": "bigint", "m": "struct<customer:bigint,priority:string,more:map<string,bigint>>", "l": "array<string>"})
    return items.select("id", "m.customer", "m.priority", "exact", F.array_join("l", ",").alias("list"), F.col("m.more")["k"].alias("inner_key"))


@register("index_all", """
SELECT 'by_customer' AS index_name, o_custkey AS k, o_orderkey, o_totalprice FROM orders
UNION ALL SELECT 'by_priority', o_orderkey, o_orderkey, NULL FROM orders
UNION ALL SELECT 'urgent', o_orderkey, o_orderkey, NULL FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def index_all(spark, sf_dir):
    # All indexes of a table in one call, bucket counts by size; the last is sparse (null keys are left out).
    from pyspark.sql import functions as F

    from tessera.operators.indexes import write_indexes
    orders = table(spark, sf_dir, "orders").withColumn("urgent", F.expr("CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END"))
    specs = [IndexSpec("by_customer", "o_custkey", "o_orderdate", "INCLUDE", ("o_totalprice",)),
             IndexSpec("by_priority", "o_orderkey", "o_orderpriority", "KEYS_ONLY", kind="local"),
             IndexSpec("urgent", "urgent", None, "KEYS_ONLY")]
    prefix, path = scratch_table(spark, "orders_idx")
    made = write_indexes(orders, specs, ["o_orderkey"], lambda n: f"{SCRATCH_DB}.{prefix}_{n}", path=path)
    return (made["by_customer"].selectExpr("'by_customer' AS index_name", "o_custkey AS k", "o_orderkey", "o_totalprice")
            .unionByName(made["by_priority"].selectExpr("'by_priority' AS index_name", "o_orderkey AS k", "o_orderkey"), allowMissingColumns=True)
            .unionByName(made["urgent"].selectExpr("'urgent' AS index_name", "urgent AS k", "o_orderkey"), allowMissingColumns=True))


@register("index_projection", """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
""")
def index_projection_q(spark, sf_dir):
    # A global index on (o_custkey, o_orderdate) including o_totalprice,
    # materialised as a bucketed, sorted table.
    spec = IndexSpec("by_customer", "o_custkey", "o_orderdate", "INCLUDE", ("o_totalprice",))
    name, path = scratch_table(spark, "orders_by_customer")
    return write_index(table(spark, sf_dir, "orders"), spec, ["o_orderkey"], f"{SCRATCH_DB}.{name}",
                       path=path)


@register("typed_items_import", """
SELECT 'customer_items' AS table_name, count(*) FILTER (WHERE c_acctbal >= 0) AS copied,
       count(*) FILTER (WHERE c_acctbal < 0) AS rejected,
       CAST(sum(c_custkey) FILTER (WHERE c_acctbal >= 0) AS BIGINT) AS key_sum
FROM customer
""")
def typed_items_import(spark, sf_dir):
    # Export → import into a keyed table: decode the typed items, copy them
    # into a table bucketed by its key; items without a key go to rejects.
    from pyspark.sql import functions as F

    from tessera.operators.copying import copy_table
    from tessera.plans.fixtures import customer_item_export_keyless
    items = read_typed_items(spark, customer_item_export_keyless(spark, sf_dir), ITEM_ATTRIBUTES,
                             cast={"id": "bigint", "nation": "int", "acctbal": "double"})
    name, path = scratch_table(spark, "customer_items")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    res = copy_table(spark, items, f"{SCRATCH_DB}.{name}", "id", location=path, buckets=buckets)
    imported = spark.table(f"{SCRATCH_DB}.{name}")
    return imported.agg(F.sum("id").cast("bigint").alias("key_sum")).select(
        F.lit("customer_items").alias("table_name"), F.lit(res.copied).cast("bigint").alias("copied"),
        F.lit(res.rejected).cast("bigint").alias("rejected"), "key_sum")


def _order_items(spark, sf_dir, name: str, list_end: str) -> str:
    """Orders as an export: a map with a nested map, a list of text and number, an attribute of two kinds."""
    from tessera.session import scratch_path
    path = scratch_path(spark, name)
    table(spark, sf_dir, "orders").selectExpr(f"""
        '{{"Item":{{"id":{{"N":"' || o_orderkey || '"}},"m":{{"M":{{"customer":{{"N":"' || o_custkey || '"}},"more":{{"M":{{' ||
        CASE WHEN o_orderstatus = 'O' THEN '"k":{{"N":"' || o_custkey || '.25"}}' ELSE '"p":{{"S":"' || o_orderpriority || '"}}' END ||
        '}}}}}}}},"l":{{"L":[{{"N":"' || o_custkey || '"}},' || {list_end} || ']}}}}}}' AS value""").write.text(path)
    return path


@register("typed_items_discover", """
SELECT 'id' AS path, 'N' AS code, count(*) AS n, 'bigint' AS proposed FROM orders
UNION ALL SELECT 'm', 'M', count(*), 'struct<customer:bigint,more:struct<k:decimal,p:string>>' FROM orders
UNION ALL SELECT 'm.customer', 'N', count(*), NULL FROM orders
UNION ALL SELECT 'm.more', 'M', count(*), NULL FROM orders
UNION ALL SELECT 'm.more.k', 'N', count(*), NULL FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'm.more.p', 'S', count(*), NULL FROM orders WHERE o_orderstatus <> 'O'
UNION ALL SELECT 'l', 'L', count(*), 'array<string>' FROM orders
UNION ALL SELECT 'l.[]', 'N', count(*), NULL FROM orders
UNION ALL SELECT 'l.[]', 'S', count(*), NULL FROM orders
UNION ALL SELECT 'decoded', o_orderstatus, CAST(sum(o_custkey) AS BIGINT), NULL FROM orders GROUP BY o_orderstatus
""")
def typed_items_discover(spark, sf_dir):
    # An export whose nested attributes are not known: the places and codes found at every depth, the types proposed
    # for the attributes, and sums of what decodes under them.
    from pyspark.sql import functions as F

    from tessera.sources.items import discover_items, propose_types
    path = _order_items(spark, sf_dir, "discover-items", "'{\"S\":\"' || o_orderstatus || '\"}'")
    found = discover_items(spark, path)
    attributes, cast = propose_types(found)
    # The decimal's size follows the data.
    named = spark.createDataFrame([(a, re.sub(r"\(\d+,\d+\)", "", t.simpleString())) for a, t in cast.items()], "path string, proposed string")
    places = (found.select(F.array_join("path", ".").alias("path"), "code", "n")
              .join(named, "path", "left").select("path", "code", "n", "proposed"))
    decoded = read_typed_items(spark, path, attributes, cast, misfits="misfits")
    sums = decoded.where(F.size("misfits") == 0).groupBy(F.element_at("l", 2).alias("code")).agg(F.sum("m.customer").alias("n"))
    return places.unionByName(sums.select(F.lit("decoded").alias("path"), "code", "n", F.lit(None).cast("string").alias("proposed")))


@register("typed_items_nested_rejects", """
SELECT 'table' AS place, o_orderkey AS id, o_custkey AS customer, NULL AS misfits FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 4 <> 0
UNION ALL SELECT 'rejects', o_orderkey, o_custkey, concat_ws(',', CASE WHEN o_orderstatus <> 'O' THEN 'm.more{p}' END,
                                                             CASE WHEN o_orderkey % 4 = 0 THEN 'l[1]' END)
FROM orders WHERE o_orderstatus <> 'O' OR o_orderkey % 4 = 0
""")
def typed_items_nested_rejects(spark, sf_dir):
    # Import into a keyed table: an item with a value that does not convert, however deep, is a reject that names the place.
    from pyspark.sql import functions as F

    from tessera.operators.keyed import copy_keyed, read_keyed
    path = _order_items(spark, sf_dir, "reject-items", "CASE WHEN o_orderkey % 4 = 0 THEN '{\"N\":\"1.5\"}' ELSE '{\"N\":\"2\"}' END")
    items = read_typed_items(spark, path, {"id": "N", "m": "M", "l": "L"}, misfits="misfits",
                             cast={"id": "bigint", "m": "struct<customer:bigint,more:map<string,decimal(12,2)>>", "l": "array<int>"})
    name, location = scratch_table(spark, "nested_items")
    result = copy_keyed(spark, items, f"{SCRATCH_DB}.{name}", "id", checks={"does not convert": F.size("misfits") > 0}, buckets=8, location=location)
    rejects = spark.read.parquet(result.rejects_path)
    return (read_keyed(spark, f"{SCRATCH_DB}.{name}").select(F.lit("table").alias("place"), "id", "m.customer", F.lit(None).cast("string").alias("misfits"))
            .unionByName(rejects.select(F.lit("rejects").alias("place"), "id", "m.customer", F.array_join("misfits", ",").alias("misfits"))))
