"""Queries for the serialized-text column transform.

Serialized inputs are built from the driver's tables with JVM string
functions (lengths via ``octet_length``, i.e. bytes), then normalised.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.normalize import flat_array_json, is_error_json, is_serialized, normalize_column
from tessera.plans.registry import register, table


def _s(col) -> F.Column:
    """``s:<bytes>:"<text>";`` for a string column."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit("s:"), F.octet_length(c).cast("string"), F.lit(':"'), c, F.lit('";'))


def _form(name: str, value: F.Column) -> F.Column:
    return F.struct(F.lit(name).alias("form"), value.alias("value"))


def _order_array() -> F.Column:
    info = F.concat(F.lit("a:2:{i:0;"), _s("o_orderpriority"), F.lit("i:1;"),
                    _s(F.date_format("o_orderdate", "yyyy-MM-dd")), F.lit("}"))
    return F.concat(F.lit('a:3:{s:6:"status";'), _s("o_orderstatus"),
                    F.lit('s:7:"custkey";i:'), F.col("o_custkey").cast("string"), F.lit(";"),
                    F.lit('s:4:"info";'), info, F.lit("}"))


_ORDER_ARRAY_SQL = """'a:3:{s:6:"status";s:1:"' || o_orderstatus || '";s:7:"custkey";i:' || o_custkey
  || ';s:4:"info";a:2:{i:0;s:' || strlen(o_orderpriority) || ':"' || o_orderpriority
  || '";i:1;s:10:"' || strftime(o_orderdate, '%Y-%m-%d') || '";}}'"""


@register("php_detect", f"""
SELECT o_orderkey,
       regexp_matches(CASE o_orderstatus WHEN 'P' THEN {_ORDER_ARRAY_SQL}
                                         WHEN 'F' THEN 'i:' || o_custkey || ';'
                                         ELSE o_orderpriority END, '^(?:[asidOb]:|N;)') AS is_serialized
FROM orders
""")
def php_detect(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    value = (F.when(F.col("o_orderstatus") == "P", _order_array())
              .when(F.col("o_orderstatus") == "F", F.concat(F.lit("i:"), F.col("o_custkey").cast("string"), F.lit(";")))
              .otherwise(F.col("o_orderpriority")))
    return orders.select("o_orderkey", is_serialized(value).alias("is_serialized"))


@register("php_to_json_array", """
SELECT o_orderkey,
       '{"status": "' || o_orderstatus || '", "custkey": ' || o_custkey || ', "info": {"0": "'
       || o_orderpriority || '", "1": "' || strftime(o_orderdate, '%Y-%m-%d') || '"}}' AS value
FROM orders
""")
def php_to_json_array(spark, sf_dir):
    # Nested arrays → JSON objects (list indices become string keys).
    # Dealt out first: parsing costs far more than the scan of a file with one row group.
    orders = table(spark, sf_dir, "orders").select("o_orderkey", _order_array().alias("value"))
    return normalize_column(orders, "value", spread=spark.sparkContext.defaultParallelism)


@register("php_to_json_scalar", """
SELECT c_custkey, 'i' AS form, CAST(c_custkey AS VARCHAR) AS value FROM customer
UNION ALL SELECT c_custkey, 'i+', CAST(c_custkey AS VARCHAR) FROM customer
UNION ALL SELECT c_custkey, 'b', CASE WHEN c_nationkey <> 0 THEN 'true' ELSE 'false' END FROM customer
UNION ALL SELECT c_custkey, 'd', c_nationkey || '.25' FROM customer
UNION ALL SELECT c_custkey, 's', '"' || c_name || '"' FROM customer
UNION ALL SELECT c_custkey, 'N', 'null' FROM customer
""")
def php_to_json_scalar(spark, sf_dir):
    # ``i`` and ``b`` take the native JVM path; ``i+`` (explicit sign and
    # zero padding) the Python path — both must print the same integer.
    c = table(spark, sf_dir, "customer")
    key, nat = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    forms = F.array(
        _form("i", F.concat(F.lit("i:"), key, F.lit(";"))),
        _form("i+", F.concat(F.lit("i:+00"), key, F.lit(";"))),
        _form("b", F.concat(F.lit("b:"), nat, F.lit(";"))),
        _form("d", F.concat(F.lit("d:"), nat, F.lit(".25;"))),
        _form("s", _s("c_name")),
        _form("N", F.lit("N;")),
    )
    rows = c.select("c_custkey", F.inline(forms))
    return normalize_column(rows, "value")


@register("php_to_json_passthrough", """
SELECT c_custkey,
       coalesce(CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN NULL
                                  WHEN 'BUILDING' THEN 'C:' || c_name
                                  WHEN 'AUTOMOBILE' THEN c_name
                                  ELSE c_mktsegment || ' note' END, '') AS value
FROM customer
""")
def php_to_json_passthrough(spark, sf_dir):
    # Null and empty both become ""; text without a gate prefix is unchanged.
    seg = F.col("c_mktsegment")
    value = (F.when(seg == "HOUSEHOLD", F.lit(""))
              .when(seg == "MACHINERY", F.lit(None).cast("string"))
              .when(seg == "BUILDING", F.concat(F.lit("C:"), F.col("c_name")))
              .when(seg == "AUTOMOBILE", F.col("c_name"))
              .otherwise(F.concat(seg, F.lit(" note"))))
    return normalize_column(table(spark, sf_dir, "customer").select("c_custkey", value.alias("value")), "value")


@register("php_to_json_error", """
SELECT c_custkey, 'truncated' AS form, true AS is_error FROM customer
UNION ALL SELECT c_custkey, 'object', true FROM customer
UNION ALL SELECT c_custkey, 'bad_length', true FROM customer
UNION ALL SELECT c_custkey, 'looks_serialized', true FROM customer
""")
def php_to_json_error(spark, sf_dir):
    # Every failure replaces the value with a one-key {"error": …} object.
    c = table(spark, sf_dir, "customer")
    name_len = F.octet_length("c_name")
    forms = F.array(
        _form("truncated", F.concat(F.lit('a:2:{s:4:"name";'), _s("c_name"))),
        _form("object", F.concat(F.lit('O:8:"stdClass":1:{s:4:"name";'), _s("c_name"), F.lit("}"))),
        _form("bad_length", F.concat(F.lit("s:"), (name_len + 5).cast("string"), F.lit(':"'),
                                     F.col("c_name"), F.lit('";'))),
        _form("looks_serialized", F.concat(F.lit("i: "), F.col("c_name"))),
    )
    out = normalize_column(c.select("c_custkey", F.inline(forms)), "value")
    parsed_keys = F.json_object_keys("value")
    return out.select("c_custkey", "form",
                      (is_error_json("value") & (F.size(parsed_keys) == 1)).alias("is_error"))


@register("php_to_json_multibyte", """
SELECT doc_id, lang, n_chars, true AS roundtrip_ok, true AS ascii_only FROM documents
""")
def php_to_json_multibyte(spark, sf_dir):
    # Whole documents (multi-byte text, lengths in bytes) inside an array;
    # the JSON is ASCII-only (\\uXXXX escapes) and decodes back to the text.
    docs = table(spark, sf_dir, "documents")
    value = F.concat(F.lit('a:2:{s:4:"lang";'), _s("lang"), F.lit('s:4:"text";'), _s("text"), F.lit("}"))
    out = normalize_column(docs.select("doc_id", "lang", "n_chars", "text", value.alias("value")), "value")
    back_text = F.get_json_object("value", "$.text")
    back_lang = F.get_json_object("value", "$.lang")
    return out.select("doc_id", "lang", "n_chars",
                      (back_text.eqNullSafe(F.col("text")) & (back_lang == F.col("lang"))).alias("roundtrip_ok"),
                      (~F.col("value").rlike("[^\\x00-\\x7F]")).alias("ascii_only"))


@register("php_job_json", """
SELECT CASE o_orderstatus WHEN 'P' THEN 'alpha_conf' WHEN 'F' THEN 'beta_conf' ELSE 'gamma_conf' END AS source,
       o_orderkey AS id, o_orderpriority AS name,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
            THEN '{"custkey": ' || o_custkey || ', "status": "' || o_orderstatus || '"}'
            ELSE lower(o_orderpriority) END AS value,
       CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS serialize,
       CAST(NULL AS VARCHAR) AS name_jp,
       strftime(o_orderdate, '%Y-%m-%d') AS memo,
       'export=' || year(o_orderdate) AS partition_0
FROM orders
""")
def php_job_json(spark, sf_dir):
    # The column job end to end: the combined conf table from the catalog →
    # ``value`` normalised in place → JSON lines → read back with its schema.
    from tessera.operators.combine import combine_parquet_tables
    from tessera.plans.consolidation import CONF_COLUMNS
    from tessera.plans.fixtures import conf_tenants
    from tessera.plans.q_sources import SCRATCH_DB, scratch_table
    from tessera.session import scratch_path
    from tessera.sinks.files import write_json
    from tessera.sinks.tables import create_table_as
    name, path = scratch_table(spark, "combined_conf_raw")
    combined = combine_parquet_tables(spark, conf_tenants(spark, sf_dir), tag_col="source", partition_levels=1)
    conf = create_table_as(combined.select(*CONF_COLUMNS), f"{SCRATCH_DB}.{name}", path=path)
    out = scratch_path(spark, "conf_json")
    write_json(normalize_column(conf, "value"), out)
    return spark.read.schema(conf.schema).json(out)


@register("php_flat_native", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus <> 'P' THEN '{"status": "' || o_orderstatus || '", "custkey": ' || o_custkey || ', "0": "' || o_orderpriority ||
            '", "open": ' || CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END || ', "memo": null}' END AS value
FROM orders
""")
def php_flat_native(spark, sf_dir):
    # Flat arrays become JSON without a Python stage; what is not flat is left (null) to the parser.
    flat = F.concat(F.lit('a:5:{s:6:"status";'), _s("o_orderstatus"), F.lit('s:7:"custkey";i:'), F.col("o_custkey").cast("string"), F.lit(";i:0;"),
                    _s("o_orderpriority"), F.lit('s:4:"open";b:'), F.when(F.col("o_orderstatus") == "O", "1").otherwise("0"), F.lit(';s:4:"memo";N;}'))
    value = F.when(F.col("o_orderstatus") == "P", _order_array()).otherwise(flat)
    return table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value")).select("o_orderkey", flat_array_json("value").alias("value"))
