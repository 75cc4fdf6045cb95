"""Catalog sources: named tables and table enumeration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, db: str, name: str) -> DataFrame:
    """``FROM "db"."table"``."""
    return spark.table(f"`{db}`.`{name}`")


def list_table_names(spark: SparkSession, db: str) -> list[str]:
    """Table names of one database (driver-side catalog metadata)."""
    return [t.name for t in spark.catalog.listTables(db)]


def tables_by_suffix(spark: SparkSession, db: str, suffix: str, exclude=()) -> dict[str, DataFrame]:
    """Every table of ``db`` whose name ends in ``suffix``, as DataFrames."""
    from tessera.operators.combine import match_suffix
    return {n: read_table(spark, db, n) for n in match_suffix(list_table_names(spark, db), suffix, exclude)}


def parquet_location(spark: SparkSession, db: str, name: str) -> str | None:
    """Folder of a plain (neither partitioned nor bucketed) Parquet table, else None."""
    rows = {}
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED `{db}`.`{name}`").collect():
        rows.setdefault(r.col_name, r.data_type)
    plain = (rows.get("Provider") or "").lower() == "parquet" and "# Partition Information" not in rows and "Num Buckets" not in rows
    return rows.get("Location") if plain else None
