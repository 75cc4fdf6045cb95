"""Catalog sinks: create-table-as-select into a named database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """Create ``db`` if missing; ``location`` defaults to the shared checkpoint folder.

    (Without a location Spark would put the database under the warehouse
    folder, by default ``./spark-warehouse`` of the driver's working directory.)
    """
    if location is None:
        from tessera.session import checkpoint_root
        location = f"{checkpoint_root(spark)}/tessera/warehouse/{db}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{location}'")


def create_table_as(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet",
                    mode: str = "errorifexists", partition_by: list[str] | None = None) -> DataFrame:
    """``CREATE TABLE name AS <df>``: fails if the table exists (no IF NOT EXISTS).

    ``path`` makes it an external table at a chosen location (the SQL
    engine's output location). Returns the new table, read from the catalog.
    """
    writer = df.write.mode(mode).format(fmt)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
