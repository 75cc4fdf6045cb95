"""File sinks: compacted Parquet, JSON lines, text manifests.

File count vs. parallelism: ``coalesce(n)`` narrows the *whole* upstream
stage to n tasks, so a 100 TB scan would run in n tasks. The default here is
``repartition(n)`` (full-width upstream, one extra round-robin exchange) or,
with no count, AQE's ``REBALANCE`` sized by ``target_file_bytes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.session import scoped_conf


TARGET_FILE_BYTES = 256 << 20


def compact_write(df: DataFrame, path: str, num_files: int | None = None, shuffle: bool = True,
                  target_file_bytes: int = TARGET_FILE_BYTES, mode: str = "overwrite", fmt: str = "parquet",
                  max_records_per_file: int | None = None) -> None:
    """Write with a bounded number of output files.

    * ``num_files`` and ``shuffle=False`` — ``coalesce(num_files)``: no
      exchange; only for inputs small enough for that many tasks;
    * ``num_files`` — ``repartition(num_files)``;
    * neither — ``REBALANCE`` with AQE advisory size ``target_file_bytes``:
      the file count follows the data size.
    """
    spark = df.sparkSession
    conf = {}
    if num_files is not None and not shuffle:
        out = df.coalesce(num_files)
    elif num_files is not None:
        out = df.repartition(num_files)
    else:
        out = df.hint("rebalance")
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(target_file_bytes)
    writer = out.write.mode(mode).format(fmt)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    with scoped_conf(spark, conf):
        writer.save(path)


def write_json(df: DataFrame, path: str, mode: str = "append", ignore_null_fields: bool = True,
               compression: str | None = None) -> None:
    """JSON lines, one object per row (Spark drops null fields unless told not to)."""
    writer = df.write.mode(mode).option("ignoreNullFields", str(ignore_null_fields).lower())
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def write_manifest(df: DataFrame, path: str, column: str = "key", mode: str = "errorifexists") -> None:
    """One value per line (a key manifest)."""
    df.select(df[column].cast("string")).write.mode(mode).text(path)
