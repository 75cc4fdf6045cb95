"""Carry a table's secondary indexes as materialised covering projections.

An index = a name, a hash key, an optional range key and a projection:
``ALL`` (every column), ``KEYS_ONLY`` (index keys + table keys) or
``INCLUDE`` (keys + listed columns). Items lacking an index key are not in
the index (sparse index).

Physically the projection is a bucketed table: ``bucketBy(n, hash_key)``
co-locates equal keys, so later joins/aggregations on the hash key skip the
shuffle, and ``sortBy(range_key)`` orders each bucket file. The data is first
rebalanced on the same key into the same ``n`` partitions (Spark's bucket id
and hash partitioning use one hash), so a write task produces one file per
bucket it owns instead of up to ``n`` files per task. ``REBALANCE`` rather
than ``repartition``: AQE splits a partition made big by a hot key across
several tasks (that bucket then has several files) and merges tiny ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import run_parallel

BUCKET_BYTES = 256 << 20
#: Spark's own limit of buckets.
MAX_BUCKETS = 100_000


@dataclass
class IndexSpec:
    name: str
    hash_key: str
    range_key: str | None = None
    projection: str = "ALL"          # ALL | KEYS_ONLY | INCLUDE
    include: Sequence[str] = field(default_factory=tuple)
    kind: str = "global"             # global | local (local shares the table's hash key)


def index_columns(df: DataFrame, spec: IndexSpec, table_keys: Sequence[str]) -> list[str]:
    keys = [spec.hash_key] + ([spec.range_key] if spec.range_key else [])
    keys += [k for k in table_keys if k not in keys]
    if spec.projection == "ALL":
        return keys + [c for c in df.columns if c not in keys]
    if spec.projection == "KEYS_ONLY":
        return keys
    if spec.projection == "INCLUDE":
        return keys + [c for c in spec.include if c not in keys]
    raise ValueError(f"unknown projection {spec.projection!r}")


def index_projection(df: DataFrame, spec: IndexSpec, table_keys: Sequence[str]) -> DataFrame:
    """Rows that carry the index keys, projected to the index's columns."""
    present = F.col(spec.hash_key).isNotNull()
    if spec.range_key:
        present = present & F.col(spec.range_key).isNotNull()
    return df.where(present).select(*index_columns(df, spec, table_keys))


def bucket_count(df: DataFrame) -> int:
    """Buckets of about ``BUCKET_BYTES`` by the planner's size of ``df``, and no fewer than shuffle
    partitions: with fewer, reading the table by its buckets would be less parallel than a shuffle."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MAX_BUCKETS, -(-size // BUCKET_BYTES)))


def write_index(df: DataFrame, spec: IndexSpec, table_keys: Sequence[str], table_name: str,
                buckets: int | None = None, path: str | None = None) -> DataFrame:
    """Materialise the index as a bucketed (and sorted) catalog table."""
    if spec.kind == "local" and spec.hash_key != table_keys[0]:
        raise ValueError(f"local index {spec.name} must share the table's hash key {table_keys[0]}")
    proj = index_projection(df, spec, table_keys)
    buckets = buckets or bucket_count(proj)
    proj = proj.hint("rebalance", buckets, spec.hash_key)
    writer = proj.write.mode("errorifexists").format("parquet").bucketBy(buckets, spec.hash_key)
    if spec.range_key:
        writer = writer.sortBy(spec.range_key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table_name)
    return df.sparkSession.table(table_name)


def write_indexes(df: DataFrame, specs: Sequence[IndexSpec], table_keys: Sequence[str], table_name: Callable[[str], str],
                  path: str | None = None, buckets: int | None = None, max_workers: int = 4) -> dict[str, DataFrame]:
    """All indexes of a table, written concurrently: index name → table."""
    made = run_parallel(lambda s: write_index(df, s, table_keys, table_name(s.name), buckets, path and f"{path}/{s.name}"),
                        specs, max_workers)
    return {s.name: t for s, t in zip(specs, made)}
