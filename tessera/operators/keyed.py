"""Keyed tables: puts by key that rewrite only the buckets they touch.

A keyed table is an external Parquet table partitioned by ``<bucket>``, the hash of its bucketing columns
modulo a fixed number (kept in the table's properties). Every bucket's partition has a folder of its own,
so a put reads and writes the buckets of the source's keys alone:

1. the source is read once and written once, routed by verdict (writable or reject) and counted on the way;
2. duplicate keys are looked for in what was written, before the table is touched;
3. the touched buckets' rows whose key is put (or removed) go, the new rows come, into a fresh generation;
4. each touched bucket is pointed at its new folder; then its old folder is deleted.

A bucket is replaced as a whole. A job that dies between two buckets leaves some with the new rows and
some with the old ones; running it again puts the same rows by key and ends in the same table, and
``sweep`` deletes folders that no bucket points at.

Secondary indexes can be kept up by the copy: it pairs the old and the new row of each put key, and only
pairs whose index entry differs reach the index, itself a keyed table bucketed by the index's hash key.

The anti join and the change set compare the whole key, so a hash key that many rows share does not gather
in one task there; the write rebalances by bucket, and a bucket swollen by such a hash key becomes several files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tessera.operators.copying import DuplicateKeys, _keys, flag_rows, latest_per_key
from tessera.operators.fitting import free_name
from tessera.operators.indexes import IndexSpec, index_columns, index_projection
from tessera.session import RUNTIME_BROADCAST_ONLY, run_parallel, scoped_conf, scratch_path

_PROPERTY = "tessera.keyed"


@dataclass
class KeyedTable:
    """``keys`` name a row, ``bucket_by`` (some of them) its bucket; ``bucket`` is the partition column."""
    name: str
    keys: list[str]
    bucket_by: list[str]
    buckets: int
    bucket: str
    location: str

    def bucket_of(self) -> Column:
        """Bucket of a row, from its bucketing columns."""
        return F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in self.bucket_by)), F.lit(self.buckets)).cast("int")


@dataclass
class KeyedCopyResult:
    table: str
    rejects_path: str
    copied: int
    rejected: int
    rewritten: int
    kept: int


def _literal(text: str) -> str:
    """``text`` as a string of Spark's SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if it is not there."""
    fs, hpath = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()] if fs.exists(hpath) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def create_keyed_table(spark: SparkSession, name: str, schema: StructType, key: str | Sequence[str], buckets: int,
                       location: str | None = None, bucket_by: Sequence[str] | None = None) -> KeyedTable:
    """An empty keyed table. The bucket column gets a name that ``schema`` does not have."""
    keys = _keys(key)
    spread = list(bucket_by or keys)
    if not set(spread) <= set(keys):
        raise ValueError(f"bucketing columns {spread} are not all part of the key {keys}")
    location = (location or scratch_path(spark, name.replace(".", "_").replace("`", ""))).rstrip("/")
    bucket = free_name(schema.names, "key_bucket")
    empty = spark.createDataFrame([], StructType([*schema.fields, StructField(bucket, IntegerType())]))
    empty.write.mode("errorifexists").format("parquet").partitionBy(bucket).option("path", location).saveAsTable(name)
    spec = json.dumps({"keys": keys, "bucket_by": spread, "buckets": buckets, "bucket": bucket, "location": location})
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_PROPERTY}' = {_literal(spec)})")
    return KeyedTable(name, keys, spread, buckets, bucket, location)


def keyed_table(spark: SparkSession, name: str) -> KeyedTable:
    """The layout of an existing keyed table."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if _PROPERTY not in found:
        raise ValueError(f"{name} is not a keyed table")
    return KeyedTable(name, **json.loads(found[_PROPERTY]))


def read_keyed(spark: SparkSession, table: KeyedTable | str, keys: Mapping[str, object] | None = None) -> DataFrame:
    """The table's rows without the bucket column; with a value for each bucketing column, of that bucket alone."""
    table = keyed_table(spark, table) if isinstance(table, str) else table
    rows = spark.table(table.name)
    if keys:
        for c, v in keys.items():
            rows = rows.where(F.col(f"`{c}`") == F.lit(v))
        if set(table.bucket_by) <= set(keys):
            types = {f.name: f.dataType for f in rows.schema.fields}
            one = spark.range(1).select(*(F.lit(keys[c]).cast(types[c]).alias(c) for c in table.bucket_by))
            rows = rows.where(F.col(table.bucket) == one.select(table.bucket_of().alias("b")).first()["b"])
    return rows.drop(table.bucket)


def _bucket_locations(spark: SparkSession, table: KeyedTable, buckets: Sequence[int]) -> dict[int, str]:
    """Folders of those of ``buckets`` that the table has."""
    have = {int(r["partition"].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {table.name}").collect()}

    def where(b):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table.name} PARTITION (`{table.bucket}` = {b})").collect()
        return b, next(r["data_type"] for r in rows if r["col_name"] == "Location")

    return dict(run_parallel(where, [b for b in buckets if b in have]))


def _repoint(spark: SparkSession, table: KeyedTable, generation: str, touched: Sequence[int]) -> None:
    """Point each touched bucket at its folder in the generation (drop it if it has none), and delete the old ones."""
    filled = {int(f.split("=", 1)[1]) for f in _folders(spark, generation) if f.startswith(f"{table.bucket}=")}
    before = _bucket_locations(spark, table, touched)
    for b in touched:
        at = f"PARTITION (`{table.bucket}` = {b})"
        to = f"LOCATION {_literal(f'{generation}/{table.bucket}={b}')}"
        if b in filled and b in before:
            spark.sql(f"ALTER TABLE {table.name} {at} SET {to}")
        elif b in filled:
            spark.sql(f"ALTER TABLE {table.name} ADD {at} {to}")
        elif b in before:
            spark.sql(f"ALTER TABLE {table.name} DROP {at}")
    spark.sql(f"REFRESH TABLE {table.name}")
    run_parallel(lambda path: _delete(spark, path), before.values())


def rewrite_buckets(spark: SparkSession, table: KeyedTable, added: DataFrame, removed: DataFrame | None = None) -> list[int]:
    """Put ``added`` rows by key and remove the rows with ``removed`` keys; returns the touched buckets.

    ``added`` has the table's columns and at most one row per key; both inputs are read more than once, so they
    should be written tables. What is read and written of the table is the buckets of these keys.
    """
    gone = added.select(*table.keys)
    if removed is not None:
        gone = gone.unionByName(removed.select(*table.keys))
    gone = gone.distinct().withColumn(table.bucket, table.bucket_of())
    # One number per touched bucket.
    touched = sorted(r[0] for r in gone.select(table.bucket).distinct().collect())
    if not touched:
        return []
    current = spark.table(table.name)
    if len(touched) < table.buckets:
        current = current.where(F.col(table.bucket).isin(touched))
    kept = current.join(gone, [table.bucket, *table.keys], "left_anti")
    rows = kept.unionByName(added.withColumn(table.bucket, table.bucket_of()), allowMissingColumns=True)
    generation = f"{table.location}/gen-{uuid.uuid4().hex[:12]}"
    with scoped_conf(spark, RUNTIME_BROADCAST_ONLY):
        rows.hint("rebalance", table.bucket).write.mode("errorifexists").partitionBy(table.bucket).parquet(generation)
    _repoint(spark, table, generation, touched)
    return touched


def sweep(spark: SparkSession, table: KeyedTable | str) -> int:
    """Delete the generations' folders that no bucket points at (left by jobs that died); how many there were.

    Not to be run beside a copy into the same table.
    """
    table = keyed_table(spark, table) if isinstance(table, str) else table
    used = {"/".join(path.rstrip("/").rsplit("/", 2)[1:]) for path in _bucket_locations(spark, table, range(table.buckets)).values()}
    deleted = 0
    for generation in _folders(spark, table.location):
        if not generation.startswith("gen-"):
            continue
        inside = [f for f in _folders(spark, f"{table.location}/{generation}") if f.startswith(f"{table.bucket}=")]
        unused = [f for f in inside if f"{generation}/{f}" not in used]
        for f in unused:
            _delete(spark, f"{table.location}/{generation}/{f}")
        if len(unused) == len(inside):
            _delete(spark, f"{table.location}/{generation}")
        deleted += len(unused)
    return deleted


def create_keyed_index(spark: SparkSession, table: KeyedTable | str, spec: IndexSpec, name: str, buckets: int,
                       location: str | None = None) -> KeyedTable:
    """A secondary index of a keyed table as a keyed table of its own, filled from the table's rows."""
    table = keyed_table(spark, table) if isinstance(table, str) else table
    rows = read_keyed(spark, table)
    own = [c for c in (spec.hash_key, spec.range_key) if c]
    keys = [*own, *(k for k in table.keys if k not in own)]
    projected = index_projection(rows, spec, table.keys)
    index = create_keyed_table(spark, name, projected.schema, keys, buckets, location, bucket_by=[spec.hash_key])
    rewrite_buckets(spark, index, projected)
    return index


def _index_changes(changes: DataFrame, spec: IndexSpec, keys: Sequence[str], side: str, other: str, columns: Sequence[str]) -> DataFrame:
    """Index rows of ``side`` (old or new) that are not the other side's."""
    names = [spec.hash_key, *([spec.range_key] if spec.range_key else [])]

    def image(of):
        present = F.lit(True)
        for c in names:
            present = present & F.col(f"{of}.`{c}`").isNotNull()
        return F.when(present, F.struct(*(F.col(f"{of}.`{c}`").alias(c) for c in columns)))

    mine = changes.select(image(side).alias("mine"), image(other).alias("theirs"))
    return mine.where(F.col("mine").isNotNull() & ~F.col("mine").eqNullSafe(F.col("theirs"))).select("mine.*")


def copy_keyed(spark: SparkSession, source: DataFrame, target: str, key: str | Sequence[str],
               checks: Mapping[str, Column] | None = None, order_by: str | None = None, buckets: int = 64,
               location: str | None = None, indexes: Mapping[str, IndexSpec] | None = None) -> KeyedCopyResult:
    """Put ``source``'s rows by key into the keyed table ``target`` (created if absent, with ``buckets``).

    Values are converted to the target's types; rows without a key, that fail a check or that have a value the
    target does not hold exactly are rejects, with a reason. With ``order_by`` the latest row per key counts,
    otherwise a key that comes twice is an error and nothing is changed. A column that the target lacks
    is added to it; one that the source lacks is null in its rows. ``indexes`` (keyed index table → spec) are
    kept up with what the copy changes.
    """
    exists = spark.catalog.tableExists(target)
    keys = _keys(key)
    table = keyed_table(spark, target) if exists else None
    if table is not None and sorted(table.keys) != sorted(keys):
        raise ValueError(f"{target} is keyed by {table.keys}, not by {keys}")
    schema = read_keyed(spark, table).schema if exists else None
    why, flagged, fitted = flag_rows(source, schema, key, checks)
    base = scratch_path(spark, "keyed-copy")
    verdict = free_name([*flagged.columns], "writable")
    seen = Observation()
    counted = flagged.withColumn(verdict, F.col(why).isNull()).observe(
        seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col(why).isNull()).alias("ok"))
    counted.write.partitionBy(verdict).parquet(f"{base}/staged")
    n_all, n_good = int(seen.get["n"] or 0), int(seen.get["ok"] or 0)
    staged = spark.read.schema(StructType([*flagged.schema.fields, StructField(verdict, counted.schema[verdict].dataType)])).parquet(f"{base}/staged")
    good = staged.where(F.col(verdict)).select(*(F.col(f"`{c}`") for c in source.columns))
    bad = staged.where(~F.col(verdict)).select(*fitted.originals, F.col(why).alias(free_name(source.columns, "reason")))
    if order_by:
        latest_per_key(good, keys, order_by).write.parquet(f"{base}/latest")
        good = spark.read.schema(good.schema).parquet(f"{base}/latest")
    else:
        n = free_name(keys, "n")
        twice = good.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).limit(1).collect()
        if twice:
            raise DuplicateKeys(f"duplicate key in copy source for {target}: { {k: twice[0][k] for k in keys} }")
    rejects_path = f"{base}/rejects"
    bad.write.parquet(rejects_path)
    if table is None:
        table = create_keyed_table(spark, target, good.schema, keys, buckets, location)
    else:
        known = {c.lower() for c in spark.table(target).columns}
        fresh = [f for f in good.schema.fields if f.name.lower() not in known]
        if fresh:
            spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in fresh)})")
    changes = _changes(spark, table, good, f"{base}/changes") if indexes else None
    touched = rewrite_buckets(spark, table, good)
    for name, spec in (indexes or {}).items():
        index = keyed_table(spark, name)
        columns = index_columns(read_keyed(spark, table), spec, table.keys)
        new = _index_changes(changes, spec, table.keys, "new", "old", columns)
        old = _index_changes(changes, spec, table.keys, "old", "new", columns)
        rewrite_buckets(spark, index, new, removed=old)
    return KeyedCopyResult(target, rejects_path, n_good, n_all - n_good, len(touched), table.buckets - len(touched))


def _changes(spark: SparkSession, table: KeyedTable, good: DataFrame, path: str) -> DataFrame:
    """(old, new) of every put key, written: ``old`` is null for a key that the table lacks.

    Only the buckets of the put keys are read. Where the source lacks a column, the new row has null there.
    """
    columns = read_keyed(spark, table).columns
    put = good.select(*(F.col(f"`{c}`") if c in good.columns else F.lit(None).alias(c) for c in columns)).withColumn(table.bucket, table.bucket_of())
    touched = [r[0] for r in put.select(table.bucket).distinct().collect()]
    whole = lambda: F.struct(*(F.col(f"`{c}`") for c in columns))
    on = [table.bucket, *table.keys]
    old = spark.table(table.name).where(F.col(table.bucket).isin(touched)).select(*on, whole().alias("old"))
    new = put.select(*on, whole().alias("new"))
    with scoped_conf(spark, RUNTIME_BROADCAST_ONLY):
        new.join(old, on, "left").select("old", "new").write.parquet(path)
    return spark.read.parquet(path)
