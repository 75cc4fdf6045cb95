"""Incremental snapshots: a repository of files by content, and snapshots that refer to them.

Below ``base``::

    blobs/<sha256>              one file of some table, as it was
    snapshots/<name>/files/     table_name, file (below the table's root), length, modified, source, blob
    snapshots/<name>/tables/    table_name, schema_json, recursive

A snapshot lists the tables' files. A file that an earlier snapshot has, in this place, length and age, is taken
over by reference; of the others each is streamed once into a blob named by its content, and a content that is
there already is not kept twice. So a snapshot costs what changed. ``files`` is written last and finishes
it; one that died is simply taken again.

Dropping a snapshot removes its references; ``sweep_blobs`` then marks the blobs that the remaining snapshots
refer to and deletes the others. It must not run beside a snapshot that is being taken.

Files are copied by the executors, in pieces, through pyarrow (see ``sources.ledger`` for the stores).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.keyed import _delete, _folders
from tessera.operators.snapshot import pattern_filter
from tessera.session import path_exists, scratch_path
from tessera.sources.files import location, read_parquet_tree
from tessera.sources.ledger import Store, listed, store_of

FILES = "table_name string, file string, length bigint, modified timestamp, source string, blob string"
TABLES = "table_name string, schema_json string, recursive boolean"
_PIECE = 8 << 20


@dataclass
class SnapshotReport:
    """Files of a snapshot, and those that had to be copied."""
    name: str
    files: int
    copied: int


def _store(spark: SparkSession, path: str) -> Store:
    spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(
        spark._jvm.org.apache.hadoop.fs.Path(path))
    store = store_of(spark, path)
    if store is None:
        raise ValueError(f"{path} lies in a store that pyarrow does not open")
    return store


def _names(spark: SparkSession, base: str) -> list[str]:
    """Finished snapshots."""
    root = f"{base.rstrip('/')}/snapshots"
    return sorted(n for n in _folders(spark, root) if path_exists(spark, f"{root}/{n}/files/_SUCCESS"))


def _references(spark: SparkSession, base: str, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], FILES)
    return spark.read.schema(FILES).parquet(*(f"{base.rstrip('/')}/snapshots/{n}/files" for n in names))


def _schema_of(spark: SparkSession, root: str) -> tuple[StructType, bool]:
    """Columns of a table's files; whether its folders are no partitions."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(root).schema, False
    except Exception:  # noqa: BLE001 — folders that are not named k=v
        return read_parquet_tree(spark, root).schema, True


def take_snapshot(spark: SparkSession, roots: Mapping[str, str], base: str, name: str) -> SnapshotReport:
    """Add snapshot ``name`` of the Parquet tables ``roots`` (table name → folder) to the repository ``base``."""
    base = base.rstrip("/")
    at = f"{base}/snapshots/{name}"
    if path_exists(spark, f"{at}/files/_SUCCESS"):
        raise FileExistsError(f"snapshot {name!r} already exists under {base}")
    blobs = _store(spark, f"{base}/blobs")
    known = (_references(spark, base, _names(spark, base)).groupBy("source", "length", "modified").agg(F.min("blob").alias("blob")))
    parts, tables = [], []
    for table, root in roots.items():
        schema, recursive = _schema_of(spark, root)
        tables.append((table, schema.json(), recursive))
        own, store = location(spark, root), store_of(spark, root)
        if store is None:
            raise ValueError(f"{root} lies in a store that pyarrow does not open")
        files = (listed(spark, root).withColumnRenamed("path", "source").join(known, ["source", "length", "modified"], "left")
                 .withColumn("table_name", F.lit(table)))
        parts.append(_copied(files, store, own, blobs))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    staged = scratch_path(spark, "snapshot")
    out.write.parquet(staged)
    done = spark.read.parquet(staged)
    counts = done.agg(F.count(F.lit(1)).alias("n"), F.count_if("copied").alias("c")).first()
    spark.createDataFrame(tables, TABLES).coalesce(1).write.mode("overwrite").parquet(f"{at}/tables")
    done.drop("copied").write.mode("overwrite").parquet(f"{at}/files")
    return SnapshotReport(name, int(counts["n"]), int(counts["c"] or 0))


def _copied(files: DataFrame, store: Store, root: str, blobs: Store) -> DataFrame:
    """``FILES`` of a table's listed files, and ``copied``: those without a blob are streamed into one."""
    def run(batches):
        import hashlib

        import pandas as pd
        from pyarrow import fs
        source_fs, blob_fs = store.open(), blobs.open()
        for batch in batches:
            made = []
            for path, blob in zip(batch["source"], batch["blob"]):
                if isinstance(blob, str):
                    made.append((blob, False))
                    continue
                digest = hashlib.sha256()
                partial = blobs.place(f"{blobs.prefix}/.partial-{uuid.uuid4().hex}")
                with source_fs.open_input_stream(store.place(path)) as src, blob_fs.open_output_stream(partial) as out:
                    while piece := src.read(_PIECE):
                        digest.update(piece)
                        out.write(piece)
                blob = digest.hexdigest()
                final = blobs.place(f"{blobs.prefix}/{blob}")
                there = blob_fs.get_file_info(final).type == fs.FileType.File
                if there:
                    blob_fs.delete_file(partial)
                else:
                    blob_fs.move(partial, final)  # a task run twice moves the same content there
                made.append((blob, not there))
            yield pd.DataFrame({"table_name": batch["table_name"], "source": batch["source"], "length": batch["length"], "modified": batch["modified"],
                                "blob": pd.Series([b for b, _ in made], dtype=object), "copied": [c for _, c in made]})

    # One row per file: spread by file, so that a few large ones do not meet in a task.
    spread = files.select("table_name", "source", "length", "modified", "blob").repartition(F.xxhash64("source"))
    done = spread.mapInPandas(run, "table_name string, source string, length bigint, modified timestamp, blob string, copied boolean")
    # A file's place below its root; Spark may write a local root with one slash or three.
    inner = F.regexp_replace("source", r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?/*", "/")
    own = "/" + root.split("://", 1)[-1].partition("/")[2].strip("/") + "/"
    return done.select("table_name", F.substring(inner, len(own) + 1, 1 << 20).alias("file"), "length", "modified", "source", "blob", "copied")


def list_snapshots(spark: SparkSession, base: str) -> DataFrame:
    """snapshot, table_name, n_files, n_bytes of the finished snapshots."""
    out = spark.createDataFrame([], "snapshot string, table_name string, n_files bigint, n_bytes bigint")
    for n in _names(spark, base):
        own = _references(spark, base, [n]).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
        out = out.unionByName(own.select(F.lit(n).alias("snapshot"), "table_name", "n_files", "n_bytes"))
    return out


def restore_files(spark: SparkSession, base: str, name: str, to: str, indices: str = "*") -> dict[str, DataFrame]:
    """Copy the files of the tables matching ``indices`` back below ``to/<table>`` and read them.

    The files are those that the snapshot saw, byte for byte and in their folders. ``to`` must not hold these tables yet.
    """
    base, to = base.rstrip("/"), to.rstrip("/")
    if name not in _names(spark, base):
        raise FileNotFoundError(f"no snapshot {name!r} under {base}")
    tables = spark.read.schema(TABLES).parquet(f"{base}/snapshots/{name}/tables").where(pattern_filter(indices)).orderBy("table_name").collect()
    for t in tables:
        if path_exists(spark, f"{to}/{t['table_name']}"):
            raise FileExistsError(f"{to}/{t['table_name']} exists")
    blobs, target = _store(spark, f"{base}/blobs"), _store(spark, to)

    def run(batches):
        import posixpath

        import pandas as pd
        blob_fs, target_fs = blobs.open(), target.open()
        for batch in batches:
            for table, file, blob in zip(batch["table_name"], batch["file"], batch["blob"]):
                final = target.place(f"{target.prefix}/{table}/{file}")
                target_fs.create_dir(posixpath.dirname(final), recursive=True)
                partial = posixpath.join(posixpath.dirname(final), f".partial-{uuid.uuid4().hex}")
                with blob_fs.open_input_stream(blobs.place(f"{blobs.prefix}/{blob}")) as src, target_fs.open_output_stream(partial) as out:
                    while piece := src.read(_PIECE):
                        out.write(piece)
                target_fs.move(partial, final)
            yield pd.DataFrame({"file": batch["file"]})

    wanted = _references(spark, base, [name]).where(pattern_filter(indices)).select("table_name", "file", "blob")
    # The copying is the job; what it returns is written so that each file is copied once.
    wanted.repartition(F.xxhash64("table_name", "file")).mapInPandas(run, "file string").write.parquet(scratch_path(spark, "restored"))
    out = {}
    for t in tables:
        schema = StructType.fromJson(json.loads(t["schema_json"]))
        reader = spark.read.schema(schema).option("recursiveFileLookup", str(t["recursive"]).lower())
        at = f"{to}/{t['table_name']}"
        out[t["table_name"]] = reader.parquet(at) if path_exists(spark, at) else spark.createDataFrame([], schema)
    return out


def drop_snapshot(spark: SparkSession, base: str, name: str) -> None:
    """Forget a snapshot; ``sweep_blobs`` frees what no other refers to."""
    if name not in _names(spark, base):
        raise FileNotFoundError(f"no snapshot {name!r} under {base}")
    root = f"{base.rstrip('/')}/snapshots/{name}"
    _delete(spark, f"{root}/files")   # from here on it is no snapshot any more
    _delete(spark, root)


def sweep_blobs(spark: SparkSession, base: str) -> int:
    """Delete the blobs that no snapshot refers to, and what interrupted copies left; how many there were."""
    from tessera.sources.inventory import list_objects_frontier
    base = base.rstrip("/")
    blobs = _store(spark, f"{base}/blobs")
    marked = _references(spark, base, _names(spark, base)).select("blob").distinct()
    there = list_objects_frontier(spark, f"{base}/blobs", hidden=True).select("key", F.regexp_extract("key", r"([^/]*)$", 1).alias("blob"))

    def run(batches):
        import pandas as pd
        system = blobs.open()
        for batch in batches:
            for key in batch["key"]:
                system.delete_file(blobs.place(key))
            yield pd.DataFrame({"key": batch["key"]})

    gone = scratch_path(spark, "swept")
    unused = there.join(marked, "blob", "left_anti").where(~F.col("blob").endswith(".crc")).select("key")
    unused.mapInPandas(run, "key string").write.parquet(gone)
    return spark.read.schema("key string").parquet(gone).count()
