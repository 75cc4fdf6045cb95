"""Object listings as relations: an inventory table, or a file-system listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_objects(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``key, size, last_modified`` for every file under ``path``.

    The ``binaryFile`` source lists files in parallel; selecting only the
    metadata columns keeps file contents unread. A listing has no storage
    class — for that, read the store's inventory table instead.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("path").alias("key"), F.col("length").alias("size"),
                                    F.col("modificationTime").alias("last_modified"))


def list_objects_frontier(spark: SparkSession, path: str, hidden: bool = False) -> DataFrame:
    """``key, size, last_modified`` for every file under ``path``, listed by the executors.

    Breadth first: each round lists the folders the one before found, spread over the tasks, and is written as a
    table, so neither files nor folders pass through the driver, and a lost executor costs its part of one
    round. One folder's own entries are listed by one task. Names that begin with ``_`` or ``.`` are left out, as Spark's
    readers do, unless ``hidden``. Needs a store that pyarrow opens (see ``sources.ledger``).
    """
    from tessera.session import scratch_path
    from tessera.sources.ledger import store_of
    store = store_of(spark, path)
    if store is None:
        raise ValueError(f"{path} lies in a store that only Spark can list: use list_objects or an inventory table")
    base, depth = scratch_path(spark, "listing"), 0
    schema = "key string, folder boolean, size bigint, last_modified timestamp"

    def entries(batches):
        import pandas as pd
        from pyarrow import fs
        system = store.open()
        for batch in batches:
            for key in batch["key"]:
                at = store.place(key)
                rows = []
                for e in system.get_file_info(fs.FileSelector(at)):
                    if e.base_name and (hidden or not e.base_name.startswith(("_", "."))):
                        folder = e.type == fs.FileType.Directory
                        rows.append((f"{key.rstrip('/')}/{e.base_name}", folder, None if folder else e.size, None if folder else e.mtime))
                for start in range(0, len(rows), 10_000):
                    part = pd.DataFrame(rows[start:start + 10_000], columns=["key", "folder", "size", "last_modified"], dtype=object)
                    # Milliseconds, as Hadoop's listings have them.
                    yield part.assign(last_modified=pd.to_datetime(part["last_modified"], utc=True).dt.floor("ms"))

    frontier = spark.createDataFrame([(store.prefix,)], "key string")
    while True:
        level = f"{base}/level={depth}"
        frontier.mapInPandas(entries, schema).write.parquet(level)
        found = spark.read.schema(schema).parquet(level)
        if found.where("folder").isEmpty():
            break
        frontier, depth = found.where("folder").select("key").repartition(F.xxhash64("key")), depth + 1
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(base).where("NOT folder").drop("folder")


def cold_object_keys(inventory: DataFrame, storage_class: str = "GLACIER") -> DataFrame:
    """``Contents[?StorageClass=='GLACIER'].{Key: Key}``."""
    return inventory.where(F.col("storage_class") == storage_class).select("key")


def keys_by_prefix(inventory: DataFrame, prefix: str) -> DataFrame:
    """Objects whose key starts with ``prefix`` (a listing's ``Prefix=``)."""
    return inventory.where(F.col("key").startswith(prefix))
