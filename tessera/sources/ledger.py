"""A ledger of Parquet files and their schemas: every footer is read once.

Below ``path`` the ledger keeps two appended Parquet tables: ``files`` (file, length, time of change,
schema id) and ``schemas`` (id, schema). An update lists the roots, takes the files it does not know in this
length and age, reads their footers in a distributed job and appends what it found; a file that was
replaced is a new one. Everything asked of the ledger counts the files that are there now.

The schemas of all files are joined as an aggregate (``operators.lattice``): what reaches the driver is the
joined schema, and where types can't be joined the distinct schemas with their folders; never a row per file, except
of folders whose files differ.

Footers are read through pyarrow where it opens the store (``file``, ``hdfs``, ``s3a`` with the session's
``fs.s3a`` settings, and whatever ``viewfs`` mounts of these). Elsewhere Spark hands the files' contents over, which
reads them whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.align import SchemaConflict
from tessera.operators.lattice import Joined, join_places, joined_schema, schema_places
from tessera.session import path_exists

FILES = "path string, length bigint, modified timestamp, schema_id string"
SCHEMAS = "schema_id string, schema string"


# ---- footers -------------------------------------------------------------------------------------

@dataclass
class Store:
    """How a worker opens the files below a root: ``prefix`` of their paths, what it stands for, and S3 settings."""
    prefix: str
    inner: str
    scheme: str
    options: dict

    def open(self):
        """The pyarrow file system."""
        from pyarrow import fs
        if self.scheme == "file":
            return fs.LocalFileSystem()
        if self.scheme == "s3":
            return fs.S3FileSystem(**self.options)
        return fs.FileSystem.from_uri(self.inner)[0]

    def place(self, path: str) -> str:
        """What that file system calls the file Spark lists as ``path``."""
        full = self.inner + path[len(self.prefix):] if path.startswith(self.prefix) else path
        scheme, _, rest = full.partition(":")
        if scheme == "file":
            return "/" + rest.lstrip("/")
        if scheme in ("s3", "s3a", "s3n"):
            return rest[2:]
        return "/" + rest[2:].partition("/")[2]


def s3_options(get) -> dict:
    """pyarrow's S3 settings from Hadoop's (``get`` gives a setting or None)."""
    endpoint = get("fs.s3a.endpoint")
    plain = (get("fs.s3a.connection.ssl.enabled") or "true").lower() == "false" or (endpoint or "").startswith("http://")
    found = {"access_key": get("fs.s3a.access.key"), "secret_key": get("fs.s3a.secret.key"), "session_token": get("fs.s3a.session.token"),
             "region": get("fs.s3a.endpoint.region"), "endpoint_override": endpoint, "scheme": "http" if plain else None}
    return {k: v for k, v in found.items() if v}


def store_of(spark: SparkSession, root: str) -> Store | None:
    """How to open files below ``root`` with pyarrow; None where that can't be done."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(root)
    system = hpath.getFileSystem(conf)
    prefix = system.makeQualified(hpath).toString()
    inner = prefix
    if prefix.startswith("viewfs:"):
        inner = system.resolvePath(hpath).toString()
    scheme = inner.partition(":")[0]
    store = Store(prefix, inner, "s3" if scheme in ("s3", "s3a", "s3n") else scheme, s3_options(conf.get) if scheme.startswith("s3") else {})
    try:
        store.open()
        return store
    except Exception:  # noqa: BLE001 — whatever pyarrow lacks for this store
        return None


def _spark_schema(schema) -> str:
    """Spark's schema of a Parquet file, as JSON: the one Spark wrote, else Arrow's types."""
    from pyspark.sql.pandas.types import from_arrow_schema
    stored = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    text = stored.decode() if stored else from_arrow_schema(schema).json()
    # One text per schema, whoever wrote it.
    return StructType.fromJson(json.loads(text)).json()


def footer_schemas(spark: SparkSession, files: DataFrame, root: str) -> DataFrame:
    """(path, length, modified, schema) of listed files below ``root``."""
    store = store_of(spark, root)
    out = "path string, length bigint, modified timestamp, schema string"
    if store is None:
        def from_contents(batches: Iterator):
            import pyarrow as pa
            import pyarrow.parquet as pq
            for batch in batches:
                batch["schema"] = [_spark_schema(pq.read_schema(pa.BufferReader(c))) for c in batch["content"]]
                yield batch.drop(columns="content")
        contents = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "content")
        return files.join(contents, "path").select("path", "length", "modified", "content").mapInPandas(from_contents, out)

    def from_footers(batches: Iterator):
        import pyarrow.parquet as pq
        system = store.open()
        for batch in batches:
            batch["schema"] = [_spark_schema(pq.read_schema(store.place(p), filesystem=system)) for p in batch["path"]]
            yield batch

    return files.select("path", "length", "modified").mapInPandas(from_footers, out)


def listed(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modified) of the files below ``root``."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .select("path", "length", F.col("modificationTime").alias("modified")))


def listed_by_executors(spark: SparkSession, root: str) -> DataFrame:
    """The same from a listing that does not pass through the driver."""
    from tessera.sources.inventory import list_objects_frontier
    return list_objects_frontier(spark, root).select(F.col("key").alias("path"), F.col("size").alias("length"), F.col("last_modified").alias("modified"))


# ---- the ledger ----------------------------------------------------------------------------------

class SchemaLedger:
    """The ledger below ``path``; any number of roots may share one.

    Roots are listed by Spark's file index unless ``list_files`` is ``listed_by_executors``, for very many files.
    """

    def __init__(self, spark: SparkSession, path: str, list_files=listed):
        self.spark, self.path, self._listed = spark, path.rstrip("/"), list_files

    def _read(self, table: str, schema: str) -> DataFrame:
        at = f"{self.path}/{table}"
        if not path_exists(self.spark, at):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(at)

    def _known(self) -> DataFrame:
        return self._read("files", FILES).dropDuplicates(["path", "length", "modified"])

    def update(self, roots: Mapping[str, str]) -> int:
        """Read the footers of files the ledger does not know; how many those were."""
        read = 0
        for root in dict.fromkeys(roots.values()):
            fresh = self._listed(self.spark, root).join(self._known(), ["path", "length", "modified"], "left_anti")
            seen = Observation()
            found = footer_schemas(self.spark, fresh, root).observe(seen, F.count(F.lit(1)).alias("n"))
            part = uuid.uuid4().hex[:12]
            # Written apart first: footers are read once, whatever is done with them. Each append is one committed
            # folder, the schemas' before the files', so that every file's schema is there.
            stage = f"{self.path}/staged/{part}"
            found.withColumn("schema_id", F.sha2("schema", 256)).write.parquet(stage)
            n = int(seen.get["n"] or 0)
            if n:
                staged = self.spark.read.parquet(stage)
                new = staged.select("schema_id", "schema").dropDuplicates(["schema_id"]).join(
                    self._read("schemas", SCHEMAS).select("schema_id"), "schema_id", "left_anti")
                new.write.parquet(f"{self.path}/schemas/{part}")
                staged.select("path", "length", "modified", "schema_id").write.parquet(f"{self.path}/files/{part}")
            read += n
        return read

    def files(self, roots: Mapping[str, str]) -> DataFrame:
        """(table_name, path, schema_id) of the files that are there now."""
        now = None
        for name, root in roots.items():
            own = self._listed(self.spark, root).withColumn("table_name", F.lit(name))
            now = own if now is None else now.unionByName(own)
        return now.join(self._known(), ["path", "length", "modified"]).select("table_name", "path", "schema_id")

    def schemas(self, roots: Mapping[str, str]) -> DataFrame:
        """(table_name, schema_id, n_files, schema) of the schemas in use."""
        used = self.files(roots).groupBy("table_name", "schema_id").agg(F.count(F.lit(1)).alias("n_files"), F.min("path").alias("first_path"))
        return used.join(self._read("schemas", SCHEMAS).dropDuplicates(["schema_id"]), "schema_id").select(
            "table_name", "schema_id", "n_files", "first_path", "schema")

    def joined(self, roots: Mapping[str, str]) -> Joined:
        """All columns of all files: the first table's first, in each the columns of its first file first."""
        order = {n: k for k, n in enumerate(roots)}
        numbers = self.spark.createDataFrame(list(order.items()), "table_name string, table_order int")
        used = self.schemas(roots).join(numbers, "table_name").select("table_order", "first_path", "schema")
        rows = join_places(schema_places(used), F.struct("table_order", "first_path")).collect()
        return joined_schema(rows)

    def common_schema(self, roots: Mapping[str, str]) -> StructType:
        """As ``joined``; a column without a common type is an error."""
        found = self.joined(roots)
        if found.conflicts:
            raise SchemaConflict(f"columns have types that nothing joins: {found.conflicts}")
        return found.schema

    def groups(self, root: str) -> list[tuple[StructType, list[str]]]:
        """(schema, places to read) per distinct schema below ``root``: folders without folders below them, and single
        files where a folder's differ."""
        files = self.files({"t": root}).withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))
        per_folder = files.groupBy("folder").agg(F.min("schema_id").alias("schema_id"), F.max("schema_id").alias("other"))
        parts = F.split("folder", "/")
        above = per_folder.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/")))
                                  .alias("folder")).distinct()
        whole = per_folder.where("schema_id = other").join(above, "folder", "left_anti")
        single = files.join(whole.select("folder"), "folder", "left_anti").select("schema_id", F.col("path").alias("place"))
        places: dict[str, list[str]] = {}
        for r in whole.select("schema_id", F.col("folder").alias("place")).unionByName(single).orderBy("place").collect():
            places.setdefault(r["schema_id"], []).append(r["place"])
        texts = {r["schema_id"]: r["schema"] for r in self.schemas({"t": root}).collect()}
        return [(StructType.fromJson(json.loads(texts[k])), v) for k, v in places.items()]
