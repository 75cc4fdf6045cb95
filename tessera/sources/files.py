"""File sources: recursive Parquet trees, path-derived columns, text lines.

* ``read_parquet_tree``  — every Parquet file under a root, at any depth.
* ``decoded_file_path``  — ``_metadata.file_path`` with URI escapes undone and
  the scheme/authority removed, so it can be compared to plain root paths.
* ``with_path_partitions`` — ``partition_0 … partition_{k-1}``: the un-named
  directory levels between a table root and its files (a crawler's names).
* ``tag_from_path``      — the table a row came from, in one multi-root scan.
* ``packed_scan``        — scoped small-file packing settings.
* ``read_lines``         — one string per line (a key manifest).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.session import scoped_conf, scratch_path

# Tables whose root → name lookup is larger than this are joined by shuffle.
LOOKUP_BROADCAST_BYTES = 32 << 20
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"
_SCHEME_OPT = r"^([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?)?"


def read_parquet_tree(spark: SparkSession, paths: str | Sequence[str],
                      schema: StructType | str | None = None) -> DataFrame:
    """Read all Parquet files below ``paths`` (sub-folders need not be named ``k=v``).

    Without a ``schema`` the columns are those of all files together (a column that only some
    files have is null elsewhere): Spark merges the footers in a distributed job.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    if isinstance(paths, str):
        paths = [paths]
    return reader.parquet(*paths)


def is_merge_conflict(exc: Exception) -> bool:
    """Whether reading failed because files disagree on a column's type."""
    return "CANNOT_MERGE_SCHEMAS" in str(exc)


def literal_path(path: str) -> str:
    """``path`` as a pattern that matches itself alone."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)


def read_parquet_groups(spark: SparkSession, root: str, ledger=None) -> list[DataFrame]:
    """One frame per group of files below ``root`` whose column types agree; one in all, as a rule.

    Only when the footers cannot be merged (a column changed its type between batches) are files grouped by
    schema, with a ``SchemaLedger`` (a passing one unless given): a distributed job reads the footers that it does not know.
    """
    try:
        return [read_parquet_tree(spark, root)]
    except Exception as exc:  # noqa: BLE001 — raised again unless it is a merge conflict
        if not is_merge_conflict(exc):
            raise
    from tessera.sources.ledger import SchemaLedger
    ledger = ledger or SchemaLedger(spark, scratch_path(spark, "schema-ledger"))
    ledger.update({"t": root})
    return [spark.read.schema(schema).parquet(*map(literal_path, places)) for schema, places in ledger.groups(root)]


def location(spark: SparkSession, path: str) -> str:
    """``scheme://authority/path`` of a root, as the rows' file paths are compared."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    full = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hpath).toString()
    scheme, rest = full.split(":", 1)
    authority, _, inner = rest[2:].partition("/") if rest.startswith("//") else ("", "", rest.lstrip("/"))
    return f"{scheme}://{authority}/{inner}".rstrip("/") if inner else f"{scheme}://{authority}"


def plain_path(path: str) -> str:
    """Drop scheme and authority: ``file:///a/b`` → ``/a/b``; ``s3a://bkt/a`` → ``/a``."""
    p = re.sub(_SCHEME, "", path)
    p = re.sub("/+", "/", p)
    return p.rstrip("/") or "/"


def _decode(c: Column) -> Column:
    # url_decode also maps '+' to a space; a literal '+' in a file URI is kept
    # as '+', so protect it first.
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def decoded_file_path() -> Column:
    """Per-row source file as a plain, decoded path (``%20`` → space, ``%25`` → ``%``)."""
    return F.regexp_replace(_decode(F.col("_metadata.file_path")), _SCHEME, "")


def path_segment(index: int) -> Column:
    """The ``index``-th directory name (0 = first below ``/``) of each row's file.

    One regex over the encoded path, then decoding of that short segment
    only; null when the file sits above that level. The file name itself is
    never a directory segment.
    """
    pattern = _SCHEME_OPT + r"(?:/[^/]*){%d}/([^/]+)/" % index
    seg = F.regexp_extract(F.col("_metadata.file_path"), pattern, 2)
    return F.when(seg != "", _decode(seg))


def path_depth(path: str) -> int:
    """Number of directory levels of a root: ``/a/b`` → 2."""
    plain = plain_path(path)
    return 0 if plain == "/" else plain.count("/")


def with_path_partitions(df: DataFrame, root: str, levels: int = 1,
                         prefix: str = "partition_") -> DataFrame:
    """Add ``partition_0…`` from the directory levels below ``root``.

    A file directly under ``root`` (or with fewer levels) gets nulls, as a
    crawler assigns no partition value to it.
    """
    depth = path_depth(root)
    out = df
    for i in range(levels):
        out = out.withColumn(f"{prefix}{i}", path_segment(depth + i))
    return out


def outermost(roots: Sequence[str]) -> list[str]:
    """Different locations without those inside another one, so that a scan lists each file once."""
    kept: list[str] = []
    for r in sorted(set(roots)):
        if not any(r.startswith(k + "/") for k in kept):
            kept.append(r)
    return kept


def tag_from_path(df: DataFrame, roots: Mapping[str, str], tag_col: str, levels: int = 0,
                  prefix: str = "partition_") -> DataFrame:
    """Tag each row of a multi-root scan with the name of the root it came from.

    A row is given once for every root its file lies under: roots may be nested, in different
    buckets, or one folder under several names. With ``levels``, ``partition_0…`` are the directory
    levels below that root. If each name is its own folder's and all roots are equally deep, the tag
    is one path segment; otherwise the file's folders are looked up per depth among the roots.
    """
    spark = df.sparkSession
    at = {name: location(spark, r) for name, r in roots.items()}
    depth = {name: loc.split("://", 1)[1].count("/") for name, loc in at.items()}
    if len(set(depth.values())) == 1 and all(loc.rsplit("/", 1)[-1] == n for n, loc in at.items()) and min(depth.values()) > 0:
        d = next(iter(depth.values()))
        out = df.withColumn(tag_col, path_segment(d - 1))
        for i in range(levels):
            out = out.withColumn(f"{prefix}{i}", path_segment(d + i))
        return out
    taken = {c.lower() for c in df.columns} | {tag_col.lower()}
    parts, hits = "_path_parts", "_root_hits"
    while any(c.startswith((parts, hits)) for c in taken):
        parts, hits = "_" + parts, "_" + hits
    full = F.col("_metadata.file_path")
    scheme = F.regexp_extract(full, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    authority = F.regexp_extract(full, r"^[^:/]*://([^/]*)", 1)
    inner = F.regexp_replace(_decode(F.regexp_replace(full, _SCHEME, "")), "^/+", "")
    # scheme://authority, then the folders, then the file name
    out = df.withColumn(parts, F.concat(F.array(F.concat(scheme, F.lit("://"), authority)), F.split(inner, "/")))
    found = []
    for d in sorted(set(depth.values())):
        rows = [(at[n], n) for n in roots if depth[n] == d]
        names: dict[str, list[str]] = {}
        for loc, n in rows:
            names.setdefault(loc, []).append(n)
        key, own = f"{hits}_k{d}", f"{hits}_{d}"
        lookup = spark.createDataFrame([(loc, ns) for loc, ns in names.items()], f"`{key}` string, `{own}` array<string>")
        if sum(len(loc) + sum(map(len, ns)) for loc, ns in names.items()) <= LOOKUP_BROADCAST_BYTES:
            lookup = F.broadcast(lookup)
        folder = F.when(F.size(parts) > d + 1, F.array_join(F.slice(parts, 1, d + 1), "/"))
        out = out.withColumn(key, folder).join(lookup, key, "left").drop(key)
        depth_here = F.lit(d).alias("depth")  # a second lambda argument would be the element's position
        found.append(F.transform(F.coalesce(own, F.array().cast("array<string>")), lambda n: F.struct(n.alias("name"), depth_here)))  # noqa: B023
    out = out.withColumn(hits, F.explode(F.concat(*found))).withColumn(tag_col, F.col(f"{hits}.name"))
    for i in range(levels):
        place = F.col(f"{hits}.depth") + F.lit(1 + i)
        out = out.withColumn(f"{prefix}{i}", F.when(place < F.size(parts) - 1, F.get(parts, place)))
    return out.drop(parts, hits, *(f"{hits}_{d}" for d in set(depth.values())))


def packed_scan(spark: SparkSession, group_bytes: int, open_cost_bytes: int = 64 << 10):
    """Scope small-file packing: a scan task takes up to ``group_bytes / open_cost_bytes`` small files.

    Spark fills a task up to ``maxPartitionBytes`` and charges ``openCostInBytes`` for each file. The size
    at which a task is full is also the size at which a file is split, and a file cut finer than its row
    groups gives tasks without rows; so it stays as it is, and the charge is set so that as many files
    fit as would into a group. Read at planning time: run the action inside the block.
    """
    whole = max(_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")), group_bytes)
    return scoped_conf(spark, {"spark.sql.files.maxPartitionBytes": str(whole),
                               "spark.sql.files.openCostInBytes": str(max(1, whole * open_cost_bytes // group_bytes))})


def _bytes(size: str) -> int:
    """Bytes of a Spark size setting such as ``128m`` or ``134217728b``."""
    number, unit = re.fullmatch(r"(\d+)\s*([bkmgt]?)b?", size.strip().lower()).groups()
    return int(number) << (10 * "bkmgt".index(unit or "b"))


def read_lines(spark: SparkSession, path: str, column: str = "key") -> DataFrame:
    """A line-oriented text file (e.g. a key manifest) as one string column."""
    return spark.read.text(path).withColumnRenamed("value", column)
