"""Fuse copies of one logical table into a single tagged table.

Two union shapes, both narrow (no shuffle; Catalyst flattens nested unions
into one ``Union`` node and pushes filters/projections into every branch):

* positional — ``SELECT 'tag' AS source, c1, c2 … UNION ALL …``: each branch
  projects an explicit column list; names come from the first branch.
* by name    — ``unionByName(allowMissingColumns=True)``: missing columns are
  null-filled; output order is the first input's columns, then columns first
  seen later.

For many Parquet tables the fold of N scans is replaced by one multi-root
scan that tags rows from the file path (``combine_parquet_tables``): one job,
one task set sized by bytes rather than by table count, one schema pass.
"""

from __future__ import annotations

import functools
import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.align import align, column_types, union_column_order
from tessera.session import run_parallel
from tessera.sources.files import (is_merge_conflict, location, outermost, read_parquet_groups, read_parquet_tree, tag_from_path,
                                   with_path_partitions)

log = logging.getLogger(__name__)

# Below this many tables the per-table fold is as cheap as the single scan.
SINGLE_SCAN_MIN_TABLES = 16


def tag(df: DataFrame, name: str, tag_col: str = "source", position: str = "first") -> DataFrame:
    """Add a literal provenance column.

    ``position="first"`` puts it before all columns (SQL-style branches);
    ``"last"`` behaves like ``withColumn``: appended, or replacing a column of
    the same (case-insensitive) name in place.
    """
    if position == "last":
        return df.withColumn(tag_col, F.lit(name))
    if position != "first":
        raise ValueError("position must be 'first' or 'last'")
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() != tag_col.lower()]
    return df.select(F.lit(name).alias(tag_col), *rest)


def union_positional(frames: Sequence[DataFrame]) -> DataFrame:
    """``UNION ALL`` by position; duplicates kept, names from the first input."""
    if not frames:
        raise ValueError("nothing to union")
    width = len(frames[0].columns)
    for i, df in enumerate(frames[1:], start=1):
        if len(df.columns) != width:
            raise ValueError(f"branch {i} has {len(df.columns)} columns, branch 0 has {width}")
    return functools.reduce(DataFrame.union, frames)


def union_tagged(branches: Sequence[tuple[str, DataFrame]], columns: Sequence[str] | None = None,
                 tag_col: str = "source", on_conflict: str = "lossless") -> DataFrame:
    """One branch per (tag, table): ``SELECT tag AS source, <columns> … UNION ALL``."""
    selected = []
    for name, df in branches:
        cols = list(columns) if columns is not None else df.columns
        selected.append(df.select(*[F.col(f"`{c}`") for c in cols]))
    # Positional: the first branch names every position, so the conflict
    # policy compares position by position.
    names = selected[0].columns
    selected = [df.toDF(*names) if len(df.columns) == len(names) else df for df in selected]
    aligned = align(selected, on_conflict)
    return union_positional([tag(df, name, tag_col) for (name, _), df in zip(branches, aligned)])


def union_same_table(df: DataFrame, tags: Sequence[str], columns: Sequence[str] | None = None,
                     tag_col: str = "source") -> DataFrame:
    """The same table under several tags: every row once per tag.

    One scan with a generator instead of len(tags) scans of the same files.
    """
    cols = list(columns) if columns is not None else df.columns
    return df.select(F.explode(F.array(*[F.lit(t) for t in tags])).alias(tag_col),
                     *[F.col(f"`{c}`") for c in cols])


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = True,
                  on_conflict: str = "lossless") -> DataFrame:
    """Union by column name; missing columns null-filled (also inside structs)."""
    if not frames:
        raise ValueError("nothing to union")
    aligned = align(frames, on_conflict)
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), aligned)


def match_suffix(names: Iterable[str], suffix: str, exclude: Iterable[str] = ()) -> list[str]:
    """Names ending in ``suffix`` (case-sensitive, no delimiter), minus ``exclude``."""
    skip = set(exclude)
    return [n for n in names if n.endswith(suffix) and n not in skip]


def combine_tables(tables: Mapping[str, DataFrame], tag_col: str = "source_table",
                   on_conflict: str = "lossless") -> DataFrame:
    """Fold plan: tag each table (appended column), then union by name."""
    if not tables:
        raise ValueError("no tables to combine")
    return union_by_name([tag(df, name, tag_col, "last") for name, df in tables.items()],
                         allow_missing=True, on_conflict=on_conflict)


def combine_parquet_tables(spark: SparkSession, roots: Mapping[str, str], tag_col: str = "source_table",
                           on_conflict: str = "lossless", plan: str = "auto",
                           partition_levels: int = 0, schema: StructType | None = None, ledger=None) -> DataFrame:
    """Combine Parquet table roots (name → directory), tagging rows by table.

    ``plan="scan"`` reads all roots in one scan with an explicit merged schema
    (Parquet null-fills columns a file lacks; no schema-merge job runs) and
    tags rows from the file path. It needs one type per column across tables.
    ``"fold"`` reads each root separately and unions by name. ``"auto"``
    picks the scan for many tables without type conflicts. Both give the same
    rows and the same column order.

    With a known ``schema`` (the combined data columns, in order) no table is
    inspected at all: one listing, one scan, missing columns null-filled.

    With a ``SchemaLedger`` only the footers it has not seen are read, whatever the number of tables and files;
    if every column has one type in all files, the scan follows from it, else the fold.
    """
    if not roots:
        raise ValueError("no tables to combine")
    if ledger is not None and schema is None and plan != "fold":
        ledger.update(roots)
        found = ledger.joined(roots)
        if found.uniform and tag_col.lower() not in {f.name.lower() for f in found.schema.fields}:
            return combine_parquet_tables(spark, roots, tag_col, on_conflict, "scan", partition_levels, schema=found.schema)
    if schema is not None:
        where = outermost([location(spark, r) for r in roots.values()])
        scan = tag_from_path(read_parquet_tree(spark, where, schema=schema), roots, tag_col, partition_levels)
        derived = [f"partition_{i}" for i in range(partition_levels)]
        data = [F.col(f"`{f.name}`") for f in schema.fields if f.name.lower() not in {tag_col.lower(), *derived}]
        return scan.select(*data, *derived, tag_col)
    if plan not in ("auto", "scan", "fold"):
        raise ValueError("plan must be 'auto', 'scan' or 'fold'")
    if plan in ("auto", "scan") and len(roots) >= SINGLE_SCAN_MIN_TABLES:
        uniform = _uniform_schema(spark, roots)
        if uniform is not None and tag_col.lower() not in {f.name.lower() for f in uniform.fields}:
            return combine_parquet_tables(spark, roots, tag_col, on_conflict, "scan", partition_levels,
                                          schema=uniform)
    # One listing and schema merge per table, overlapped on driver threads.
    frames = run_parallel(lambda root: read_parquet_groups(spark, root, ledger), roots.values(), max_workers=32)
    raw = dict(zip(roots, frames))
    # The scan reads every file with one schema, so every column needs one
    # exact type (nested field differences included); otherwise fold.
    differing = sorted(k for k, v in column_types([df for group in frames for df in group]).items() if len(v) > 1)
    if plan == "scan" and differing:
        raise ValueError(f"single scan needs one type per column; types differ in {differing}")
    if plan == "fold" or differing or len(roots) < SINGLE_SCAN_MIN_TABLES and plan == "auto":
        per_table = {}
        for name, group in raw.items():
            if partition_levels:
                group = [with_path_partitions(df, roots[name], partition_levels) for df in group]
            per_table[name] = group[0] if len(group) == 1 else union_by_name(group, on_conflict=on_conflict)
        return combine_tables(per_table, tag_col, on_conflict)

    # The fold's order: first table's columns (tag replaced in place or
    # appended), then columns first seen in later tables.
    derived = [f"partition_{i}" for i in range(partition_levels)]
    tables = [functools.reduce(lambda df, c: df.withColumn(c, F.lit("")), derived, group[0]) for group in frames]
    order = union_column_order([tables[0].withColumn(tag_col, F.lit(""))] + tables[1:])
    fields = {}
    for group in frames:
        for f in group[0].schema.fields:
            fields.setdefault(f.name.lower(), f)
    skip = {tag_col.lower(), *derived}
    schema = StructType([fields[c.lower()] for c in order if c.lower() not in skip])
    scan = combine_parquet_tables(spark, roots, tag_col, on_conflict, "scan", partition_levels, schema=schema)
    return scan.select(*[F.col(f"`{c}`") for c in order])


def _uniform_schema(spark: SparkSession, roots: Mapping[str, str]) -> StructType | None:
    """The common schema when every table has the same columns and types, else None.

    Two jobs instead of one per table: a merge of the first table's footers and one of all. When the
    second adds nothing to the first table's schema, the fold's column order is that schema, so no
    other table needs inspecting.
    """
    try:
        first = read_parquet_tree(spark, next(iter(roots.values()))).schema
        merged = read_parquet_tree(spark, list(roots.values())).schema
    except Exception as exc:  # noqa: BLE001 — raised again unless it is a merge conflict
        if not is_merge_conflict(exc):
            raise
        return None  # the per-table path decides
    by_name = {f.name.lower(): f.dataType for f in first.fields}
    if len(merged.fields) != len(first.fields):
        return None
    if any(by_name.get(f.name.lower()) != f.dataType for f in merged.fields):
        return None
    return first


def combine_by_suffix(tables: Mapping[str, DataFrame], suffixes: Mapping[str, str],
                      columns: Mapping[str, Sequence[str]] | None = None, tag_col: str = "source_table",
                      on_conflict: str = "lossless") -> dict[str, DataFrame]:
    """For each ``suffix → output``: combine every input whose name ends in it.

    Outputs are never inputs (a configured output name that happens to end in
    a suffix is skipped). A suffix with no match is logged and skipped. With a
    column list for a suffix, branches are projected to it and tagged first
    (SQL-style); otherwise all columns are aligned by name and tagged last.
    """
    outputs = set(suffixes.values())
    result: dict[str, DataFrame] = {}
    for suffix, out_name in suffixes.items():
        names = match_suffix(tables.keys(), suffix, exclude=outputs)
        if not names:
            log.warning("no tables match suffix %r; %s not built", suffix, out_name)
            continue
        cols = (columns or {}).get(suffix)
        if cols:
            result[out_name] = union_tagged([(n, tables[n]) for n in names], cols, tag_col, on_conflict)
        else:
            result[out_name] = combine_tables({n: tables[n] for n in names}, tag_col, on_conflict)
    return result


def suffix_match_counts(combined: DataFrame, tag_col: str = "source_table",
                        names: Sequence[str] | None = None) -> DataFrame:
    """Rows per input table and the number of tables matched.

    With the matched ``names`` an empty table counts too (with 0 rows); without them only tables
    that gave a row are known.

    The group-by is partially aggregated map-side (one row per tag per task
    before the shuffle), so a tag holding most rows costs no more than any
    other. The window then runs over one row per table, a driver-known bound.
    """
    per_table = combined.groupBy(tag_col).agg(F.count(F.lit(1)).alias("n_rows"))
    if names is not None:
        known = combined.sparkSession.createDataFrame([(n,) for n in names], f"`{tag_col}` string")
        per_table = known.join(per_table, tag_col, "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    return per_table.withColumn("n_tables", F.count(F.lit(1)).over(Window.partitionBy()))
