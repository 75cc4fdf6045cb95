"""Named snapshots of a set of tables, and restore by name pattern.

A snapshot is ``<base>/<snapshot>/<table>/`` (Parquet) per table plus a
manifest table ``<base>/<snapshot>/_manifest`` with one row per table:
``snapshot, table_name, path, n_rows, schema_json``. Row counts come from an
``Observation`` on each write, so a snapshot reads every table exactly once.

Restore selects manifest rows with a comma-separated pattern list: ``*``
wildcards, a leading ``-`` excludes (``"-.system*,-.audit-*"`` = all
but those), a name without wildcards selects that table only.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.session import path_exists, run_parallel

MANIFEST = "_manifest"


def snapshot_tables(spark: SparkSession, tables: Mapping[str, DataFrame], base: str, name: str,
                    max_workers: int = 4) -> DataFrame:
    """Write each table under ``base/name/``.

    A finished snapshot (its manifest exists) is never overwritten. An
    unfinished one — the job or its driver died part-way — is resumed: tables
    whose copy was committed (``_SUCCESS``) are kept and only counted, the
    rest are (re)written. Tables are written concurrently on driver threads.
    """
    root = f"{base.rstrip('/')}/{name}"
    if path_exists(spark, f"{root}/{MANIFEST}"):
        raise FileExistsError(f"snapshot {name!r} already exists under {base}")

    def write_one(item):
        table_name, df = item
        path = f"{root}/{table_name}"
        if path_exists(spark, f"{path}/_SUCCESS"):
            n = spark.read.schema(df.schema).parquet(path).count()   # footers only
        else:
            obs = Observation()
            df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
            n = obs.get["n"]
        return (name, table_name, path, int(n), df.schema.json())

    rows = run_parallel(write_one, tables.items(), max_workers)
    manifest = spark.createDataFrame(rows, "snapshot string, table_name string, path string, "
                                           "n_rows bigint, schema_json string")
    # Written last: its presence marks the snapshot finished.
    manifest.coalesce(1).write.mode("errorifexists").parquet(f"{root}/{MANIFEST}")
    return manifest


def _glob_regex(glob: str) -> str:
    return "^" + ".*".join(re.escape(part) for part in glob.split("*")) + "$"


def pattern_filter(patterns: str, column: str = "table_name") -> F.Column:
    """Include/exclude glob list → one boolean column expression."""
    items = [p.strip() for p in patterns.split(",") if p.strip()]
    includes = [p for p in items if not p.startswith("-")]
    excludes = [p[1:] for p in items if p.startswith("-")]
    col = F.col(column)
    keep = F.lit(True) if not includes else None
    for p in includes:
        cond = col.rlike(_glob_regex(p))
        keep = cond if keep is None else keep | cond
    for p in excludes:
        keep = keep & ~col.rlike(_glob_regex(p))
    return keep


def restore_snapshot(spark: SparkSession, base: str, name: str, indices: str = "*") -> dict[str, DataFrame]:
    """Tables of snapshot ``name`` matching ``indices``, read back from their copies."""
    manifest = spark.read.parquet(f"{base.rstrip('/')}/{name}/{MANIFEST}")
    chosen = manifest.where(pattern_filter(indices)).select("table_name", "path", "schema_json").collect()
    from pyspark.sql.types import StructType
    import json
    return {r.table_name: spark.read.schema(StructType.fromJson(json.loads(r.schema_json))).parquet(r.path)
            for r in sorted(chosen, key=lambda r: r.table_name)}


def restore_to_tables(spark: SparkSession, base: str, name: str, target_db: str, indices: str = "*",
                      rename: Mapping[str, str] | None = None, location: str | None = None,
                      max_workers: int = 4) -> DataFrame:
    """Restore tables of a snapshot into catalog database ``target_db``.

    Each table is a copy of the snapshot's (which stays as it is) and is checked against the row count
    in the manifest. Returns ``table_name, n_rows, status``: ``restored``, or ``failed: <error>`` for a
    table that exists already, has lost files or does not have its rows; the others are restored.
    """
    from tessera.sinks.tables import create_table_as
    root = f"{base.rstrip('/')}/{name}"
    counts = {r.table_name: r.n_rows for r in spark.read.parquet(f"{root}/{MANIFEST}").where(pattern_filter(indices)).collect()}
    frames = restore_snapshot(spark, base, name, indices)

    def restore_one(item):
        table_name, df = item
        target = (rename or {}).get(table_name, table_name)
        try:
            made = create_table_as(df, f"`{target_db}`.`{target}`", path=location and f"{location.rstrip('/')}/{target}")
            n = made.count()  # from the footers
            status = "restored" if n == counts[table_name] else f"failed: {n} of {counts[table_name]} rows"
            return (target, n, status)
        except Exception as exc:  # noqa: BLE001 — a failed table is a row of the report
            return (target, 0, f"failed: {type(exc).__name__}: {exc}")

    return spark.createDataFrame(run_parallel(restore_one, frames.items(), max_workers), "table_name string, n_rows bigint, status string")
