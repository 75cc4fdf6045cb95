"""The end-to-end consolidation flow.

raw per-tenant exports → combine by suffix (tag + ``partition_0`` from the
path) → normalise the serialized ``value`` column to JSON → create the
combined catalog table → query it with SQL.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tessera.functions.normalize import normalize_column
from tessera.operators.combine import combine_parquet_tables, match_suffix
from tessera.sinks.tables import create_table_as

# The combined conf table's column list (tag first).
CONF_COLUMNS = ["source", "id", "name", "value", "serialize", "name_jp", "memo", "partition_0"]


def consolidate(spark: SparkSession, roots: Mapping[str, str], suffix: str, table_name: str,
                location: str | None = None, serialized_column: str | None = "value",
                columns: list[str] | None = None, tag_col: str = "source") -> DataFrame:
    """Combine every root whose table name ends in ``suffix`` into ``table_name``."""
    names = match_suffix(roots, suffix, exclude=[table_name.rsplit(".", 1)[-1]])
    if not names:
        raise ValueError(f"no tables end in {suffix!r}")
    combined = combine_parquet_tables(spark, {n: roots[n] for n in names}, tag_col=tag_col,
                                      partition_levels=1)
    if serialized_column:
        combined = normalize_column(combined, serialized_column)
    if columns:
        combined = combined.select(*columns)
    return create_table_as(combined, table_name, path=location)


def conf_report(spark: SparkSession, table_name: str) -> DataFrame:
    """Per-source rows, JSON rows, a field pulled out of the JSON, partitions."""
    return spark.sql(f"""
        SELECT source,
               count(*) AS n_rows,
               count_if(value LIKE '{{%') AS n_json,
               sum(CAST(get_json_object(value, '$.custkey') AS BIGINT)) AS custkey_sum,
               count(DISTINCT partition_0) AS n_partitions
        FROM {table_name}
        GROUP BY source
    """)


def consolidate_by_suffix(spark: SparkSession, roots: Mapping[str, str], suffixes: Mapping[str, str],
                          out_base: str, num_files: int | None = None, on_conflict: str = "lossless",
                          tag_col: str = "source_table", plan: str = "auto", on_error: str = "raise",
                          group_bytes: int | None = None, max_workers: int = 4, ledger: str | None = None) -> DataFrame:
    """The combine job: for each ``suffix → output``, combine and write Parquet.

    Every matching root is combined (single scan or fold, see
    ``combine_parquet_tables``) and written to ``<out_base>/<output>`` —
    size-based files by default, or ``num_files``. A suffix without tables
    is reported as ``no match`` and skipped. Any other failure raises, or
    with ``on_error="report"`` is recorded as ``failed: <error>`` and the
    remaining suffixes still run. Returns ``suffix, output_table, n_tables,
    n_rows, status`` — row counts observed during the writes, one report row
    per suffix. ``group_bytes`` packs small input files into scan tasks of
    about that many bytes while the job runs (``packed_scan``).

    With a ``ledger`` (a folder that the job's runs share) outputs are committed to it one by one: a later run writes
    only those that failed or did not end, whose tables or their files are others by now, or that are gone;
    the others are reported as ``unchanged``.
    """
    import contextlib

    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from tessera.session import run_parallel, scoped_conf
    from tessera.sinks.files import TARGET_FILE_BYTES, compact_write
    from tessera.sources.files import packed_scan

    outputs = set(suffixes.values())

    def run_one(item):
        suffix, output = item
        names = match_suffix(roots, suffix, exclude=outputs)
        if not names:
            return (suffix, output, 0, 0, "no match")
        try:
            combined = combine_parquet_tables(spark, {n: roots[n] for n in names}, tag_col=tag_col,
                                              on_conflict=on_conflict, plan=plan)
            obs = Observation()
            compact_write(combined.observe(obs, F.count(F.lit(1)).alias("n")),
                          f"{out_base.rstrip('/')}/{output}", num_files=num_files)
            return (suffix, output, len(names), int(obs.get["n"]), "written")
        except Exception as exc:  # noqa: BLE001 — reported per suffix when asked to
            if on_error != "report":
                raise
            return (suffix, output, len(names), 0, f"failed: {type(exc).__name__}: {exc}")

    # Outputs are independent: run them on driver threads. Session settings
    # (file packing, output file size) are set once around all of them, so
    # the per-write scopes inside are no-ops and no thread restores a value
    # another one still uses.
    if ledger is not None:
        done = functools.partial(_by_ledger, spark, ledger, roots, outputs, out_base)
    else:
        done = lambda one, items, workers: run_parallel(one, items, workers)
    packing = packed_scan(spark, group_bytes) if group_bytes else contextlib.nullcontext()
    sizing = scoped_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_FILE_BYTES)}
                         if num_files is None else {})
    with packing, sizing:
        report = done(run_one, suffixes.items(), max_workers)
    return spark.createDataFrame(report, "suffix string, output_table string, n_tables bigint, "
                                         "n_rows bigint, status string")


def _by_ledger(spark: SparkSession, ledger: str, roots: Mapping[str, str], outputs: set[str], out_base: str, run_one, items,
               max_workers: int) -> list[tuple]:
    """``run_one`` for the suffixes that are open by the job's ledger."""
    from tessera.operators.jobledger import Item, JobLedger, files_fingerprint
    from tessera.session import path_exists

    def item(suffix: str, output: str) -> Item:
        names = match_suffix(roots, suffix, exclude=outputs)

        def run() -> tuple[str, dict]:
            _, _, n_tables, n_rows, status = run_one((suffix, output))
            if status.startswith("failed: "):
                raise RuntimeError(status.removeprefix("failed: "))
            return f"{out_base.rstrip('/')}/{output}", {"n_tables": n_tables, "n_rows": n_rows, "status": status}

        mark = lambda: ",".join(names) + " " + files_fingerprint(spark, *(roots[n] for n in names))
        return Item(mark, run, lambda at: not names or path_exists(spark, f"{at}/_SUCCESS"))

    found = JobLedger(spark, ledger).run({suffix: item(suffix, output) for suffix, output in items}, max_workers)
    of = dict(items)
    return [(o.item, of[o.item], o.counts.get("n_tables", 0), o.counts.get("n_rows", 0),
             f"failed: {o.error}" if o.state == "failed" else o.counts["status"] if o.state == "done" or o.counts["status"] == "no match" else "unchanged")
            for o in found]


def consolidate_database(spark: SparkSession, db: str, suffixes: Mapping[str, str], target_db: str,
                         columns: Mapping[str, list[str]] | None = None, tag_col: str = "source_table",
                         on_conflict: str = "lossless", partition_levels: int = 0, location: str | None = None,
                         max_workers: int = 4) -> DataFrame:
    """The combine job from a catalog database to catalog tables.

    For each ``suffix → output`` every table of ``db`` whose name ends in the suffix is combined into
    ``target_db.output``. With a column list for the suffix the output has the tag first, then these
    columns; otherwise all columns by name, the tag last. Tables that are plain Parquet folders are
    read by location, many of them in one scan; others (views, other formats, partitioned tables)
    through the catalog. Returns ``suffix, output_table, n_tables, n_rows, status``: a suffix without
    tables is ``no match``, one that fails is ``failed: <error>``, and the others still run.
    """
    from pyspark.sql import functions as F

    from tessera.operators.combine import combine_by_suffix
    from tessera.session import run_parallel
    from tessera.sources.catalog import list_table_names, parquet_location, read_table

    names, outputs = list_table_names(spark, db), set(suffixes.values())

    def combined(suffix: str, matched: list[str]) -> DataFrame:
        wanted = (columns or {}).get(suffix)
        where = dict(zip(matched, run_parallel(lambda n: parquet_location(spark, db, n), matched, max_workers=16)))
        if all(where.values()):
            out = combine_parquet_tables(spark, where, tag_col=tag_col, on_conflict=on_conflict, partition_levels=partition_levels)
            return out.select(tag_col, *(F.col(f"`{c}`") for c in wanted)) if wanted else out
        tables = {n: read_table(spark, db, n) for n in matched}
        return combine_by_suffix(tables, {suffix: suffixes[suffix]}, {suffix: wanted} if wanted else None, tag_col,
                                 on_conflict)[suffixes[suffix]]

    def run_one(item):
        suffix, output = item
        matched = match_suffix(names, suffix, exclude=outputs)
        if not matched:
            return (suffix, output, 0, 0, "no match")
        try:
            table = create_table_as(combined(suffix, matched), f"`{target_db}`.`{output}`",
                                    path=location and f"{location.rstrip('/')}/{output}")
            return (suffix, output, len(matched), table.count(), "written")  # counted from the footers
        except Exception as exc:  # noqa: BLE001 — a failed output is a row of the report
            return (suffix, output, len(matched), 0, f"failed: {type(exc).__name__}: {exc}")

    report = run_parallel(run_one, suffixes.items(), max_workers)
    return spark.createDataFrame(report, "suffix string, output_table string, n_tables bigint, n_rows bigint, status string")
