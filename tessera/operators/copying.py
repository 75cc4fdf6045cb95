"""Copy tables between stores: keyed upsert, per-row rejects, counts.

A keyed copy replaces every target row whose key appears in the source and
keeps the others::

    new_target = source ∪ (target ▷ source.keys)        (▷ = left anti join)

Set-based instead of one put per item: one anti join (sort-merge by key, or
broadcast when AQE measures the key side small at run time), one write.
The new contents go to a fresh directory and the catalog table is then
pointed at it, so a failed or retried job never leaves the target half
written (a path cannot be overwritten while it is being read).

Rows that cannot be written (no key, a failed check, or a value that the target's
column type does not hold exactly) are split off with a reason into a ``rejects``
location instead of failing the job. One pass over the key and the checked
columns, before anything is written, counts rows and rejects and finds
duplicate keys; the write then reads the source's rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.fitting import converted, free_name
from tessera.session import RUNTIME_BROADCAST_ONLY, run_parallel, scoped_conf, scratch_path


class DuplicateKeys(ValueError):
    """The source of an upsert has more than one row for a key."""


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_by: str) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order_by``.

    ``max_by`` is a partial aggregate: every task reduces its rows to one per
    key before the shuffle, so a key holding a third of all rows ships one
    row per task, not a third of the data to one reducer.
    """
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    # Nulls in ``order_by`` rank lowest (instead of being skipped, which
    # would turn a key whose rows all lack it into an all-null row).
    rank = F.struct(F.col(order_by).isNotNull(), F.col(order_by))
    row = free_name(keys, "_row")
    packed = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), rank).alias(row)
    return df.groupBy(*keys).agg(packed).select(*keys, f"{row}.*").select(*(F.col(f"`{c}`") for c in df.columns))


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    """Raise ``DuplicateKeys`` if a key occurs twice (one partially aggregated pass)."""
    keys = _keys(key)
    dup = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if dup:
        raise DuplicateKeys(f"duplicate key in upsert source: {dup[0].asDict()}")


def upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str],
           order_by: str | None = None, check_unique: bool = True) -> DataFrame:
    """New target contents: all source rows, plus target rows whose key the source lacks.

    Columns follow the target; source-only columns are appended, and columns
    the source lacks are null for its rows. With ``order_by`` the source is
    first reduced to its latest row per key. Otherwise duplicate source keys
    are an error, checked eagerly unless the caller did (``check_unique``).
    """
    keys = _keys(key)
    src = latest_per_key(source, keys, order_by) if order_by else source
    if check_unique and not order_by:
        assert_unique(src, keys)
    # No broadcast hint: run the write under RUNTIME_BROADCAST_ONLY and AQE
    # switches to a broadcast join only once the key side's measured shuffle
    # output is small; otherwise it stays a sort-merge anti join, with AQE
    # splitting a target partition made big by a hot key. The key side is
    # distinct first: partial aggregation collapses a hot key to one row per task.
    kept = target.join(src.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(src, allowMissingColumns=True).select(
        *target.columns, *[c for c in src.columns if c not in target.columns])


@dataclass
class Fitted:
    """``frame`` in the wanted types; ``reasons``: reason → predicate on it; ``originals``: how to get each source column back."""
    frame: DataFrame
    reasons: dict[str, Column]
    originals: list[Column]
    helpers: list[str]


def fit_to_schema(source: DataFrame, schema: StructType) -> Fitted:
    """Convert ``source`` to the types ``schema`` has; a value that would change in any way fails its row.

    Columns of the same type, and those ``schema`` lacks, stay as they are. The drifted originals and the
    verdicts travel as helper columns, under names the source does not have.
    """
    want = {f.name.lower(): f.dataType for f in schema.fields}
    taken = [*source.columns, *schema.names]
    columns, helpers, kept, reasons, originals = [], [], [], {}, []
    for f in source.schema.fields:
        to = want.get(f.name.lower(), f.dataType)
        at = F.col(f"`{f.name}`")
        if to == f.dataType:
            columns.append(at)
            originals.append(at)
            continue
        value, lost = converted(at, f.dataType, to)
        columns.append(value.alias(f.name))
        was = free_name([*taken, *helpers], f"_was_{f.name}")
        gone = free_name([*taken, *helpers, was], f"_lost_{f.name}")
        helpers += [was, gone]
        kept += [at.alias(was), lost.alias(gone)]
        reasons[f"{f.name} does not fit {to.simpleString()}"] = F.col(f"`{gone}`")
        originals.append(F.col(f"`{was}`").alias(f.name))
    return Fitted(source.select(*columns, *kept), reasons, originals, helpers)


def validity_reason(key: str | Sequence[str], checks: Mapping[str, Column] | None = None) -> Column:
    """Null for a writable row, else the first failing reason.

    Built-in checks: every key column present. ``checks`` maps a reason to a
    *failure* predicate (e.g. ``{"bad price": F.col("price").try_cast("int").isNull()}``).
    """
    expr = None
    for k in _keys(key):
        cond = F.col(k).isNull()
        expr = F.when(cond, F.lit(f"missing key {k}")) if expr is None else expr.when(cond, F.lit(f"missing key {k}"))
    for reason, failing in (checks or {}).items():
        expr = expr.when(F.coalesce(failing, F.lit(False)), F.lit(reason))  # null: not failing
    return expr


def flag_rows(source: DataFrame, schema: StructType | None, key: str | Sequence[str],
              checks: Mapping[str, Column] | None = None) -> tuple[str, DataFrame, Fitted]:
    """(name of the reason column, source in the types of ``schema`` with that column, how it was fitted).

    The reason is null for a writable row. The caller's checks see the values as they were given, before any cast.
    """
    own = free_name([*source.columns, *(schema.names if schema else ())], "_own_reason")
    checked = source.withColumn(own, validity_reason(key, checks))
    fitted = fit_to_schema(checked, schema if schema is not None else checked.schema)
    fitted.originals = fitted.originals[:len(source.columns)]
    why = free_name([*fitted.frame.columns, own], "_reason")
    reason = F.coalesce(F.col(own), *(F.when(lost, F.lit(text)) for text, lost in fitted.reasons.items()))
    return why, fitted.frame.withColumn(why, reason), fitted


@dataclass
class CopyResult:
    table: str
    path: str
    rejects_path: str
    copied: int
    rejected: int


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """``(buckets, columns)`` of a bucketed catalog table, else None."""
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Num Buckets" not in rows:
        return None
    cols = [c.strip().strip("`") for c in rows.get("Bucket Columns", "").strip("[]").split(",") if c.strip()]
    return int(rows["Num Buckets"]), cols


def _write_generation(spark: SparkSession, df: DataFrame, table: str, path: str,
                      spec: tuple[int, list[str]] | None, exists: bool) -> None:
    """Write one generation of ``table`` at ``path`` (bucketed when ``spec``)."""
    if spec is None:
        df.write.mode("errorifexists").parquet(path)
        return
    n, cols = spec
    writer = lambda d: d.write.mode("errorifexists").bucketBy(n, *cols).option("path", path).format("parquet")
    if not exists:
        # A first copy creates the table itself, spread by key once so each
        # task writes one bucket.
        writer(df.repartition(n, *cols)).saveAsTable(table)
        return
    # Bucketed files can only be written through a table: write under a
    # throw-away external name, drop that entry (external: the files stay),
    # and let the caller repoint the real table at the files.
    staging = f"{table}__gen_{uuid.uuid4().hex[:8]}"
    writer(df).saveAsTable(staging)
    spark.sql(f"DROP TABLE {staging}")


def copy_table(spark: SparkSession, source: DataFrame, target_table: str, key: str | Sequence[str],
               checks: Mapping[str, Column] | None = None, order_by: str | None = None,
               location: str | None = None, buckets: int | None = None) -> CopyResult:
    """Copy ``source`` into catalog table ``target_table`` (created if absent).

    Steps: cast the source to the target's column types; split its rows into
    writable / rejected (with a reason); count both and look for duplicate
    keys in one pass over the key and the checked columns; upsert the
    writable rows against the current target into a fresh directory; point
    the table at it. Rejects are written beside it, as the source had them.
    With nothing to write an existing target stays as it is, and a missing
    one is created empty.

    ``buckets`` (first copy only) buckets the table by its key, as a keyed
    store partitions items by hash key. Every later copy then reads the
    target already partitioned by key: the anti join shuffles only the
    source's keys, never the target, and the new generation is written with
    the same bucket spec. Use at least ``spark.sql.shuffle.partitions``
    buckets: with fewer, Spark re-shuffles the bucketed side to keep the
    join's parallelism.
    """
    exists = spark.catalog.tableExists(target_table)
    # The caller's checks see the values as they were given, before any cast.
    why, flagged, fitted = flag_rows(source, spark.table(target_table).schema if exists else None, key, checks)
    good = flagged.where(F.col(why).isNull()).select(*(F.col(f"`{c}`") for c in source.columns))
    # The rejects say why in ``reason``, or in a longer name if the source has that column.
    bad = flagged.where(F.col(why).isNotNull()).select(*fitted.originals, F.col(why).alias(free_name(source.columns, "reason")))

    keys = _keys(key)
    n, ok = free_name(keys, "n"), free_name(keys, "ok")
    per_key = flagged.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.count_if(F.col(why).isNull()).alias(ok))
    seen = per_key.agg(F.sum(n).alias("n"), F.sum(ok).alias("ok"), F.max(ok).alias("most")).first()
    n_all, n_good = int(seen["n"] or 0), int(seen["ok"] or 0)
    if not order_by and (seen["most"] or 0) > 1:
        example = per_key.where(F.col(ok) > 1).limit(1).collect()[0].asDict()
        raise DuplicateKeys(f"duplicate key in copy source for {target_table}: { {k: example[k] for k in keys} }")

    base = location or scratch_path(spark, target_table.replace(".", "_").replace("`", ""))
    gen = f"{base}/gen-{uuid.uuid4().hex[:12]}"
    rejects_path = f"{base}/rejects/run-{uuid.uuid4().hex[:12]}"
    if exists:
        new = upsert(spark.table(target_table), good, key, order_by, check_unique=False)
    else:
        new = latest_per_key(good, key, order_by) if order_by else good
    if n_good or not exists:
        spec = bucket_spec(spark, target_table) if exists else ((buckets, keys) if buckets else None)
        with scoped_conf(spark, RUNTIME_BROADCAST_ONLY):
            _write_generation(spark, new, target_table, gen, spec, exists)
        if exists:
            known = {c.lower() for c in spark.table(target_table).columns}
            spark.sql(f"ALTER TABLE {target_table} SET LOCATION '{gen}'")
            added = [f for f in new.schema.fields if f.name.lower() not in known]
            if added:  # attributes only the source items carry become table columns
                cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                spark.sql(f"ALTER TABLE {target_table} ADD COLUMNS ({cols})")
            spark.sql(f"REFRESH TABLE {target_table}")
        elif spec is None:
            spark.catalog.createTable(target_table, path=gen, source="parquet")
    if n_all > n_good:
        bad.write.mode("errorifexists").parquet(rejects_path)
    else:  # nothing rejected: an empty rejects set, without reading the source again
        spark.createDataFrame([], bad.schema).write.mode("errorifexists").parquet(rejects_path)
    return CopyResult(target_table, gen, rejects_path, n_good, n_all - n_good)


def copy_all_tables(spark: SparkSession, sources: Mapping[str, tuple],
                    target_db: str, checks: Mapping[str, Mapping[str, Column]] | None = None,
                    rename: Mapping[str, str] | None = None, max_workers: int = 4,
                    on_error: str = "raise") -> tuple[DataFrame, list[CopyResult]]:
    """Copy every ``name → (DataFrame, key[, order_by])`` into ``target_db`` (same name unless renamed).

    With ``order_by`` a table keeps the latest row per key instead of
    rejecting duplicate keys.

    Tables are copied concurrently (``max_workers`` driver threads). Returns a
    report DataFrame ``table_name, copied, rejected`` (one row per table: its
    size is the number of tables, held by the driver anyway) and the
    per-table results. With ``on_error="report"`` a table that fails does not
    stop the others: the report gets a column ``error``, null for copied tables.
    """
    def copy_one(item):
        name, (df, key, *rest) = item
        target = f"{target_db}.{(rename or {}).get(name, name)}"
        try:
            if isinstance(df, str):
                df = spark.table(df)
            return copy_table(spark, df, target, key, (checks or {}).get(name), order_by=rest[0] if rest else None)
        except Exception as exc:  # noqa: BLE001 — reported per table when asked to
            if on_error != "report":
                raise
            return (target, f"{type(exc).__name__}: {exc}")

    with scoped_conf(spark, RUNTIME_BROADCAST_ONLY):  # set once for all threads
        outcomes = run_parallel(copy_one, sources.items(), max_workers)
    results = [r for r in outcomes if isinstance(r, CopyResult)]
    rows = [(r.table.split(".")[-1], r.copied, r.rejected, None) if isinstance(r, CopyResult)
            else (r[0].split(".")[-1], 0, 0, r[1]) for r in outcomes]
    report = spark.createDataFrame(rows, "table_name string, copied bigint, rejected bigint, error string")
    return (report if on_error == "report" else report.drop("error")), results


def copy_database(spark: SparkSession, source_db: str, target_db: str, keys: Mapping[str, str | Sequence[str]],
                  rename: Mapping[str, str] | None = None, max_workers: int = 4, ledger: str | None = None) -> DataFrame:
    """Copy every table of a catalog database into another: ``table_name, copied, rejected, error``.

    ``keys`` names each table's key. A table without one, or whose copy
    fails, is a row of the report with its error; the others are copied.

    With a ``ledger`` (a folder that the job's runs share) every table is committed to it when its copy ends, and a
    later run copies only the tables that failed or did not end, whose files are others by now, whose key is
    another, or whose target is gone; the report gets a column ``state``: ``done``, ``unchanged`` or ``failed``. Tables that
    are no plain Parquet folders can't be told to be unchanged and are copied each time.
    """
    from tessera.sources.catalog import list_table_names
    names = sorted(list_table_names(spark, source_db))
    if ledger is not None:
        return _copy_by_ledger(spark, names, source_db, target_db, keys, rename or {}, max_workers, ledger)
    known = {n: (f"`{source_db}`.`{n}`", keys[n]) for n in names if n in keys}
    report, _ = copy_all_tables(spark, known, target_db, rename=rename, max_workers=max_workers, on_error="report")
    missing = [((rename or {}).get(n, n), 0, 0, "no key given") for n in names if n not in keys]
    return report.unionByName(spark.createDataFrame(missing, report.schema)) if missing else report


def _copy_by_ledger(spark: SparkSession, names: Sequence[str], source_db: str, target_db: str, keys: Mapping[str, str | Sequence[str]],
                    rename: Mapping[str, str], max_workers: int, ledger: str) -> DataFrame:
    from tessera.operators.jobledger import Item, JobLedger, files_fingerprint
    from tessera.sources.catalog import parquet_location

    def item(name: str) -> Item:
        target = f"{target_db}.{rename.get(name, name)}"

        def fingerprint() -> str | None:
            at = parquet_location(spark, source_db, name)
            return at and f"{files_fingerprint(spark, at)} {','.join(_keys(keys.get(name, ())))}"

        def run() -> tuple[str, dict]:
            if name not in keys:
                raise ValueError("no key given")
            result = copy_table(spark, spark.table(f"`{source_db}`.`{name}`"), target, keys[name])
            return target, {"copied": result.copied, "rejected": result.rejected}

        return Item(fingerprint, run, lambda output: output == target and spark.catalog.tableExists(target))

    with scoped_conf(spark, RUNTIME_BROADCAST_ONLY):
        outcomes = JobLedger(spark, ledger).run({n: item(n) for n in names}, max_workers)
    rows = [(rename.get(o.item, o.item), o.counts.get("copied", 0), o.counts.get("rejected", 0), o.error, o.state) for o in outcomes]
    return spark.createDataFrame(rows, "table_name string, copied bigint, rejected bigint, error string, state string")
