"""Incremental consolidation: each run combines only files not seen before.

The batch combine re-reads every tenant table on every run. Here all table
roots together are one Structured Streaming file source; a run with the
``availableNow`` trigger processes exactly the files that arrived since the
last run (the checkpoint remembers them by path, however old they are) and
appends them to the combined output, whose ``_spark_metadata`` log makes every
run's output appear atomically and exactly once. A run killed half-way, or an
executor lost during it, is simply re-run.

As files are remembered by path, tables may be added, left out and reordered
between runs. Every run reads with the columns all tables have by then, so a
new column is kept from its first file on; a column whose type changed beyond
what Parquet reads as the wider type raises ``SchemaConflict``. Schemas come from a ledger in the
checkpoint, so a run opens the footers of new files only, however many there were before.

The checkpoint lies in the sink folder unless one is named, so that both stay
together. A sink with a log but without its checkpoint is refused (Spark would
take its first batches for written already and skip them), and so is a
checkpoint whose sink is gone.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessera.session import path_exists
from tessera.sources.files import literal_path, location, outermost, tag_from_path
from tessera.sources.ledger import SchemaLedger


def default_checkpoint(sink_path: str) -> str:
    """The sink's own checkpoint folder."""
    return f"{sink_path.rstrip('/')}/_checkpoint"


def _one_pattern(locations: list[str]) -> str:
    """A path pattern for all roots: one file source has one path."""
    if len(locations) == 1:
        return literal_path(locations[0])
    heads = {loc.split("/", 3)[0] + "//" + loc.split("/", 3)[2] for loc in locations}
    if len(heads) > 1:
        raise ValueError(f"one incremental combine reads one file system; these roots lie in {sorted(heads)}")
    head = heads.pop()
    inner = [literal_path(loc[len(head) + 1:]) for loc in locations]
    return head + "/{" + ",".join(inner) + "}"


def incremental_combine(spark: SparkSession, roots: Mapping[str, str], sink_path: str,
                        checkpoint: str | None = None, tag_col: str = "source_table",
                        partition_levels: int = 0, max_files_per_trigger: int | None = None,
                        available_now: bool = True, query_name: str | None = None,
                        transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Start (and with ``available_now`` run to the end of the current files) one combine run.

    ``transform`` is applied to the combined stream before the sink, e.g.
    ``lambda df: normalize_column(df, "value")`` for the whole
    combine → normalise flow, incrementally.
    """
    ckpt = checkpoint or default_checkpoint(sink_path)
    has_log, has_state = path_exists(spark, f"{sink_path.rstrip('/')}/_spark_metadata"), path_exists(spark, f"{ckpt}/offsets")
    if has_log and not has_state:
        raise ValueError(f"{sink_path} was written with another checkpoint than {ckpt}")
    if has_state and not has_log and path_exists(spark, f"{ckpt}/commits/0"):
        raise ValueError(f"{ckpt} belongs to a sink that is no longer at {sink_path}")
    # Columns of all tables, each in a type Parquet reads every file as. Only files the ledger has not seen are opened.
    ledger = SchemaLedger(spark, f"{ckpt}/schemas")
    ledger.update(roots)
    schema = ledger.common_schema(roots)
    data = [f.name for f in schema.fields if f.name.lower() != tag_col.lower()]
    # Files are told apart by path, so none is too old to be new.
    reader = (spark.readStream.schema(StructType([f for f in schema.fields if f.name in data]))
              .option("recursiveFileLookup", "true").option("maxFileAge", "36500d"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(_one_pattern(outermost([location(spark, r) for r in roots.values()])))
    derived = [f"partition_{i}" for i in range(partition_levels)]
    combined = tag_from_path(stream, roots, tag_col, partition_levels).select(
        *(f"`{c}`" for c in data if c not in derived), *derived, tag_col)
    if transform is not None:
        combined = transform(combined)
    writer = (combined.writeStream.format("parquet").option("path", sink_path)
              .option("checkpointLocation", ckpt).outputMode("append"))
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_combined(spark: SparkSession, sink_path: str) -> DataFrame:
    """The sink with all columns any run wrote."""
    return spark.read.option("mergeSchema", "true").parquet(sink_path)


def run_once(spark: SparkSession, roots: Mapping[str, str], sink_path: str, **kwargs) -> None:
    """One incremental run to completion (raises if the run failed)."""
    query = incremental_combine(spark, roots, sink_path, available_now=True, **kwargs)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
