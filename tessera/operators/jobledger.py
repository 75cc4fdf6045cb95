"""A ledger for jobs over many tables: finished items are not done again.

Each item of a job (a table to copy, a suffix to combine) has a fingerprint of its input. When an item
ends, one row is committed below the ledger's folder: item, fingerprint, state, output, counts, error. A later run of the job
does only the items that did not end, failed, or whose input is another one by now; of the others it returns
the row it finds. Items are committed one by one, so a job that dies at table 900 of 1,000 goes on there.

A fingerprint is taken before its item starts: an input that changes meanwhile is done again next time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import path_exists, run_parallel
from tessera.sources.ledger import listed

ENTRIES = "item string, fingerprint string, state string, output string, counts string, error string, finished timestamp"


def files_fingerprint(spark: SparkSession, *roots: str) -> str:
    """Of the files below ``roots``: their number, bytes, and a sum of hashes of path, length and time (one small row each)."""
    out = []
    for root in roots:
        row = listed(spark, root).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b"),
                                      F.sum(F.xxhash64("path", "length", "modified").cast("decimal(38,0)")).alias("h")).first()
        out.append(f"{row['n']}-{row['b'] or 0}-{row['h'] or 0}")
    return "/".join(out)


@dataclass
class Item:
    """``run`` does the item and returns (output, counts); ``fingerprint`` is None where the input can't be told (always done)."""
    fingerprint: Callable[[], str | None]
    run: Callable[[], tuple[str, dict]]
    still_there: Callable[[str], bool] = lambda output: True


@dataclass
class Outcome:
    item: str
    state: str          # done | failed | unchanged
    output: str | None
    counts: dict
    error: str | None


class JobLedger:
    """The ledger in folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> DataFrame:
        """Every committed row, of all runs."""
        at = f"{self.path}/entries"
        if not path_exists(self.spark, at):
            return self.spark.createDataFrame([], ENTRIES)
        return self.spark.read.schema(ENTRIES).option("recursiveFileLookup", "true").parquet(at)

    def latest(self) -> dict[str, object]:
        """The newest row of each item (as many as the job has items)."""
        newest = F.max_by(F.struct("fingerprint", "state", "output", "counts"), "finished").alias("last")
        return {r["item"]: r["last"] for r in self.entries().groupBy("item").agg(newest).collect()}

    def _commit(self, item: str, fingerprint: str | None, state: str, output: str | None, counts: dict, error: str | None) -> None:
        row = self.spark.createDataFrame([(item, fingerprint, state, output, json.dumps(counts), error)],
                                         "item string, fingerprint string, state string, output string, counts string, error string")
        row.withColumn("finished", F.current_timestamp()).coalesce(1).write.parquet(f"{self.path}/entries/{uuid.uuid4().hex}")

    def run(self, items: Mapping[str, Item], max_workers: int = 4, on_error: str = "report") -> list[Outcome]:
        """Do what is open, in the order of ``items``; an error ends its item alone, or with ``on_error="raise"`` the run."""
        before = self.latest()

        def one(entry):
            name, item = entry
            mark = item.fingerprint()
            last = before.get(name)
            if last is not None and mark is not None and last["state"] == "done" and last["fingerprint"] == mark and item.still_there(last["output"]):
                return Outcome(name, "unchanged", last["output"], json.loads(last["counts"]), None)
            try:
                output, counts = item.run()
            except Exception as exc:  # noqa: BLE001 — kept in the ledger, and raised if asked to
                error = f"{type(exc).__name__}: {exc}"
                self._commit(name, mark, "failed", None, {}, error)
                if on_error == "raise":
                    raise
                return Outcome(name, "failed", None, {}, error)
            self._commit(name, mark, "done", output, counts, None)
            return Outcome(name, "done", output, counts, None)

        return run_parallel(one, items.items(), max_workers)
