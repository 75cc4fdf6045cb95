"""tessera — consolidate many copies of one logical table on Spark.

Every public function builds a DataFrame plan (or runs one write action) with
the stock DataFrame API; Catalyst and AQE choose the physical strategy.
"""

from tessera.functions.normalize import normalize_column
from tessera.operators.combine import (combine_by_suffix, combine_parquet_tables, combine_tables, union_by_name,
                                       union_same_table, union_tagged)
from tessera.operators.copying import copy_all_tables, copy_table, upsert
from tessera.operators.snapshot import restore_snapshot, snapshot_tables
from tessera.plans.consolidation import consolidate, consolidate_by_suffix
from tessera.session import get_session, scratch_path
from tessera.sinks.files import compact_write, write_json, write_manifest
from tessera.sinks.tables import create_table_as

__all__ = [
    "get_session", "scratch_path",
    "union_tagged", "union_same_table", "union_by_name", "combine_tables", "combine_parquet_tables",
    "combine_by_suffix", "consolidate", "consolidate_by_suffix",
    "normalize_column",
    "upsert", "copy_table", "copy_all_tables", "snapshot_tables", "restore_snapshot",
    "create_table_as", "compact_write", "write_json", "write_manifest",
]
__version__ = "0.1.0"
