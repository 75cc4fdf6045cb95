"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path, ship_package

#: Rows per Arrow batch for the Python operators here: texts may be long, so batches are kept short.
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Settings the Python operators rely on: short Arrow batches, package importable by the workers."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def persist(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it back.

    Cuts lineage with a committed table: a lost executor costs only the tasks that read it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def tmp_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name += "_"
    return name


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(mod)


def fit_sample(docs: DataFrame, keep: Column, max_rows: int, n_rows: int, seed: int) -> Column:
    """Condition for a repeatable sample of about ``max_rows`` of ``n_rows`` rows, by a hash of doc_id."""
    if n_rows <= max_rows:
        return keep
    # As fine as the share asked for: the sample stays within its bound at any size.
    steps = 1_000_000 if max_rows * 1_000_000 >= n_rows else 10 ** 15
    return keep & (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(steps)) < max_rows * steps // n_rows)


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file ``name`` is; ``TOKENIZER_DIR`` overrides the installed package."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def row_id_names(df: DataFrame) -> tuple[str, str]:
    """Two column names that ``df`` does not have, for ``with_row_id``."""
    return tmp_name(df, "llm_row_file"), tmp_name(df, "llm_row_index")


def with_row_id(df: DataFrame) -> DataFrame:
    """``df`` with two columns (``row_id_names``) that name each row: its Parquet file and the position in it.

    The name is the same in every task and every retry. What is not a plain Parquet scan is written
    to the shared folder first.
    """
    from pyspark.errors import AnalysisException
    names = row_id_names(df)

    def named(rows):
        # A column of the caller's may be called _metadata as well; the file's own is asked for by name.
        own = rows.metadataColumn("_metadata")
        return rows.select("*", own.getField("file_path").alias(names[0]), own.getField("row_index").alias(names[1]))
    try:
        found = named(df)
        found.schema  # noqa: B018 — resolves the columns
        return found
    except AnalysisException:
        return named(persist(df, "rows"))


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
