"""Run SQL written for a Trino-style engine (``"db"."table"`` identifiers) on Spark SQL.

Spark parses double-quoted identifiers itself under ANSI mode with
``spark.sql.ansi.doubleQuotedIdentifiers``; the statement text is passed
through unchanged apart from a final ``;`` (and a comment after it), which
``spark.sql`` does not accept. A ``CREATE TABLE … AS SELECT …`` runs at
once; a query is analysed inside the scope and returned as a DataFrame.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tessera.session import scoped_conf

TRINO_STYLE = {"spark.sql.ansi.enabled": "true", "spark.sql.ansi.doubleQuotedIdentifiers": "true"}


def run_statement(spark: SparkSession, text: str) -> DataFrame:
    """One statement; a trailing ``;`` and a ``--`` comment after it are dropped."""
    stmt = re.sub(r";\s*(--[^\n]*)?\s*$", "", text.strip())
    with scoped_conf(spark, TRINO_STYLE):
        return spark.sql(stmt)
