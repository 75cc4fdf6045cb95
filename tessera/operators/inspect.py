"""Inspection: the first rows of a result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """``df.show(n)`` as a DataFrame: n rows, deterministic when ``order_by`` is given.

    With an order this plans as ``TakeOrderedAndProject``: each task keeps
    its own top n and only n rows per task reach the final merge.
    """
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)
