"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str = "_ingestion_timestamp",
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The most recent row of every key; rows with NULL keys form groups of their own.

    Rows loaded together share their ingestion time, so the order goes on through
    ``tiebreak`` (by default all other sortable columns), descending.  That makes
    the winner the same on every run and on every partitioning.

    Each map task keeps one row per key before the shuffle, which is what a key
    that holds much of the table sends per task.
    """
    if tiebreak is None:
        tiebreak = [
            f.name
            for f in df.schema
            if f.name not in {*keys, order_col} and not isinstance(f.dataType, _UNORDERED)
        ]
    order = [F.desc(f"`{c}`") for c in (order_col, *tiebreak)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )
