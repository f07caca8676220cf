"""Dimension tables and their surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiform.session import partitions_of, reliable_checkpoint

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def dimension(
    df: DataFrame, columns: Sequence[str], include_counts: bool = True
) -> DataFrame:
    """Distinct combinations of ``columns``, with the rows behind each if wanted."""
    if include_counts:
        return df.groupBy(*columns).agg(F.count("*").alias("record_count"))
    return df.select(*columns).distinct()


def _number_by_range(dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sort by range, then add the sizes of the ranges before to the local position."""
    dim = reliable_checkpoint(dim)  # bounds are sampled first, then the rows are dealt
    ranges = partitions_of(dim)
    ranged = dim.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns)
    numbered = ranged.withColumn("_id", F.monotonically_increasing_id())
    # Range bounds come from a sample, so they have to be drawn once for both uses.
    numbered = reliable_checkpoint(numbered).withColumn(
        "_part", F.shiftright("_id", _ROW_BITS)
    )
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_rows"))
    # One row per range: the window below sees the partition count, not the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    position = F.col("_id") - F.shiftleft(F.col("_part"), _ROW_BITS)
    return (
        numbered.join(offsets, "_part")
        .withColumn("dimension_key", F.col("_before") + position + 1)
        .drop("_part", "_id", "_before")
    )


def surrogate_key(dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``dimension_key``: 1, 2, ... in the order of ``columns``, NULLs first.

    ``dim`` holds each combination once.  It is dealt by ranges of the columns, one of
    about 128 MB or more of them, and kept in the shared folder before it is numbered.
    """
    return _number_by_range(dim, columns)
