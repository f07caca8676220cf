"""Row filters and column masks, with the reader's rights passed in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MASK = "REDACTED"


def mask_columns(df: DataFrame, columns: Sequence[str], may_read: bool) -> DataFrame:
    """Replace text by a fixed word for readers without access."""
    return df if may_read else df.withColumns({c: F.lit(MASK) for c in columns})


def row_filter(
    df: DataFrame, column: str, allowed: DataFrame, restricted: bool, allowed_column: str
) -> DataFrame:
    """For restricted readers, only rows whose value is on the list of allowed ones."""
    if not restricted:
        return df
    listed = allowed.select(F.col(allowed_column).alias("_allowed"))
    return df.join(listed, F.col(column) == F.col("_allowed"), "left_semi")
