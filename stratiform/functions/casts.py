"""Type changes expressed as one projection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cast_all_to_string(df: DataFrame) -> DataFrame:
    """Every column as text, the way raw layers keep data of unknown quality."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def cast_by_mapping(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Cast the mapped columns that exist; text that does not parse becomes NULL."""
    return df.select(
        [
            F.col(f"`{c}`").try_cast(mapping[c]).alias(c) if c in mapping else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
