"""Constraints at write: rows that break a rule go to a table of their own."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.operators.cleansing import validity_columns

_SIDE = "_accepted"


def write_checked(
    df: DataFrame,
    path: str,
    rules: Mapping[str, str | Column],
    mode: str = "errorifexists",
) -> None:
    """Write ``df`` below ``path``, rows that break a rule apart from the others.

    A rule holds only where it is true.  Both sides are written by one pass over the
    input, as two folders of one job, so that they appear together or not at all.  Read
    them with ``accepted`` and ``quarantined``; ``mode`` is the writer's, with
    ``append`` adding to both.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    checked = validity_columns(df, rules).select(*kept, "_validation_errors", F.col("_is_valid").alias(_SIDE))
    checked.write.mode(mode).partitionBy(_SIDE).parquet(path)


def _side(spark: SparkSession, path: str, value: bool) -> DataFrame:
    # Both folders count for the schema: one of them may be missing.
    return spark.read.parquet(path).where(F.col(_SIDE) == F.lit(value)).drop(_SIDE)


def accepted(spark: SparkSession, path: str) -> DataFrame:
    """The rows that broke no rule, as they were."""
    return _side(spark, path, True).drop("_validation_errors")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """The rows that broke a rule, with the names of those in ``_validation_errors``."""
    return _side(spark, path, False)
