"""Lineage and processing columns added as data moves between layers."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clock(now: datetime | None = None) -> Column:
    """The processing time: the query's start, or a fixed instant for reruns.

    An instant without a time zone is in UTC, wherever the driver runs.
    """
    if now is None:
        return F.current_timestamp()
    return F.lit(now if now.tzinfo else now.replace(tzinfo=UTC)).cast("timestamp")


def _own(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns if c != "_metadata"]


def with_audit(df: DataFrame, now: datetime | None = None) -> DataFrame:
    """Add ingestion time and date plus the name and age of the file a row came from.

    ``df`` has to be a file scan, whose hidden metadata tells the file, or a union of
    scans that carries it as a column ``_metadata`` (which is dropped).
    """
    at = clock(now)
    return df.select(
        *_own(df),
        at.alias("_ingestion_timestamp"),
        F.to_date(at).alias("_ingestion_date"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_modified_time"),
    )


def with_run_metadata(
    df: DataFrame, year: str, run_id: str, now: datetime | None = None
) -> DataFrame:
    """Text-typed run columns for raw layers that keep everything as text."""
    at = clock(now)
    return df.select(
        *_own(df),
        at.cast("string").alias("ingestion_timestamp"),
        F.col("_metadata.file_path").alias("source_file"),
        F.to_date(at).cast("string").alias("processing_date"),
        F.lit(year).alias("year"),
        F.lit(run_id).alias("pipeline_run_id"),
    )


def transform_metadata(
    df: DataFrame,
    applied: str = "deduplication,null_handling",
    now: datetime | None = None,
) -> DataFrame:
    return df.select(
        "*",
        clock(now).cast("string").alias("silver_processed_timestamp"),
        F.lit(applied).alias("cleansing_applied"),
    )


def gold_metadata(df: DataFrame, level: str, now: datetime | None = None) -> DataFrame:
    return df.select(
        "*",
        clock(now).alias("_gold_processed_timestamp"),
        F.lit(level).alias("aggregation_level"),
    )


def metric_metadata(df: DataFrame, year: str, now: datetime | None = None) -> DataFrame:
    return df.select("*", clock(now).alias("aggregation_timestamp"), F.lit(year).alias("year"))
