"""From raw to cleansed to aggregated: the operators composed per dataset style."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from stratiform.config import ColumnRoles, TripMeasures, TripThresholds
from stratiform.functions.audit import (
    gold_metadata,
    metric_metadata,
    transform_metadata,
    with_audit,
    with_run_metadata,
)
from stratiform.functions.casts import cast_all_to_string
from stratiform.functions.trip import AIRPORT_ZONES, derive_trip_columns, quality_filter
from stratiform.operators import cleansing as cl
from stratiform.operators import enrich as en
from stratiform.operators import rollup as ru
from stratiform.operators.dedup import latest_per_key
from stratiform.operators.dimension import dimension, surrogate_key
from stratiform.sinks import append_or_create
from stratiform.sources import route_by_format


def ingest_folder(
    spark: SparkSession,
    root: str,
    table: str,
    partition_by: Sequence[str] = ("_ingestion_date",),
    now: datetime | None = None,
) -> list[str]:
    """Append the Parquet and CSV files of a folder to their raw tables; returns these."""
    routed = route_by_format(spark, root, table, lineage=True)
    for name, df in routed.items():
        append_or_create(with_audit(df, now), name, partition_by)
    return list(routed)


def to_bronze_text(
    raw: DataFrame, year: str, run_id: str, now: datetime | None = None
) -> DataFrame:
    """A file scan as text columns, with the run's metadata."""
    return cast_all_to_string(with_run_metadata(raw, year, run_id, now))


def to_silver(
    bronze: DataFrame,
    roles: ColumnRoles,
    order_col: str = "_ingestion_timestamp",
    rules: Mapping[str, str | Column] | None = None,
    tiebreak: Sequence[str] | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """Typed tables: latest row per key, clean text and NULLs, validity, completeness."""
    df = latest_per_key(bronze, roles.keys, order_col, tiebreak)
    if roles.strings:
        df = cl.standardize_strings(df, roles.strings)
    if roles.null_rules:
        df = cl.handle_nulls(df, roles.null_rules)
    return cl.completeness(cl.validity_columns(df, rules, now))


def to_silver_text(
    bronze: DataFrame,
    roles: ColumnRoles,
    order_col: str = "ingestion_timestamp",
    normalize_first: bool = False,
    tiebreak: Sequence[str] | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """Text-typed tables: latest row per key, NULL spellings resolved, quality flag.

    Keys are compared as they came unless ``normalize_first``: then the different
    spellings of a missing key fall together before duplicates are dropped.
    """
    if normalize_first:
        df = latest_per_key(cl.null_tokens(bronze), roles.keys, order_col, tiebreak)
    else:
        df = cl.null_tokens(latest_per_key(bronze, roles.keys, order_col, tiebreak))
    return transform_metadata(cl.quality_flag(df, roles.keys[0], roles.dates[0]), now=now)


def to_silver_trips(
    bronze: DataFrame,
    zones: DataFrame,
    vendors: DataFrame,
    airports: Sequence[str] = AIRPORT_ZONES,
    limits: TripThresholds = TripThresholds(),
) -> DataFrame:
    """Trip records: filtered, with derived columns, boroughs and vendor names."""
    kept = quality_filter(bronze, limits)
    return (
        derive_trip_columns(kept, airports)
        .transform(en.add_pickup_borough, zones)
        .transform(en.add_dropoff_borough, zones)
        .transform(en.add_vendor_name, vendors)
    )


def to_gold(
    silver: DataFrame, roles: ColumnRoles, now: datetime | None = None
) -> dict[str, DataFrame]:
    """Daily and monthly aggregates, and a keyed dimension table if there are dimensions."""
    date = roles.dates[0]
    gold = {
        level: gold_metadata(
            ru.time_rollup(silver, date, roles.metrics, roles.dimensions, level).drop(
                "aggregation_level"
            ),
            level,
            now,
        )
        for level in ("daily", "monthly")
    }
    if roles.dimensions:
        gold["dimensions"] = surrogate_key(
            dimension(silver, roles.dimensions), roles.dimensions
        )
    return gold


def to_gold_metrics(
    silver: DataFrame,
    year: str,
    date_col: str = "pickup_datetime",
    m: TripMeasures = TripMeasures(),
    now: datetime | None = None,
) -> dict[str, DataFrame]:
    """Trip metric tables over rows that passed the quality flag.

    The measures have to be typed; use ``cast_by_mapping`` on text-typed silver.
    """
    passed = cl.passed_only(silver)
    tables = {
        "daily_metrics": ru.daily_metrics(passed, date_col, m),
        "monthly_metrics": ru.monthly_metrics(passed, date_col, m),
        "passenger_metrics": ru.passenger_metrics(passed, m),
    }
    return {name: metric_metadata(df, year, now) for name, df in tables.items()}
