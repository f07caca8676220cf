"""Declarative settings the operators take: column roles, type maps, thresholds."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

# Casts that turn text-typed gold tables into logical types.
DAILY_TYPES: Mapping[str, str] = {
    "trip_date": "date",
    "total_trips": "bigint",
    "total_fare": "decimal(18,2)",
    "avg_fare": "decimal(18,2)",
    "total_tips": "decimal(18,2)",
    "avg_tip": "decimal(18,2)",
    "total_revenue": "decimal(18,2)",
    "avg_revenue": "decimal(18,2)",
    "total_distance": "decimal(18,2)",
    "avg_distance": "decimal(18,2)",
    "avg_passengers": "decimal(10,2)",
    "min_fare": "decimal(18,2)",
    "max_fare": "decimal(18,2)",
    "year": "int",
    "aggregation_timestamp": "timestamp",
}

MONTHLY_TYPES: Mapping[str, str] = {
    "year_month": "string",
    "total_trips": "bigint",
    "total_fare": "decimal(18,2)",
    "avg_fare": "decimal(18,2)",
    "total_tips": "decimal(18,2)",
    "avg_tip": "decimal(18,2)",
    "total_revenue": "decimal(18,2)",
    "avg_revenue": "decimal(18,2)",
    "total_distance": "decimal(18,2)",
    "avg_distance": "decimal(18,2)",
    "avg_passengers": "decimal(10,2)",
    "active_days": "int",
    "year": "int",
    "aggregation_timestamp": "timestamp",
}

PASSENGER_TYPES: Mapping[str, str] = {
    "passenger_count": "int",
    "total_trips": "bigint",
    "total_fare": "decimal(18,2)",
    "avg_fare": "decimal(18,2)",
    "total_revenue": "decimal(18,2)",
    "avg_distance": "decimal(18,2)",
    "year": "int",
    "aggregation_timestamp": "timestamp",
}

# Spellings of "no value" found in text-typed files.
NULL_TOKENS: tuple[str, ...] = ("", "null", "NULL")

# Columns a silver table adds to its bronze source.
SILVER_ADDED_COLUMNS: tuple[str, ...] = (
    "_is_valid",
    "_validation_errors",
    "_null_column_count",
    "_completeness_score",
    "_silver_processed_timestamp",
)


@dataclass(frozen=True)
class ColumnRoles:
    """Which columns of a dataset are keys, dates, metrics and dimensions."""

    keys: Sequence[str]
    dates: Sequence[str]
    metrics: Sequence[str] = ()
    dimensions: Sequence[str] = ()
    strings: Sequence[str] = ()
    null_rules: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def from_mapping(cls, raw: Mapping[str, Any]) -> ColumnRoles:
        return cls(
            keys=tuple(raw.get("key_columns", ())),
            dates=tuple(raw.get("date_columns", ())),
            metrics=tuple(raw.get("metric_columns", ())),
            dimensions=tuple(raw.get("dimension_columns", ())),
            strings=tuple(raw.get("string_columns", ())),
            null_rules=dict(raw.get("null_handling_rules", {})),
        )

    @classmethod
    def from_json(cls, path: str | Path) -> ColumnRoles:
        return cls.from_mapping(json.loads(Path(path).read_text()))


@dataclass(frozen=True)
class TripMeasures:
    """Column names of the trip measures the metric tables are built from."""

    fare: str = "fare_amount"
    tip: str = "tip_amount"
    revenue: str = "total_amount"
    distance: str = "trip_distance"
    passengers: str = "passenger_count"


@dataclass(frozen=True)
class TripThresholds:
    """Lower bounds (exclusive) a trip must exceed to be kept."""

    distance: float = 0.2
    duration: float = 2.0
    fare: float = 3.0
