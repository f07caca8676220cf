"""Derivations on single trip records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.config import TripThresholds

# Zones that count as airports.
AIRPORT_ZONES: tuple[str, ...] = ("JFK", "LGA")


def temporal(df: DataFrame, ts_col: str = "pickup_datetime") -> DataFrame:
    """Add ``pickup_ts`` and its date, year, month, day and hour."""
    ts = F.to_timestamp(ts_col)
    return df.select(
        "*",
        ts.alias("pickup_ts"),
        F.to_date(ts).alias("pickup_date"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
    )


def speed_mph(
    distance: str = "trip_distance_mi", duration_min: str = "trip_duration_min"
) -> Column:
    """Miles per hour; NULL unless the duration is positive."""
    minutes = F.col(duration_min)
    return F.when(minutes > 0, F.col(distance) / (minutes / F.lit(60.0)))


def airport_trip(
    airports: Sequence[str] = AIRPORT_ZONES,
    pickup: str = "pickup_zone",
    dropoff: str = "dropoff_zone",
) -> Column:
    """1 when either end of the trip is an airport, else 0 (also for unknown zones)."""
    touches = F.col(pickup).isin(*airports) | F.col(dropoff).isin(*airports)
    return F.when(touches, 1).otherwise(0)


def surge_proxy(fare: str = "fare_amount", total: str = "total_amount") -> Column:
    """Share paid on top of the fare; NULL unless the fare is positive."""
    paid = F.col(fare).cast("double")
    return F.when(F.col(fare) > 0, (F.col(total) - F.col(fare)).cast("double") / paid)


def quality_filter(
    df: DataFrame,
    limits: TripThresholds = TripThresholds(),
    distance: str = "trip_distance_mi",
    duration: str = "trip_duration_min",
    fare: str = "fare_amount",
) -> DataFrame:
    """Keep trips above all three bounds; a missing value fails its bound."""
    return df.where(
        (F.col(distance) > limits.distance)
        & (F.col(duration) > limits.duration)
        & (F.col(fare) > limits.fare)
    )


def derive_trip_columns(
    df: DataFrame, airports: Sequence[str] = AIRPORT_ZONES, ts_col: str = "pickup_datetime"
) -> DataFrame:
    """Temporal columns, speed, airport flag and surge proxy in one projection chain."""
    return temporal(df, ts_col).select(
        "*",
        speed_mph().alias("speed_mph"),
        airport_trip(airports).alias("airport_trip"),
        surge_proxy().alias("surge_proxy"),
    )
