"""Calendar and demand features, and a fare estimate built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions.trip import AIRPORT_ZONES, airport_trip
from stratiform.session import local_frame

# Holidays with raised demand.
HOLIDAYS: tuple[str, ...] = (
    "2021-01-01", "2021-01-18", "2021-02-15", "2021-05-31", "2021-07-04",
    "2021-07-05", "2021-09-06", "2021-10-11", "2021-11-11", "2021-11-25",
    "2021-12-24", "2021-12-25", "2021-12-31",
    "2022-01-01", "2022-01-17", "2022-02-21", "2022-05-30", "2022-07-04",
    "2022-09-05", "2022-10-10", "2022-11-11", "2022-11-24", "2022-12-24",
    "2022-12-25", "2022-12-26", "2022-12-31",
    "2023-01-01", "2023-01-02", "2023-01-16", "2023-02-20", "2023-05-29",
    "2023-07-04", "2023-09-04", "2023-10-09", "2023-11-10", "2023-11-23",
    "2023-12-24", "2023-12-25", "2023-12-31",
    "2024-01-01", "2024-01-15", "2024-02-19", "2024-05-27", "2024-07-04",
    "2024-09-02", "2024-10-14", "2024-11-11", "2024-11-28", "2024-12-24",
    "2024-12-25", "2024-12-31",
    "2025-01-01", "2025-01-20", "2025-02-17", "2025-05-26", "2025-07-04",
    "2025-09-01", "2025-10-13", "2025-11-11", "2025-11-27", "2025-12-24",
    "2025-12-25", "2025-12-31",
)

# Demand relative to 2023, by year.
YEAR_INDEX: Mapping[int, float] = {2021: 0.65, 2022: 0.85, 2023: 1.00, 2024: 1.15, 2025: 1.25}

# Seasonal demand by month.
MONTH_INDEX: Mapping[int, float] = {
    1: 0.85, 2: 0.88, 3: 0.95, 4: 1.00, 5: 1.05, 6: 1.10,
    7: 1.15, 8: 1.12, 9: 1.03, 10: 1.00, 11: 1.02, 12: 1.12,
}

# Demand by weekday, Monday being 0.
WEEKDAY_INDEX: Mapping[int, float] = {
    0: 1.00, 1: 1.00, 2: 1.02, 3: 1.02, 4: 1.10, 5: 1.25, 6: 1.20,
}

HOLIDAY_INDEX = 1.35

# Mean miles between ordered zone pairs, and for every other pair.
PAIR_MILES: tuple[tuple[str, str, float], ...] = (
    ("Manhattan", "Manhattan", 2.1),
    ("Manhattan", "Brooklyn", 5.5),
    ("Manhattan", "Queens", 7.0),
    ("Manhattan", "Bronx", 7.2),
    ("Brooklyn", "Queens", 6.0),
    ("Queens", "JFK", 11.0),
    ("Queens", "LGA", 7.5),
)
OTHER_PAIR_MILES = 3.5

# Fare components.
BASE_FARE = 2.75
FARE_PER_MILE = 2.50
FARE_PER_MINUTE = 0.60
AIRPORT_SURCHARGE = 1.75
NIGHT_SURCHARGE = 0.50
PEAK_SURCHARGE = 0.70


def _lookup(key: Column, values: Mapping[int, float]) -> Column:
    """Value of ``key`` in a constant mapping, NULL when absent."""
    pairs = [F.lit(x) for k, v in values.items() for x in (k, float(v))]
    return F.try_element_at(F.create_map(*pairs), key)


def _hour_between(hour: Column, first: int, last: int) -> Column:
    return hour.between(first, last)


def time_band(hour: Column) -> Column:
    """Demand multiplier of the hour: morning and evening peak, night, or neither."""
    return (
        F.when(_hour_between(hour, 7, 9), 1.15)
        .when(_hour_between(hour, 16, 19), 1.20)
        .when((hour >= 22) | (hour <= 2), 1.10)
        .otherwise(1.0)
    )


def calendar_features(
    df: DataFrame, ts_col: str, holidays: Sequence[str] = HOLIDAYS
) -> DataFrame:
    """Add ``is_holiday`` and the year, month and weekday demand indices.

    The calendar is a constant set, so it is tested inside the projection and
    needs no join.
    """
    day = F.to_date(ts_col)
    known = [F.to_date(F.lit(d)) for d in holidays]
    return df.select(
        "*",
        F.coalesce(day.isin(*known), F.lit(False)).alias("is_holiday"),
        _lookup(F.year(day), YEAR_INDEX).alias("year_index"),
        _lookup(F.month(day), MONTH_INDEX).alias("month_index"),
        _lookup(F.weekday(day), WEEKDAY_INDEX).alias("dow_index"),
    )


def demand_index() -> Column:
    """Expected demand of a day, over the columns of ``calendar_features``."""
    plain = F.col("year_index") * F.col("month_index") * F.col("dow_index")
    return plain * F.when(F.col("is_holiday"), HOLIDAY_INDEX).otherwise(1.0)


def surge(hour: Column) -> Column:
    """Price multiplier: grows with demand above 1; weekday and holiday play no part."""
    demand = F.col("year_index") * F.col("month_index") * time_band(hour)
    return F.lit(1.0) + F.greatest(F.lit(0.0), (demand - 1.0) * 0.6)


def surcharge(hour: Column, airports: Sequence[str] = AIRPORT_ZONES, night: bool = False) -> Column:
    """Flat additions.  ``night`` (20 to 6 o'clock) is off unless asked for."""
    total = F.when(airport_trip(airports) == 1, AIRPORT_SURCHARGE).otherwise(0.0)
    if night:
        total = total + F.when((hour >= 20) | (hour <= 6), NIGHT_SURCHARGE).otherwise(0.0)
    return total + F.when(_hour_between(hour, 16, 19), PEAK_SURCHARGE).otherwise(0.0)


def fare_estimate(
    hour: Column,
    distance: str = "trip_distance_mi",
    duration: str = "trip_duration_min",
    airports: Sequence[str] = AIRPORT_ZONES,
    night: bool = False,
) -> Column:
    """Fare a trip should cost, over the columns of ``calendar_features``."""
    metered = (
        F.lit(BASE_FARE)
        + F.lit(FARE_PER_MILE) * F.col(distance)
        + F.lit(FARE_PER_MINUTE) * F.col(duration)
    )
    return (metered + surcharge(hour, airports, night)) * surge(hour)


def fare_residual(hour: Column, fare: str = "fare_amount", **estimate) -> Column:
    """Actual minus estimated fare."""
    return F.col(fare).cast("double") - fare_estimate(hour, **estimate)


def pair_distances(spark: SparkSession, rows: Sequence[tuple] = PAIR_MILES) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("_from", T.StringType(), False),
            T.StructField("_to", T.StringType(), False),
            T.StructField("_miles", T.DoubleType(), False),
        ]
    )
    return local_frame(spark, rows, schema)


def expected_distance(
    df: DataFrame,
    pairs: DataFrame,
    default: float = OTHER_PAIR_MILES,
    pickup: str = "pickup_zone",
    dropoff: str = "dropoff_zone",
) -> DataFrame:
    """Add ``expected_miles`` for the ordered zone pair of each row."""
    match = (F.col(pickup) == F.col("_from")) & (F.col(dropoff) == F.col("_to"))
    return df.join(pairs, match, "left").select(
        *[df[c] for c in df.columns],
        F.coalesce("_miles", F.lit(default)).alias("expected_miles"),
    )
