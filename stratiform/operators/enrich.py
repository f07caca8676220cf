"""Attaching attributes from lookup tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def checked_broadcast(
    lookup: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Mark a lookup for broadcasting if it is measured to be small enough.

    For lookups derived by a query, whose size the planner overestimates.  The
    measure is one parallel aggregate; a larger lookup comes back unmarked.
    """
    width = F.octet_length(F.to_json(F.struct("*")))
    size = lookup.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    small = size.n <= max_rows and size.bytes <= max_bytes
    return F.broadcast(lookup) if small else lookup


def enrich(
    df: DataFrame, lookup: DataFrame, on: Mapping[str, str], take: Mapping[str, str]
) -> DataFrame:
    """Left join: ``on`` maps columns of ``df`` to lookup columns, ``take`` lookup
    columns to the names they get.  Unmatched rows keep NULLs.

    No broadcast is forced.  The planner broadcasts the lookup when its size is
    known to be below ``spark.sql.autoBroadcastJoinThreshold``; beyond that it
    shuffles, and adaptive execution splits the partitions of frequent keys.
    """
    slim = lookup.select(
        *[F.col(r).alias(f"_on_{r}") for r in on.values()],
        *[F.col(s).alias(t) for s, t in take.items()],
    )
    cond = [F.col(left) == F.col(f"_on_{right}") for left, right in on.items()]
    return df.join(slim, cond, "left").drop(*[f"_on_{r}" for r in on.values()])


def add_pickup_borough(df: DataFrame, zones: DataFrame) -> DataFrame:
    return enrich(df, zones, {"pickup_zone": "zone"}, {"borough": "pickup_borough"})


def add_dropoff_borough(df: DataFrame, zones: DataFrame) -> DataFrame:
    return enrich(df, zones, {"dropoff_zone": "zone"}, {"borough": "dropoff_borough"})


def add_vendor_name(df: DataFrame, vendors: DataFrame) -> DataFrame:
    return enrich(df, vendors, {"vendor": "vendor"}, {"vendor_name": "vendor_name"})
