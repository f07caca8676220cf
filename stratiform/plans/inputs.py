"""Inputs the registered queries share, all derived from the given tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.functions.trip import derive_trip_columns, quality_filter
from stratiform.operators.cleansing import quality_flag
from stratiform.operators.enrich import checked_broadcast
from stratiform.plans.medallion import to_silver_trips
from stratiform.sources import star_table, trips

# Zones that play the airports in the trip view.
AIRPORTS = ("NATION_5", "NATION_6")

DEDUP_TIEBREAK = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def zones(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = star_table(spark, sf, "nation"), star_table(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("zone"), F.col("r_name").alias("borough")
    )


def vendors(spark: SparkSession, sf: str) -> DataFrame:
    """Names for every brand but one, so that the left join has misses."""
    brands = star_table(spark, sf, "part").select(F.col("p_brand").alias("vendor")).distinct()
    named = brands.where(F.col("vendor") != "Brand#1").withColumn(
        "vendor_name", F.concat(F.lit("Maker of "), "vendor")
    )
    return checked_broadcast(named)


def silver_trips(spark: SparkSession, sf: str) -> DataFrame:
    return to_silver_trips(trips(spark, sf), zones(spark, sf), vendors(spark, sf), AIRPORTS)


def zone_trips(spark: SparkSession, sf: str) -> DataFrame:
    """The part of the silver trips that zone aggregates read, without the lookups."""
    columns = (
        "pickup_datetime",
        "pickup_zone",
        "dropoff_zone",
        "trip_distance_mi",
        "trip_duration_min",
        "fare_amount",
        "tip_amount",
        "total_amount",
    )
    return derive_trip_columns(quality_filter(trips(spark, sf, columns)), AIRPORTS)


def config_trips(spark: SparkSession, sf: str, columns: Sequence[str]) -> DataFrame:
    """Trips with the distance named as in the metric tables."""
    return trips(spark, sf, columns).withColumnRenamed("trip_distance_mi", "trip_distance")


def flagged_trips(spark: SparkSession, sf: str, extra: Sequence[str] = ()) -> DataFrame:
    """Trips with some keys missing, and the quality flag that follows from that."""
    columns = [
        "trip_id",
        "pickup_datetime",
        "fare_amount",
        "tip_amount",
        "total_amount",
        "trip_distance_mi",
        "passenger_count",
        "l_orderkey",
        *extra,
    ]
    df = config_trips(spark, sf, columns).withColumn(
        "trip_id", F.when(F.pmod("l_orderkey", F.lit(97)) != 0, F.col("trip_id"))
    )
    return quality_flag(df, "trip_id", "pickup_datetime")
