"""A trip-record view over a star schema of orders and line items.

Line items play the trips; orders, customers, suppliers and parts carry the
pickup time, the two zones and the vendor.  Only the tables that the requested
columns come from are joined: every foreign key resolves, so an unused join
would change nothing but the cost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the trip view and the tables beyond line items that each one needs.
_ORIGIN: dict[str, tuple[str, ...]] = {
    "trip_id": (),
    "pickup_datetime": ("orders",),
    "dropoff_datetime": (),
    "pickup_zone": ("orders", "customer"),
    "dropoff_zone": ("supplier",),
    "passenger_count": (),
    "trip_distance_mi": (),
    "trip_duration_min": ("orders",),
    "fare_amount": (),
    "tip_amount": (),
    "total_amount": (),
    "payment_type": ("orders",),
    "vendor": ("part",),
    "l_orderkey": (),
    "l_linenumber": (),
    "l_partkey": (),
    "l_suppkey": (),
    "l_quantity": (),
    "l_extendedprice": (),
    "l_returnflag": (),
    "l_linestatus": (),
    "l_shipdate": (),
}

TRIP_COLUMNS: tuple[str, ...] = (
    "trip_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_zone",
    "dropoff_zone",
    "passenger_count",
    "trip_distance_mi",
    "trip_duration_min",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "payment_type",
    "vendor",
)


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = TRIP_COLUMNS
) -> DataFrame:
    """The trip view, restricted to ``columns``."""
    needed = {t for c in columns for t in _ORIGIN[c]}

    def load(name: str) -> DataFrame:
        return star_table(spark, sf_dir, name)

    df = load("lineitem")
    if "orders" in needed:
        df = df.join(load("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if "customer" in needed:
        home = load("nation").select(
            F.col("n_nationkey").alias("c_nation"), F.col("n_name").alias("pickup_zone")
        )
        df = df.join(load("customer"), F.col("o_custkey") == F.col("c_custkey")).join(
            home, F.col("c_nationkey") == F.col("c_nation")
        )
    if "supplier" in needed:
        away = load("nation").select(
            F.col("n_nationkey").alias("s_nation"), F.col("n_name").alias("dropoff_zone")
        )
        df = df.join(load("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(
            away, F.col("s_nationkey") == F.col("s_nation")
        )
    if "part" in needed:
        df = df.join(load("part"), F.col("l_partkey") == F.col("p_partkey"))

    fare = F.col("l_extendedprice").cast("decimal(18,2)")
    # Decimal all the way: sums are then exact and independent of their order.
    tip = (
        F.col("l_extendedprice").cast("decimal(12,2)")
        * (F.col("l_tax") + F.lit(0.0)).cast("decimal(4,2)")
    ).cast("decimal(18,4)")
    computed = {
        "trip_id": lambda: F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "pickup_datetime": lambda: F.col("o_orderdate"),
        "dropoff_datetime": lambda: F.col("l_shipdate"),
        "passenger_count": lambda: F.col("l_linenumber"),
        "trip_distance_mi": lambda: F.col("l_quantity"),
        "trip_duration_min": lambda: F.datediff("l_shipdate", "o_orderdate").cast("double"),
        "fare_amount": lambda: fare,
        "tip_amount": lambda: tip,
        "total_amount": lambda: (fare + tip).cast("decimal(18,4)"),
        "payment_type": lambda: F.col("o_orderpriority"),
        "vendor": lambda: F.col("p_brand"),
    }
    return df.select(
        [computed.get(c, lambda c=c: F.col(c))().alias(c) for c in columns]
    )
