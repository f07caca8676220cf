"""Where queries are registered together with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Nudge before rounding, so that values next to a tie round alike everywhere.
NUDGE = 1e-9


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its check in SQL where SQL can express it."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(tune(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Types that look the same in every engine: bigint, double, text, boolean."""

    def convert(f: T.StructField) -> Column:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return col.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return col.cast("bigint").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return col.cast("string").alias(f.name)
        return col

    return df.select([convert(f) for f in df.schema])


def rounded(df: DataFrame, *columns: str, places: int = 4) -> DataFrame:
    """Round derived floating-point columns; the check does the same."""
    return df.withColumns(
        {c: F.round(F.col(c).cast("double") + F.lit(NUDGE), places) for c in columns}
    )


def r(sql: str, places: int = 4) -> str:
    return f"round({sql} + 1e-9, {places})"


def dbl(sql: str) -> str:
    return f"CAST({sql} AS DOUBLE)"


def big(sql: str) -> str:
    return f"CAST({sql} AS BIGINT)"


def mean_sql(column: str) -> str:
    return f"{dbl(f'sum({column})')} / nullif(count({column}), 0)"


# The trip view, for the checks.
TRIPS = """trips AS (
  SELECT l_orderkey || '-' || l_linenumber AS trip_id,
         o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
         cn.n_name AS pickup_zone, sn.n_name AS dropoff_zone,
         l_linenumber AS passenger_count, l_quantity AS trip_distance_mi,
         CAST(date_diff('day', o_orderdate, l_shipdate) AS DOUBLE) AS trip_duration_min,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS fare_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax + 0.0 AS DECIMAL(4,2))
              AS DECIMAL(18,4)) AS tip_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2))
              + CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax + 0.0 AS DECIMAL(4,2))
                     AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS total_amount,
         o_orderpriority AS payment_type, p_brand AS vendor,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         l_returnflag, l_linestatus, l_shipdate
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN part ON l_partkey = p_partkey)"""

LOOKUPS = """zones AS (
  SELECT n_name AS zone, r_name AS borough FROM nation JOIN region ON n_regionkey = r_regionkey),
vendors AS (
  SELECT DISTINCT p_brand AS vendor, 'Maker of ' || p_brand AS vendor_name
  FROM part WHERE p_brand <> 'Brand#1')"""

SILVER_TRIPS = f"""{TRIPS}, {LOOKUPS}, silver AS (
  SELECT t.*, CAST(pickup_datetime AS DATE) AS pickup_date,
         year(pickup_datetime) AS "year", month(pickup_datetime) AS "month",
         day(pickup_datetime) AS "day", hour(pickup_datetime) AS "hour",
         CASE WHEN trip_duration_min > 0
              THEN trip_distance_mi / (trip_duration_min / CAST(60 AS DOUBLE)) END AS speed_mph,
         CASE WHEN pickup_zone IN ('NATION_5', 'NATION_6')
                OR dropoff_zone IN ('NATION_5', 'NATION_6') THEN 1 ELSE 0 END AS airport_trip,
         CASE WHEN fare_amount > 0
              THEN CAST(total_amount - fare_amount AS DOUBLE) / CAST(fare_amount AS DOUBLE)
              END AS surge_proxy,
         pz.borough AS pickup_borough, dz.borough AS dropoff_borough, v.vendor_name
  FROM trips t
  LEFT JOIN zones pz ON t.pickup_zone = pz.zone
  LEFT JOIN zones dz ON t.dropoff_zone = dz.zone
  LEFT JOIN vendors v ON t.vendor = v.vendor
  WHERE trip_distance_mi > 0.2 AND trip_duration_min > 2.0 AND fare_amount > 3.0)"""

DEDUP_ORDER = (
    "dropoff_datetime DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, "
    "l_extendedprice DESC"
)
