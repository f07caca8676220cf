"""Cleansing, derived columns, lookups and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.functions import trip as tp
from stratiform.functions.audit import transform_metadata, with_audit, with_run_metadata
from stratiform.functions.casts import cast_all_to_string
from stratiform.operators import cleansing as cl
from stratiform.operators import enrich as en
from stratiform.operators.dedup import latest_per_key
from stratiform.plans.inputs import AIRPORTS, DEDUP_TIEBREAK, silver_trips, vendors, zones
from stratiform.plans.medallion import to_silver_text
from stratiform.plans.registry import (
    DEDUP_ORDER,
    LOOKUPS,
    SILVER_TRIPS,
    TRIPS,
    big,
    query,
    r,
    rounded,
)
from stratiform.config import ColumnRoles
from stratiform.sources import star_table, trips


@query(
    "brz_audit",
    """SELECT 'orders.parquet' AS file_name, count(*) AS row_count,
              true AS same_day, true AS has_file_time FROM orders""",
)
def brz_audit(spark, sf):
    audited = with_audit(star_table(spark, sf, "orders"))
    return audited.groupBy(
        F.substring_index("_source_file", "/", -1).alias("file_name")
    ).agg(
        F.count("*").alias("row_count"),
        F.bool_and(F.to_date("_ingestion_timestamp") == F.col("_ingestion_date")).alias("same_day"),
        F.bool_and(F.col("_source_modified_time").isNotNull()).alias("has_file_time"),
    )


@query(
    "brz_run_metadata",
    """SELECT '2023' AS "year", 'run-1' AS pipeline_run_id, 'orders.parquet' AS file_name,
              count(*) AS row_count, 10 AS date_length FROM orders""",
)
def brz_run_metadata(spark, sf):
    stamped = with_run_metadata(star_table(spark, sf, "orders"), "2023", "run-1")
    return stamped.groupBy(
        "year", "pipeline_run_id", F.substring_index("source_file", "/", -1).alias("file_name")
    ).agg(
        F.count("*").alias("row_count"),
        F.max(F.length("processing_date")).alias("date_length"),
    )


@query(
    "brz_cast_string",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
              o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
              o_orderpriority FROM orders""",
)
def brz_cast_string(spark, sf):
    orders = star_table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.to_date("o_orderdate").alias("o_orderdate"),
        "o_orderpriority",
    )
    return cast_all_to_string(orders)


def _untidy_customers(spark, sf):
    padded = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    return star_table(spark, sf, "customer").select(
        "c_custkey", padded.alias("segment"), F.concat(F.lit(" "), "c_name").alias("name")
    )


_UNTIDY = """SELECT c_custkey, {case}(trim('  ' || lower(c_mktsegment) || ' ')) AS segment,
  {case}(trim(' ' || c_name)) AS name FROM customer"""


@query("slv_standardize_upper", _UNTIDY.format(case="upper"))
def slv_standardize_upper(spark, sf):
    return cl.standardize_strings(_untidy_customers(spark, sf), ["segment", "name"])


@query("slv_standardize_lower", _UNTIDY.format(case="lower"))
def slv_standardize_lower(spark, sf):
    return cl.standardize_strings(_untidy_customers(spark, sf), ["segment", "name"], "lower")


@query("slv_standardize_trim", _UNTIDY.format(case=""))
def slv_standardize_trim(spark, sf):
    return cl.standardize_strings(_untidy_customers(spark, sf), ["segment", "name"], None)


_TOKENS = """
  CASE l_returnflag WHEN 'N' THEN 'null' WHEN 'A' THEN ' NULL' ELSE 'Null' END AS flag,
  CASE WHEN l_linestatus = 'F' THEN '' ELSE 'NULL' END AS status"""


def _token_lines(spark, sf):
    flag = F.col("l_returnflag")
    return star_table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(flag == "N", "null").when(flag == "A", " NULL").otherwise("Null").alias("flag"),
        F.when(F.col("l_linestatus") == "F", "").otherwise("NULL").alias("status"),
    )


@query(
    "slv_null_tokens",
    f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
               CASE WHEN flag NOT IN ('', 'null', 'NULL') THEN flag END AS flag,
               CASE WHEN status NOT IN ('', 'null', 'NULL') THEN status END AS status
        FROM (SELECT *, {_TOKENS} FROM lineitem)""",
)
def slv_null_tokens(spark, sf):
    return cl.null_tokens(_token_lines(spark, sf))


_GAPS = """gaps AS (
  SELECT CASE WHEN l_orderkey % 97 <> 0 THEN l_orderkey || '-' || l_linenumber END AS trip_id,
         CASE WHEN l_orderkey % 89 <> 0 THEN l_shipdate END AS dropoff_datetime,
         CASE WHEN l_orderkey % 13 <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END
           AS fare_amount,
         CASE WHEN l_linenumber < 7 THEN l_linenumber END AS passenger_count,
         l_partkey, l_suppkey FROM lineitem)"""


def _gappy_trips(spark, sf):
    key = F.col("l_orderkey")
    df = trips(
        spark,
        sf,
        (
            "trip_id",
            "dropoff_datetime",
            "fare_amount",
            "passenger_count",
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
        ),
    )
    return df.select(
        F.when(F.pmod(key, F.lit(97)) != 0, F.col("trip_id")).alias("trip_id"),
        F.when(F.pmod(key, F.lit(89)) != 0, F.col("dropoff_datetime")).alias("dropoff_datetime"),
        F.when(F.pmod(key, F.lit(13)) != 0, F.col("fare_amount")).alias("fare_amount"),
        F.when(F.col("passenger_count") < 7, F.col("passenger_count")).alias("passenger_count"),
        "l_partkey",
        "l_suppkey",
    )


_SHOWN = "CAST(CAST(dropoff_datetime AS DATE) AS VARCHAR) AS dropoff_date"


def _shown(df):
    return df.withColumn("dropoff_date", F.to_date("dropoff_datetime")).drop("dropoff_datetime")


@query(
    "slv_null_drop",
    f"""WITH {_GAPS} SELECT trip_id, {_SHOWN}, CAST(fare_amount AS DOUBLE) AS fare_amount,
          CAST(passenger_count AS BIGINT) AS passenger_count, l_partkey, l_suppkey
        FROM gaps WHERE trip_id IS NOT NULL AND dropoff_datetime IS NOT NULL""",
)
def slv_null_drop(spark, sf):
    rules = {"trip_id": "drop", "dropoff_datetime": "drop"}
    return _shown(cl.handle_nulls(_gappy_trips(spark, sf), rules))


@query(
    "slv_null_fill",
    f"""WITH {_GAPS} SELECT trip_id, {_SHOWN},
          CAST(coalesce(fare_amount, 0) AS DOUBLE) AS fare_amount,
          CAST(coalesce(passenger_count, 1) AS BIGINT) AS passenger_count, l_partkey, l_suppkey
        FROM gaps WHERE trip_id IS NOT NULL""",
)
def slv_null_fill(spark, sf):
    rules = {"trip_id": "drop", "fare_amount": 0, "passenger_count": 1}
    return _shown(cl.handle_nulls(_gappy_trips(spark, sf), rules))


@query(
    "slv_quality_flag",
    f"""WITH {_GAPS} SELECT trip_id, {_SHOWN}, l_partkey, l_suppkey,
          CASE WHEN trip_id IS NULL OR dropoff_datetime IS NULL THEN 'FAILED' ELSE 'PASSED' END
            AS data_quality_flag FROM gaps""",
)
def slv_quality_flag(spark, sf):
    flagged = cl.quality_flag(_gappy_trips(spark, sf), "trip_id", "dropoff_datetime")
    return _shown(flagged).drop("fare_amount", "passenger_count")


@query(
    "slv_metadata",
    """SELECT 'deduplication,null_handling' AS cleansing_applied, true AS stamped,
              count(*) AS row_count FROM orders""",
)
def slv_metadata(spark, sf):
    return (
        transform_metadata(star_table(spark, sf, "orders"))
        .groupBy("cleansing_applied")
        .agg(
            F.bool_and(F.col("silver_processed_timestamp").isNotNull()).alias("stamped"),
            F.count("*").alias("row_count"),
        )
    )


@query(
    "slv_validity",
    f"""WITH {_GAPS}, c AS (
          SELECT trip_id, l_partkey, l_suppkey, nullif(concat_ws(';',
            CASE WHEN NOT coalesce(fare_amount > 1000, false) THEN 'fare_low' END,
            CASE WHEN NOT coalesce(passenger_count BETWEEN 1 AND 4, false) THEN 'crowded' END),
            '') AS _validation_errors FROM gaps)
        SELECT *, _validation_errors IS NULL AS _is_valid FROM c""",
)
def slv_validity(spark, sf):
    rules = {"fare_low": "fare_amount > 1000", "crowded": "passenger_count BETWEEN 1 AND 4"}
    return cl.validity_columns(_gappy_trips(spark, sf), rules).select(
        "trip_id", "l_partkey", "l_suppkey", "_validation_errors", "_is_valid"
    )


_MISSING = (
    "(CASE WHEN trip_id IS NULL THEN 1 ELSE 0 END"
    " + CASE WHEN dropoff_datetime IS NULL THEN 1 ELSE 0 END"
    " + CASE WHEN fare_amount IS NULL THEN 1 ELSE 0 END"
    " + CASE WHEN passenger_count IS NULL THEN 1 ELSE 0 END)"
)


@query(
    "slv_completeness",
    f"""WITH {_GAPS} SELECT trip_id, l_partkey, l_suppkey,
          {big(_MISSING)} AS _null_column_count,
          1 - CAST({_MISSING} AS DOUBLE) / 6 AS _completeness_score FROM gaps""",
)
def slv_completeness(spark, sf):
    return cl.completeness(_gappy_trips(spark, sf)).select(
        "trip_id", "l_partkey", "l_suppkey", "_null_column_count", "_completeness_score"
    )


@query(
    "slv_temporal",
    """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS pickup_date, year(ts) AS "year",
              month(ts) AS "month", day(ts) AS "day", hour(ts) AS "hour" FROM events""",
)
def slv_temporal(spark, sf):
    return tp.temporal(star_table(spark, sf, "events"), "ts").select(
        "event_id", "pickup_date", "year", "month", "day", "hour"
    )


_IDS = ("trip_id", "l_partkey", "l_suppkey")
_IDS_SQL = ", ".join(_IDS)


@query(
    "slv_speed",
    f"""WITH {TRIPS} SELECT {_IDS_SQL}, CASE WHEN trip_duration_min > 0 THEN
          {r("trip_distance_mi / (trip_duration_min / CAST(60 AS DOUBLE))")} END AS speed_mph
        FROM trips""",
)
def slv_speed(spark, sf):
    df = trips(spark, sf, (*_IDS, "trip_distance_mi", "trip_duration_min"))
    return rounded(df.select(*_IDS, tp.speed_mph().alias("speed_mph")), "speed_mph")


@query(
    "slv_airport_flag",
    f"""WITH {TRIPS} SELECT {_IDS_SQL}, pickup_zone, dropoff_zone,
          CASE WHEN pickup_zone IN ('NATION_5', 'NATION_6')
                 OR dropoff_zone IN ('NATION_5', 'NATION_6') THEN 1 ELSE 0 END AS airport_trip
        FROM trips""",
)
def slv_airport_flag(spark, sf):
    df = trips(spark, sf, (*_IDS, "pickup_zone", "dropoff_zone"))
    return df.withColumn("airport_trip", tp.airport_trip(AIRPORTS))


@query(
    "slv_surge_proxy",
    f"""WITH {TRIPS} SELECT {_IDS_SQL}, CASE WHEN fare_amount > 0 THEN
          {r("CAST(total_amount - fare_amount AS DOUBLE) / CAST(fare_amount AS DOUBLE)", 6)}
          END AS surge_proxy FROM trips""",
)
def slv_surge_proxy(spark, sf):
    df = trips(spark, sf, (*_IDS, "fare_amount", "total_amount"))
    proxy = df.select(*_IDS, tp.surge_proxy().alias("surge_proxy"))
    return rounded(proxy, "surge_proxy", places=6)


@query(
    "slv_quality_filter",
    f"""WITH {TRIPS} SELECT {_IDS_SQL}, trip_distance_mi, trip_duration_min,
          CAST(fare_amount AS DOUBLE) AS fare_amount FROM trips
        WHERE trip_distance_mi > 0.2 AND trip_duration_min > 2.0 AND fare_amount > 3.0""",
)
def slv_quality_filter(spark, sf):
    columns = (*_IDS, "trip_distance_mi", "trip_duration_min", "fare_amount")
    return tp.quality_filter(trips(spark, sf, columns))


@query(
    "slv_join_pickup_zone",
    f"""WITH {TRIPS}, {LOOKUPS} SELECT {_IDS_SQL}, pickup_zone, borough AS pickup_borough
        FROM trips LEFT JOIN zones ON pickup_zone = zone""",
)
def slv_join_pickup_zone(spark, sf):
    df = trips(spark, sf, (*_IDS, "pickup_zone"))
    return en.add_pickup_borough(df, zones(spark, sf))


@query(
    "slv_join_dropoff_zone",
    f"""WITH {TRIPS}, {LOOKUPS} SELECT {_IDS_SQL}, dropoff_zone, borough AS dropoff_borough
        FROM trips LEFT JOIN zones ON dropoff_zone = zone""",
)
def slv_join_dropoff_zone(spark, sf):
    df = trips(spark, sf, (*_IDS, "dropoff_zone"))
    return en.add_dropoff_borough(df, zones(spark, sf))


@query(
    "slv_join_vendor",
    f"""WITH {TRIPS}, {LOOKUPS} SELECT {_IDS_SQL}, t.vendor, vendor_name
        FROM trips t LEFT JOIN vendors v ON t.vendor = v.vendor""",
)
def slv_join_vendor(spark, sf):
    df = trips(spark, sf, (*_IDS, "vendor"))
    return en.add_vendor_name(df, vendors(spark, sf))


@query(
    "slv_enriched_trips",
    f"""WITH {SILVER_TRIPS} SELECT trip_id, CAST(pickup_date AS VARCHAR) AS pickup_date,
          CAST(CAST(dropoff_datetime AS DATE) AS VARCHAR) AS dropoff_date,
          "year", "month", "day", "hour", pickup_zone, dropoff_zone,
          CAST(passenger_count AS BIGINT) AS passenger_count, trip_distance_mi,
          trip_duration_min, CAST(fare_amount AS DOUBLE) AS fare_amount,
          CAST(tip_amount AS DOUBLE) AS tip_amount, CAST(total_amount AS DOUBLE) AS total_amount,
          payment_type, vendor, {r("speed_mph")} AS speed_mph, airport_trip,
          {r("surge_proxy", 6)} AS surge_proxy, pickup_borough, dropoff_borough, vendor_name
        FROM silver""",
)
def slv_enriched_trips(spark, sf):
    df = silver_trips(spark, sf).withColumn("dropoff_date", F.to_date("dropoff_datetime"))
    df = df.drop("pickup_ts", "pickup_datetime", "dropoff_datetime")
    return rounded(rounded(df, "speed_mph"), "surge_proxy", places=6)


_DEDUP_COLUMNS = (
    "trip_id",
    "dropoff_datetime",
    "fare_amount",
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
)


def _dedup_sql(key: str) -> str:
    return f"""WITH keyed AS (
        SELECT {key} AS trip_id, l_shipdate AS dropoff_datetime,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS fare_amount, l_partkey, l_suppkey,
               l_quantity, l_extendedprice FROM lineitem),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY {DEDUP_ORDER}) AS n
                 FROM keyed)
      SELECT trip_id, {_SHOWN}, CAST(fare_amount AS DOUBLE) AS fare_amount, l_partkey, l_suppkey
      FROM ranked WHERE n = 1"""


def _deduplicated(df):
    kept = latest_per_key(df, ["trip_id"], "dropoff_datetime", DEDUP_TIEBREAK)
    return _shown(kept).drop("l_orderkey", "l_quantity", "l_extendedprice")


_TRIP_ID = "l_orderkey || '-' || l_linenumber"


@query("slv_dedup", _dedup_sql(_TRIP_ID))
def slv_dedup(spark, sf):
    return _deduplicated(trips(spark, sf, _DEDUP_COLUMNS))


@query(
    "slv_dedup_null_keys",
    _dedup_sql(f"CASE WHEN l_linenumber > 2 THEN {_TRIP_ID} END"),
)
def slv_dedup_null_keys(spark, sf):
    """A key that many rows lack: they are one group, and one of them stays."""
    df = trips(spark, sf, (*_DEDUP_COLUMNS, "l_linenumber"))
    keyed = F.when(F.col("l_linenumber") > 2, F.col("trip_id"))
    return _deduplicated(df.withColumn("trip_id", keyed).drop("l_linenumber"))


@query(
    "slv_text_layer",
    """WITH keyed AS (
        SELECT CASE WHEN l_orderkey % 97 = 0 THEN 'null'
                    WHEN l_orderkey % 89 = 0 THEN ''
                    ELSE l_orderkey || '-' || l_linenumber END AS trip_id,
               CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS dropoff_date,
               CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey,
               l_returnflag, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price
        FROM lineitem),
      kept AS (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY dropoff_date DESC,
                 l_partkey DESC, l_suppkey DESC, l_returnflag DESC, quantity DESC, price DESC)
                 AS n FROM keyed)
      SELECT CASE WHEN trip_id NOT IN ('', 'null', 'NULL') THEN trip_id END AS trip_id,
             dropoff_date, l_partkey, l_suppkey, l_returnflag, quantity, price,
             CASE WHEN trip_id IN ('', 'null', 'NULL') THEN 'FAILED' ELSE 'PASSED' END
               AS data_quality_flag,
             'deduplication,null_handling' AS cleansing_applied
      FROM kept WHERE n = 1""",
)
def slv_text_layer(spark, sf):
    """Raw text to cleansed text: duplicates first, then NULL spellings and the flag."""
    key = F.col("l_orderkey")
    raw = star_table(spark, sf, "lineitem").select(
        F.when(F.pmod(key, F.lit(97)) == 0, "null")
        .when(F.pmod(key, F.lit(89)) == 0, "")
        .otherwise(F.concat_ws("-", "l_orderkey", "l_linenumber"))
        .alias("trip_id"),
        F.to_date("l_shipdate").alias("dropoff_date"),
        "l_partkey",
        "l_suppkey",
        "l_returnflag",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    roles = ColumnRoles(keys=("trip_id",), dates=("dropoff_date",))
    silver = to_silver_text(cast_all_to_string(raw), roles, order_col="dropoff_date")
    return silver.drop("silver_processed_timestamp")
