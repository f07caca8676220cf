"""Aggregates by time, zone and dimension."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.config import DAILY_TYPES, MONTHLY_TYPES, PASSENGER_TYPES
from stratiform.functions.casts import cast_all_to_string, cast_by_mapping
from stratiform.operators import rollup as ru
from stratiform.operators.cleansing import passed_only
from stratiform.operators.dimension import dimension, surrogate_key
from stratiform.plans.inputs import flagged_trips, zone_trips
from stratiform.plans.registry import SILVER_TRIPS, TRIPS, dbl, mean_sql, query, r, rounded
from stratiform.sources import star_table, trips


def _statistics_sql(*metrics: str) -> str:
    parts = []
    for m in metrics:
        parts += [
            f"{dbl(f'sum({m})')} AS {m}_sum",
            f"{mean_sql(m)} AS {m}_avg",
            f"{dbl(f'min({m})')} AS {m}_min",
            f"{dbl(f'max({m})')} AS {m}_max",
            f"count({m}) AS {m}_count",
        ]
    return ", ".join([*parts, "count(*) AS record_count"])


_DAY = "CAST(CAST(pickup_datetime AS DATE) AS VARCHAR)"
_YEAR = "CAST(year(pickup_datetime) AS BIGINT)"
_MONTH = "CAST(month(pickup_datetime) AS BIGINT)"
_METRICS = ("fare_amount", "tip_amount", "trip_distance_mi")
_STATS = _statistics_sql(*_METRICS)
_COLUMNS = ("pickup_datetime", "payment_type", *_METRICS)


@query(
    "gld_daily",
    f"WITH {TRIPS} SELECT {_DAY} AS agg_date, {_STATS}, 'daily' AS aggregation_level "
    "FROM trips GROUP BY 1",
)
def gld_daily(spark, sf):
    return ru.daily(trips(spark, sf, _COLUMNS), "pickup_datetime", _METRICS)


@query(
    "gld_daily_dims",
    f"WITH {TRIPS} SELECT {_DAY} AS agg_date, payment_type, {_STATS}, "
    "'daily' AS aggregation_level FROM trips GROUP BY 1, 2",
)
def gld_daily_dims(spark, sf):
    return ru.daily(trips(spark, sf, _COLUMNS), "pickup_datetime", _METRICS, ["payment_type"])


@query(
    "gld_monthly",
    f"WITH {TRIPS} SELECT {_YEAR} AS agg_year, {_MONTH} AS agg_month, {_STATS}, "
    "'monthly' AS aggregation_level FROM trips GROUP BY 1, 2",
)
def gld_monthly(spark, sf):
    return ru.monthly(trips(spark, sf, _COLUMNS), "pickup_datetime", _METRICS)


@query(
    "gld_monthly_dims",
    f"WITH {TRIPS} SELECT {_YEAR} AS agg_year, {_MONTH} AS agg_month, payment_type, vendor, "
    f"{_STATS}, 'monthly' AS aggregation_level FROM trips GROUP BY 1, 2, 3, 4",
)
def gld_monthly_dims(spark, sf):
    df = trips(spark, sf, (*_COLUMNS, "vendor"))
    return ru.monthly(df, "pickup_datetime", _METRICS, ["payment_type", "vendor"])


@query(
    "gld_yearly",
    f"WITH {TRIPS} SELECT {_YEAR} AS agg_year, {_STATS}, 'yearly' AS aggregation_level "
    "FROM trips GROUP BY 1",
)
def gld_yearly(spark, sf):
    return ru.time_rollup(
        trips(spark, sf, _COLUMNS), "pickup_datetime", _METRICS, grain="yearly"
    )


_PASSED = f"""{TRIPS}, passed AS (
  SELECT *, trip_distance_mi AS trip_distance FROM trips
  WHERE l_orderkey % 97 <> 0 AND pickup_datetime IS NOT NULL)"""

_MONEY = f"""count(*) AS total_trips,
  {dbl("sum(fare_amount)")} AS total_fare, {mean_sql("fare_amount")} AS avg_fare,
  {dbl("sum(tip_amount)")} AS total_tips, {mean_sql("tip_amount")} AS avg_tip,
  {dbl("sum(total_amount)")} AS total_revenue, {mean_sql("total_amount")} AS avg_revenue,
  {dbl("sum(trip_distance)")} AS total_distance, {mean_sql("trip_distance")} AS avg_distance,
  {mean_sql("passenger_count")} AS avg_passengers"""

_DAILY_METRICS = f"""WITH {_PASSED}
  SELECT {_DAY} AS trip_date, {_MONEY},
         {dbl("min(fare_amount)")} AS min_fare, {dbl("max(fare_amount)")} AS max_fare
  FROM passed GROUP BY 1"""

_MONTHLY_METRICS = f"""WITH {_PASSED}
  SELECT strftime(pickup_datetime, '%Y-%m') AS year_month, {_MONEY},
         count(DISTINCT CAST(pickup_datetime AS DATE)) AS active_days
  FROM passed GROUP BY 1"""

_PASSENGER_METRICS = f"""WITH {_PASSED}
  SELECT CAST(passenger_count AS BIGINT) AS passenger_count, count(*) AS total_trips,
         {dbl("sum(fare_amount)")} AS total_fare, {mean_sql("fare_amount")} AS avg_fare,
         {dbl("sum(total_amount)")} AS total_revenue,
         {mean_sql("trip_distance")} AS avg_distance
  FROM passed GROUP BY 1"""


@query("gld_daily_metrics", _DAILY_METRICS)
def gld_daily_metrics(spark, sf):
    return ru.daily_metrics(passed_only(flagged_trips(spark, sf)))


@query("gld_monthly_metrics", _MONTHLY_METRICS)
def gld_monthly_metrics(spark, sf):
    return ru.monthly_metrics(passed_only(flagged_trips(spark, sf)))


@query("gld_passenger_metrics", _PASSENGER_METRICS)
def gld_passenger_metrics(spark, sf):
    return ru.passenger_metrics(passed_only(flagged_trips(spark, sf)))


def _typed_sql(inner: str, types, derived_year: str) -> str:
    columns = []
    for name, kind in types.items():
        if name == "aggregation_timestamp":
            continue
        if name == "year":
            columns.append(f"{derived_year} AS year")
        elif kind.startswith("decimal"):
            columns.append(f"{dbl(f'CAST(CAST({name} AS VARCHAR) AS {kind})')} AS {name}")
        else:
            columns.append(name)
    return f"SELECT {', '.join(columns)} FROM ({inner})"


def _typed(df, types, year="2023"):
    """Cast a metric table that arrived as text, the way raw layers hold it."""
    return cast_by_mapping(cast_all_to_string(df.withColumn("year", F.lit(year))), types)


_TWENTY_23 = "CAST(2023 AS BIGINT)"


@query("gld_typed_daily", _typed_sql(_DAILY_METRICS, DAILY_TYPES, _TWENTY_23))
def gld_typed_daily(spark, sf):
    return _typed(gld_daily_metrics(spark, sf), DAILY_TYPES)


@query("gld_typed_monthly", _typed_sql(_MONTHLY_METRICS, MONTHLY_TYPES, _TWENTY_23))
def gld_typed_monthly(spark, sf):
    return _typed(gld_monthly_metrics(spark, sf), MONTHLY_TYPES)


@query("gld_typed_passenger", _typed_sql(_PASSENGER_METRICS, PASSENGER_TYPES, _TWENTY_23))
def gld_typed_passenger(spark, sf):
    return _typed(gld_passenger_metrics(spark, sf), PASSENGER_TYPES)


@query(
    "gld_text_minmax",
    """SELECT l_returnflag, max(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)) AS text_max,
              CAST(max(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS number_max
       FROM lineitem GROUP BY 1""",
)
def gld_text_minmax(spark, sf):
    """Why metric tables need typed input: text has a different maximum."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    text = star_table(spark, sf, "lineitem").select(
        "l_returnflag", price.cast("string").alias("price")
    )
    typed = F.col("price").try_cast("decimal(18,2)")
    return text.groupBy("l_returnflag").agg(
        F.max("price").alias("text_max"), F.max(typed).alias("number_max")
    )


_ZONE_KPIS = f"""count(*) AS trips, {dbl("sum(total_amount)")} AS revenue,
  {r(mean_sql("fare_amount"))} AS avg_fare,
  {r(f"{dbl('sum(tip_amount)')} / nullif({dbl('sum(fare_amount)')}, 0)")} AS tip_pct,
  {r("avg(speed_mph)")} AS avg_speed_mph,
  {r("avg(CAST(airport_trip AS DOUBLE))")} AS airport_share"""

_ROUNDED = ("avg_fare", "tip_pct", "avg_speed_mph", "airport_share")


def rounded_kpis(df):
    return rounded(df, *_ROUNDED)


@query(
    "gld_zone_daily",
    f"WITH {SILVER_TRIPS} SELECT CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_zone, "
    f"{_ZONE_KPIS} FROM silver GROUP BY 1, 2",
)
def gld_zone_daily(spark, sf):
    return rounded_kpis(ru.zone_daily(zone_trips(spark, sf)))


@query(
    "gld_zone_monthly",
    f'WITH {SILVER_TRIPS} SELECT "year", "month", pickup_zone, {_ZONE_KPIS} '
    "FROM silver GROUP BY 1, 2, 3",
)
def gld_zone_monthly(spark, sf):
    return rounded_kpis(ru.zone_monthly(zone_trips(spark, sf)))


_KPIS = {
    "tip_share": "cast(tip_amount_sum as double) / cast(fare_amount_sum as double)",
    "fare_per_mile": "cast(fare_amount_sum as double) / trip_distance_mi_sum",
    "tip_per_mile": "tip_share * fare_per_mile",
}


@query(
    "gld_kpi_columns",
    f"""WITH {TRIPS}, m AS (
          SELECT {_YEAR} AS agg_year, {_MONTH} AS agg_month,
                 {dbl("sum(tip_amount)")} / {dbl("sum(fare_amount)")} AS tip_share,
                 {dbl("sum(fare_amount)")} / {dbl("sum(trip_distance_mi)")} AS fare_per_mile
          FROM trips GROUP BY 1, 2)
        SELECT agg_year, agg_month, {r("tip_share", 6)} AS tip_share,
               {r("fare_per_mile", 6)} AS fare_per_mile,
               {r("tip_share * fare_per_mile", 6)} AS tip_per_mile FROM m""",
)
def gld_kpi_columns(spark, sf):
    kpis = ru.add_kpis(gld_monthly(spark, sf), _KPIS)
    return rounded(kpis.select("agg_year", "agg_month", *_KPIS), *_KPIS, places=6)


@query(
    "gld_kpi_variance",
    f"""WITH {TRIPS}, d AS (
          SELECT {_DAY} AS kpi_date, {mean_sql("fare_amount")} AS kpi_value,
                 CAST(35000 AS DOUBLE) AS kpi_target FROM trips GROUP BY 1)
        SELECT kpi_date, {r("kpi_value")} AS kpi_value, kpi_target,
               {r("kpi_value - kpi_target")} AS variance,
               {r("(kpi_value - kpi_target) * 100.0 / kpi_target")} AS variance_pct FROM d""",
)
def gld_kpi_variance(spark, sf):
    daily = ru.daily(
        trips(spark, sf, ("pickup_datetime", "fare_amount")), "pickup_datetime", ["fare_amount"]
    ).select(
        F.col("agg_date").alias("kpi_date"),
        F.col("fare_amount_avg").alias("kpi_value"),
        F.lit(35000.0).alias("kpi_target"),
    )
    return rounded(ru.kpi_variance(daily), "kpi_value", "variance", "variance_pct")


_DIMS = ("payment_type", "vendor")
_NUMBERED = "payment_type NULLS FIRST, vendor NULLS FIRST"
_KEYED = f"""WITH {TRIPS}, d AS (
    SELECT CASE WHEN payment_type <> '5-LOW' THEN payment_type END AS payment_type, vendor,
           count(*) AS record_count FROM trips GROUP BY 1, 2)
  SELECT *, row_number() OVER (ORDER BY {_NUMBERED}) AS dimension_key FROM d"""


@query(
    "gld_dimension",
    f"WITH {TRIPS} SELECT payment_type, vendor, count(*) AS record_count "
    "FROM trips GROUP BY 1, 2",
)
def gld_dimension(spark, sf):
    return dimension(trips(spark, sf, _DIMS), _DIMS)


@query("gld_dimension_nocount", f"WITH {TRIPS} SELECT DISTINCT payment_type, vendor FROM trips")
def gld_dimension_nocount(spark, sf):
    return dimension(trips(spark, sf, _DIMS), _DIMS, include_counts=False)


def _gappy_dimension(spark, sf):
    gappy = trips(spark, sf, _DIMS).withColumn(
        "payment_type", F.when(F.col("payment_type") != "5-LOW", F.col("payment_type"))
    )
    return dimension(gappy, _DIMS)


@query("gld_dimension_key", _KEYED)
def gld_dimension_key(spark, sf):
    return surrogate_key(_gappy_dimension(spark, sf), _DIMS)


@query(
    "gld_dimension_key_ranged",
    """SELECT l_partkey, l_suppkey, count(*) AS record_count,
              row_number() OVER (ORDER BY l_partkey, l_suppkey) AS dimension_key
       FROM lineitem GROUP BY 1, 2""",
)
def gld_dimension_key_ranged(spark, sf):
    """The same numbering without a single sorting task."""
    keys = ("l_partkey", "l_suppkey")
    return surrogate_key(dimension(trips(spark, sf, keys), keys), keys)
