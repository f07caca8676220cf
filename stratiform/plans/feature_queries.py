"""Calendar, demand and fare features."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.functions import demand as dm
from stratiform.plans.inputs import AIRPORTS
from stratiform.plans.registry import TRIPS, query, r, rounded
from stratiform.sources import star_table, trips


def _case(subject: str, values) -> str:
    arms = " ".join(f"WHEN {k} THEN CAST({v} AS DOUBLE)" for k, v in values.items())
    return f"CASE {subject} {arms} END"


_HOLIDAYS = ", ".join(f"DATE '{d}'" for d in dm.HOLIDAYS)


def _band(hour: str) -> str:
    return (
        f"CASE WHEN {hour} BETWEEN 7 AND 9 THEN CAST(1.15 AS DOUBLE) "
        f"WHEN {hour} BETWEEN 16 AND 19 THEN CAST(1.20 AS DOUBLE) "
        f"WHEN {hour} >= 22 OR {hour} <= 2 THEN CAST(1.10 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END"
    )


def _calendar(source: str, ts: str) -> str:
    return f"""calendar AS (
      SELECT *, coalesce(CAST({ts} AS DATE) IN ({_HOLIDAYS}), false) AS is_holiday,
             {_case(f"year({ts})", dm.YEAR_INDEX)} AS year_index,
             {_case(f"month({ts})", dm.MONTH_INDEX)} AS month_index,
             {_case(f"(isodow({ts}) - 1)", dm.WEEKDAY_INDEX)} AS dow_index FROM {source})"""


_EVENTS = _calendar("events", "ts")
_DEMAND = (
    "year_index * month_index * dow_index"
    " * CASE WHEN is_holiday THEN CAST(1.35 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END"
)
_SURGE = (
    "(CAST(1 AS DOUBLE) + greatest(CAST(0 AS DOUBLE), "
    "(year_index * month_index * {band} - CAST(1 AS DOUBLE)) * CAST(0.6 AS DOUBLE)))"
)


@query("feat_time_band", f"SELECT event_id, {_band('hour(ts)')} AS time_band FROM events")
def feat_time_band(spark, sf):
    return star_table(spark, sf, "events").select(
        "event_id", dm.time_band(F.hour("ts")).alias("time_band")
    )


@query(
    "feat_calendar",
    f"WITH {_EVENTS} SELECT event_id, is_holiday, year_index, month_index, dow_index FROM calendar",
)
def feat_calendar(spark, sf):
    return dm.calendar_features(star_table(spark, sf, "events"), "ts").select(
        "event_id", "is_holiday", "year_index", "month_index", "dow_index"
    )


@query(
    "feat_demand_index",
    f"WITH {_EVENTS} SELECT event_id, {r(_DEMAND, 6)} AS demand_index FROM calendar",
)
def feat_demand_index(spark, sf):
    df = dm.calendar_features(star_table(spark, sf, "events"), "ts")
    return rounded(
        df.select("event_id", dm.demand_index().alias("demand_index")), "demand_index", places=6
    )


@query(
    "feat_surge",
    f"WITH {_EVENTS} SELECT event_id, {r(_SURGE.format(band=_band('hour(ts)')), 6)} AS surge "
    "FROM calendar",
)
def feat_surge(spark, sf):
    df = dm.calendar_features(star_table(spark, sf, "events"), "ts")
    return rounded(df.select("event_id", dm.surge(F.hour("ts")).alias("surge")), "surge", places=6)


# Order dates lie before the calendar's years and have no time of day, so both are
# derived: years are mapped onto 2021 to 2025, the hour comes from the order key.
_CLOCKED = f"""{TRIPS}, clocked AS (
  SELECT *, make_timestamp(2021 + year(pickup_datetime) % 5, month(pickup_datetime),
              least(day(pickup_datetime), 28), l_orderkey % 24, 0, 0) AS pickup_at
  FROM trips), {_calendar("clocked", "pickup_at")}"""

_FEATURE_COLUMNS = (
    "trip_id",
    "pickup_datetime",
    "pickup_zone",
    "dropoff_zone",
    "trip_distance_mi",
    "trip_duration_min",
    "fare_amount",
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
)


def _clocked(spark, sf):
    at = F.col("pickup_datetime")
    df = trips(spark, sf, _FEATURE_COLUMNS).withColumn(
        "pickup_at",
        F.make_timestamp_ntz(
            F.year(at) % 5 + 2021,
            F.month(at),
            F.least(F.dayofmonth(at), F.lit(28)),
            (F.col("l_orderkey") % 24).cast("int"),
            F.lit(0),
            F.lit(0),
        ),
    )
    return dm.calendar_features(df, "pickup_at")


def _estimate(night: bool) -> str:
    h = "hour(pickup_at)"
    zero = "CAST(0 AS DOUBLE)"
    airport = (
        "CASE WHEN pickup_zone IN ('NATION_5', 'NATION_6') OR dropoff_zone IN "
        f"('NATION_5', 'NATION_6') THEN CAST(1.75 AS DOUBLE) ELSE {zero} END"
    )
    late = f"CASE WHEN {h} >= 20 OR {h} <= 6 THEN CAST(0.5 AS DOUBLE) ELSE {zero} END"
    peak = f"CASE WHEN {h} BETWEEN 16 AND 19 THEN CAST(0.7 AS DOUBLE) ELSE {zero} END"
    extra = " + ".join([airport, late, peak] if night else [airport, peak])
    return (
        "(CAST(2.75 AS DOUBLE) + CAST(2.5 AS DOUBLE) * trip_distance_mi "
        f"+ CAST(0.6 AS DOUBLE) * trip_duration_min + ({extra})) * {_SURGE.format(band=_band(h))}"
    )


_KEYS = ("trip_id", "l_partkey", "l_suppkey")


@query(
    "feat_fare_estimate",
    f"""WITH {_CLOCKED} SELECT trip_id, l_partkey, l_suppkey,
          {r(_estimate(False))} AS fare_estimate, {r(_estimate(True))} AS fare_estimate_night
        FROM calendar""",
)
def feat_fare_estimate(spark, sf):
    hour = F.hour("pickup_at")
    df = _clocked(spark, sf).select(
        *_KEYS,
        dm.fare_estimate(hour, airports=AIRPORTS).alias("fare_estimate"),
        dm.fare_estimate(hour, airports=AIRPORTS, night=True).alias("fare_estimate_night"),
    )
    return rounded(df, "fare_estimate", "fare_estimate_night")


_PAIRS = (("NATION_0", "NATION_0", 2.1), ("NATION_0", "NATION_1", 5.5), ("NATION_5", "NATION_2", 11.0))


@query(
    "feat_pair_distance",
    f"""WITH {TRIPS}, pairs AS (SELECT * FROM (VALUES
          {", ".join(f"('{a}', '{b}', CAST({m} AS DOUBLE))" for a, b, m in _PAIRS)}) AS p(f, t, miles))
        SELECT trip_id, l_partkey, l_suppkey, coalesce(miles, 3.5) AS expected_miles
        FROM trips LEFT JOIN pairs ON pickup_zone = f AND dropoff_zone = t""",
)
def feat_pair_distance(spark, sf):
    df = trips(spark, sf, (*_KEYS, "pickup_zone", "dropoff_zone"))
    return dm.expected_distance(df, dm.pair_distances(spark, _PAIRS)).drop(
        "pickup_zone", "dropoff_zone"
    )


@query(
    "feat_fare_residual",
    f"""WITH {_CLOCKED} SELECT pickup_zone, count(*) AS trips,
          {r(f"avg(CAST(fare_amount AS DOUBLE) - {_estimate(False)})")} AS avg_residual
        FROM calendar GROUP BY 1""",
)
def feat_fare_residual(spark, sf):
    residual = dm.fare_residual(F.hour("pickup_at"), airports=AIRPORTS)
    df = (
        _clocked(spark, sf)
        .groupBy("pickup_zone")
        .agg(F.count("*").alias("trips"), F.avg(residual).alias("avg_residual"))
    )
    return rounded(df, "avg_residual")
