"""The tables behind reports and dashboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.operators import cleansing as cl
from stratiform.operators import reporting as rp
from stratiform.operators import rollup as ru
from stratiform.operators.dedup import latest_per_key
from stratiform.plans.inputs import DEDUP_TIEBREAK, flagged_trips, zone_trips
from stratiform.plans.registry import (
    SILVER_TRIPS,
    TRIPS,
    big,
    dbl,
    mean_sql,
    query,
    r,
    rounded,
)
from stratiform.session import written
from stratiform.sources import star_table, trips

_DESTINATIONS = [f"NATION_{i}" for i in range(25)]

_OD = f"""SELECT pickup_zone, dropoff_zone, {mean_sql("fare_amount")} AS avg_fare
  FROM trips GROUP BY 1, 2"""


def _od_trips(spark, sf):
    return trips(spark, sf, ("pickup_zone", "dropoff_zone", "fare_amount"))


@query("rpt_od_avg_fare", f"WITH {TRIPS} {_OD}")
def rpt_od_avg_fare(spark, sf):
    return rp.od_avg_fare(_od_trips(spark, sf))


_CELLS = ", ".join(
    f"max(CASE WHEN dropoff_zone = '{z}' THEN avg_fare END) AS {z}" for z in _DESTINATIONS
)


@query("rpt_od_pivot", f"WITH {TRIPS}, od AS ({_OD}) SELECT pickup_zone, {_CELLS} FROM od GROUP BY 1")
def rpt_od_pivot(spark, sf):
    # The matrix has a column for each nation, of which there are a few.
    zones = [row.n_name for row in star_table(spark, sf, "nation").select("n_name").distinct().collect()]
    return rp.od_pivot(_od_trips(spark, sf), sorted(zones))


_MONTH_START = "CAST(CAST(date_trunc('month', pickup_date) AS DATE) AS VARCHAR) AS year_month"


@query(
    "rpt_trips_zone_month",
    f"WITH {SILVER_TRIPS} SELECT pickup_zone, {_MONTH_START}, count(*) AS trips "
    "FROM silver GROUP BY 1, 2",
)
def rpt_trips_zone_month(spark, sf):
    return rp.trips_by_zone_month(ru.zone_monthly(zone_trips(spark, sf)))


@query(
    "rpt_revenue_month",
    f"WITH {SILVER_TRIPS} SELECT {_MONTH_START}, {dbl('sum(total_amount)')} AS revenue "
    "FROM silver GROUP BY 1",
)
def rpt_revenue_month(spark, sf):
    return rp.revenue_by_month(ru.zone_monthly(zone_trips(spark, sf)))


@query(
    "rpt_trips_dow",
    f"WITH {TRIPS} SELECT isodow(pickup_datetime) - 1 AS dow, count(*) AS trips "
    "FROM trips GROUP BY 1",
)
def rpt_trips_dow(spark, sf):
    return rp.trips_by_dow(trips(spark, sf, ("pickup_datetime",)))


@query(
    "rpt_sample",
    f"WITH {TRIPS} SELECT isodow(pickup_datetime) - 1 AS dow, count(*) AS trips FROM trips "
    "WHERE ('0x' || substr(md5('7|' || trip_id), 1, 13))::BIGINT < round(0.05 * 4503599627370496) GROUP BY 1",
)
def rpt_sample(spark, sf):
    """Weekday counts over a Bernoulli sample."""
    sample = rp.bernoulli_sample(trips(spark, sf, ("trip_id", "pickup_datetime")), keys=["trip_id"])
    return rp.trips_by_dow(sample)


@query(
    "rpt_volume_trend",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS "date", count(*) AS record_count
       FROM events GROUP BY 1""",
)
def rpt_volume_trend(spark, sf):
    return rp.volume_trend(star_table(spark, sf, "events"), "ts")


_INGESTED = """SELECT strftime(ts, '%Y-%m-%d') AS "date", count(*) AS records_ingested
  FROM events GROUP BY 1"""


@query("rpt_ingest_volume", _INGESTED)
def rpt_ingest_volume(spark, sf):
    return rp.ingestion_volume(star_table(spark, sf, "events"), "ts")


@query(
    "rpt_ingest_volume_stats",
    f"""SELECT {big("sum(records_ingested)")} AS total_records, avg(records_ingested) AS avg_daily,
          max(records_ingested) AS max_daily, min(records_ingested) AS min_daily
        FROM ({_INGESTED})""",
)
def rpt_ingest_volume_stats(spark, sf):
    return rp.ingestion_volume_stats(rp.ingestion_volume(star_table(spark, sf, "events"), "ts"))


_MATCHED = """matched AS (
  SELECT o_orderkey, o_orderstatus, l_partkey, l_quantity,
         CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS l_returnflag,
         CASE WHEN l_linenumber < 7 THEN l_linenumber END AS l_linenumber,
         CASE WHEN l_orderkey % 97 <> 0 THEN l_shipdate END AS l_shipdate
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)"""


def _matched(spark, sf):
    """Orders with their lines: some orders have none, some values are missing."""
    orders, lines = star_table(spark, sf, "orders"), star_table(spark, sf, "lineitem")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(
        "o_orderkey",
        "o_orderstatus",
        "l_partkey",
        "l_quantity",
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).alias("l_linenumber"),
        F.when(F.pmod("l_orderkey", F.lit(97)) != 0, F.col("l_shipdate")).alias("l_shipdate"),
    )


_MATCHED_COLUMNS = (
    "o_orderkey",
    "o_orderstatus",
    "l_partkey",
    "l_quantity",
    "l_returnflag",
    "l_linenumber",
    "l_shipdate",
)


def null_rows_sql(columns, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total, "
        f"count(*) - count({c}) AS null_count FROM {source}"
        for c in columns
    )


@query(
    "rpt_null_profile",
    f"""WITH {_MATCHED}, n AS ({null_rows_sql(_MATCHED_COLUMNS, "matched")}),
          p AS (SELECT column_name, null_count, null_count * 100.0 / total AS null_pct FROM n)
        SELECT *, CASE WHEN null_pct < 5 THEN 'low' WHEN null_pct < 20 THEN 'medium'
                       ELSE 'high' END AS band FROM p""",
)
def rpt_null_profile(spark, sf):
    return rp.null_profile(_matched(spark, sf))


_LATEST = """latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
      l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS n
    FROM lineitem) WHERE n = 1)"""


def _layers(spark, sf, rules=None):
    """The layers, and how many columns the silver one has before it is cut to those used."""
    bronze = star_table(spark, sf, "lineitem")
    silver = latest_per_key(
        bronze, ["l_orderkey", "l_linenumber"], "l_shipdate", DEDUP_TIEBREAK
    )
    used = ["l_shipdate"]
    if rules:
        silver = cl.validity_columns(silver, rules)
        used.append("_is_valid")
    columns = len(silver.columns)
    silver = written(silver.select(*used), "silver")  # three layers read it
    by_day = silver.groupBy(F.to_date("l_shipdate").alias("agg_date"))
    by_month = silver.groupBy(
        F.year("l_shipdate").alias("agg_year"), F.month("l_shipdate").alias("agg_month")
    )
    layers = {
        "Bronze": bronze,
        "Silver": silver,
        "Gold (Daily)": by_day.agg(F.count("*").alias("record_count")),
        "Gold (Monthly)": by_month.agg(F.count("*").alias("record_count")),
    }
    return layers, columns


@query(
    "rpt_layer_counts",
    f"""WITH {_LATEST}
        SELECT 'Bronze' AS layer, count(*) AS record_count FROM lineitem
        UNION ALL SELECT 'Silver', count(*) FROM latest
        UNION ALL SELECT 'Gold (Daily)', count(DISTINCT CAST(l_shipdate AS DATE)) FROM latest
        UNION ALL SELECT 'Gold (Monthly)', count(DISTINCT date_trunc('month', l_shipdate))
          FROM latest
        UNION ALL SELECT 'Gold (Yearly)', 0""",
)
def rpt_layer_counts(spark, sf):
    layers, _ = _layers(spark, sf)
    return rp.layer_counts(spark, {**layers, "Gold (Yearly)": None})


_SCORED = f"""{_MATCHED}, scored AS (SELECT 1 - CAST(
    {" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in _MATCHED_COLUMNS)}
    AS DOUBLE) / 7 AS score FROM matched)"""


def _scored(spark, sf):
    return cl.completeness(_matched(spark, sf))


@query(
    "rpt_completeness",
    f"""WITH {_SCORED} SELECT {r("avg(score)", 8)} AS avg_completeness,
          min(score) AS min_completeness, max(score) AS max_completeness,
          count(*) FILTER (score >= 0.95) AS high_quality_records, count(*) AS total_records,
          count(*) FILTER (score >= 0.95) * 100.0 / count(*) AS high_quality_pct FROM scored""",
)
def rpt_completeness(spark, sf):
    return rounded(rp.completeness_stats(_scored(spark, sf)), "avg_completeness", places=8)


@query(
    "rpt_completeness_hist",
    f"""WITH {_SCORED}, b AS (SELECT min(score) AS lo, max(score) AS hi, avg(score) AS m FROM scored),
          placed AS (SELECT least(CAST(floor((score - lo) / (hi - lo) * CAST(20 AS DOUBLE))
                              AS BIGINT), 19) AS bin FROM scored, b),
          n AS (SELECT bin, count(*) AS frequency FROM placed GROUP BY 1)
        SELECT g.bin, {r("lo + g.bin * ((hi - lo) / CAST(20 AS DOUBLE))", 8)} AS bin_from,
               {r("lo + (g.bin + 1) * ((hi - lo) / CAST(20 AS DOUBLE))", 8)} AS bin_to,
               coalesce(frequency, 0) AS frequency, {r("m", 8)} AS mean_value
        FROM (SELECT unnest(range(20)) AS bin) g CROSS JOIN b LEFT JOIN n ON g.bin = n.bin""",
)
def rpt_completeness_hist(spark, sf):
    bins = rp.histogram(_scored(spark, sf), "_completeness_score")
    return rounded(bins, "bin_from", "bin_to", "mean_value", places=8)


_DAY = "CAST(CAST(pickup_datetime AS DATE) AS VARCHAR)"


@query(
    "rpt_metric_series",
    f"WITH {TRIPS} SELECT {_DAY} AS agg_date, {dbl('sum(fare_amount)')} AS fare_amount_sum "
    "FROM trips GROUP BY 1",
)
def rpt_metric_series(spark, sf):
    df = trips(spark, sf, ("pickup_datetime", "fare_amount"))
    return rp.metric_series(
        ru.daily(df, "pickup_datetime", ["fare_amount"]), "agg_date", "fare_amount_sum"
    )


@query(
    "rpt_month_label",
    f"WITH {TRIPS} SELECT strftime(pickup_datetime, '%Y-%m') AS month_label, "
    "count(*) AS record_count FROM trips GROUP BY 1",
)
def rpt_month_label(spark, sf):
    return rp.monthly_records(
        ru.monthly(trips(spark, sf, ("pickup_datetime",)), "pickup_datetime", [])
    )


def _judged(spark, sf):
    rules = {"big": "l_quantity > 5", "discounted": "l_discount <= 0.08"}
    return cl.validity_columns(star_table(spark, sf, "lineitem"), rules)


_VALID = "count(*) FILTER (l_quantity > 5 AND l_discount <= 0.08) * 100.0 / count(*)"


@query(
    "rpt_valid_pct",
    f"SELECT count(*) AS record_count, {_VALID} AS valid_pct FROM lineitem",
)
def rpt_valid_pct(spark, sf):
    return rp.valid_pct(_judged(spark, sf))


@query(
    "rpt_quality_rate",
    f"""WITH {TRIPS} SELECT count(*) FILTER (l_orderkey % 97 <> 0) AS passed_rows,
          count(*) FILTER (l_orderkey % 97 = 0) AS failed_rows,
          count(*) FILTER (l_orderkey % 97 <> 0) * 100.0 / count(*) AS passed_pct FROM trips""",
)
def rpt_quality_rate(spark, sf):
    return rp.quality_rate(flagged_trips(spark, sf))


@query(
    "rpt_dedup_summary",
    """WITH k AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber),
         c AS (SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after FROM k)
       SELECT *, rows_before - rows_after AS rows_removed,
              (rows_before - rows_after) * 100.0 / rows_before AS removed_pct FROM c""",
)
def rpt_dedup_summary(spark, sf):
    return rp.dedup_summary(star_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "rpt_dashboard",
    f"""WITH {_LATEST}
        SELECT 'Bronze' AS layer, count(*) AS record_count, 11 AS column_count,
               CAST(100 AS DOUBLE) AS valid_pct FROM lineitem
        UNION ALL SELECT 'Silver', count(*), 14, {_VALID} FROM latest
        UNION ALL SELECT 'Gold (Daily)', count(DISTINCT CAST(l_shipdate AS DATE)), 2, 100 FROM latest
        UNION ALL SELECT 'Gold (Monthly)', count(DISTINCT date_trunc('month', l_shipdate)), 3, 100
          FROM latest""",
)
def rpt_dashboard(spark, sf):
    layers, columns = _layers(spark, sf, {"big": "l_quantity > 5", "discounted": "l_discount <= 0.08"})
    return rp.dashboard(layers, {"Silver": columns})


@query(
    "rpt_table_stats",
    """SELECT 'orders' AS table_name, count(*) AS record_count, 6 AS column_count FROM orders
       UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem
       UNION ALL SELECT 'events', count(*), 6 FROM events
       UNION ALL SELECT 'documents', count(*), 5 FROM documents""",
)
def rpt_table_stats(spark, sf):
    names = ("orders", "lineitem", "events", "documents")
    return rp.table_stats({n: star_table(spark, sf, n) for n in names})


@query(
    "rpt_recent_days",
    f"""WITH {TRIPS} SELECT {_DAY} AS agg_date, count(*) AS record_count
        FROM trips GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
)
def rpt_recent_days(spark, sf):
    gold = ru.daily(trips(spark, sf, ("pickup_datetime",)), "pickup_datetime", [])
    return rp.most_recent(gold.select("agg_date", "record_count"), "agg_date", 10)
