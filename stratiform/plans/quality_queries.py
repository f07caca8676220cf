"""Data-quality checks over the trip view and the star tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from stratiform.operators import quality as q
from stratiform.operators import rollup as ru
from stratiform.operators.dedup import latest_per_key
from stratiform.plans.inputs import DEDUP_TIEBREAK, flagged_trips
from stratiform.plans.registry import query
from stratiform.plans.report_queries import (
    _LATEST,
    _MATCHED,
    _matched,
    null_rows_sql,
)
from stratiform.sinks import append_results
from stratiform.session import reliable_checkpoint, scratch_path
from stratiform.sources import star_table, trips

# A fixed "now" that lies shortly after the newest event.
NOW = datetime(2024, 1, 31, 6, 0, 0)

_LINE_KEYS = ["l_orderkey", "l_linenumber"]


def flat(df, *details: str):
    """Results with lists as text, chosen details as columns, and no clock."""
    return df.select(
        "check_type",
        "table_name",
        "target",
        F.array_join("columns", ",").alias("columns"),
        F.round(F.col("metric") + F.lit(1e-9), 6).alias("metric"),
        "threshold",
        "passed",
        *[F.col("details").getItem(d).alias(d) for d in details],
    )


def _flat_sql(kind, table, target, columns, metric, threshold, passed, **details) -> str:
    target = "CAST(NULL AS VARCHAR)" if target is None else f"'{target}'"
    extra = "".join(f", CAST({v} AS VARCHAR) AS {k}" for k, v in details.items())
    return (
        f"'{kind}' AS check_type, '{table}' AS table_name, {target} AS target, "
        f"{columns} AS columns, round({metric} + 1e-9, 6) AS metric, "
        f"CAST({threshold} AS DOUBLE) AS threshold, {passed} AS passed{extra}"
    )


def _bronze_silver(spark, sf):
    bronze = star_table(spark, sf, "lineitem")
    return bronze, latest_per_key(bronze, _LINE_KEYS, "l_shipdate", DEDUP_TIEBREAK)


_COUNTS = f"""{_LATEST}, c AS (
  SELECT (SELECT count(*) FROM lineitem) AS s, (SELECT count(*) FROM latest) AS t)"""


@query(
    "dq_row_counts",
    f"""WITH {_COUNTS} SELECT {
        _flat_sql("row_count", "bronze", "silver", "''", "abs(s - t) * 100.0 / s", 5,
                  "abs(s - t) * 100.0 / s <= 5",
                  source_count="s", target_count="t", variance="abs(s - t)")
    } FROM c""",
)
def dq_row_counts(spark, sf):
    result = q.row_counts(*_bronze_silver(spark, sf), 5.0, ("bronze", "silver"))
    return flat(result, "source_count", "target_count", "variance")


@query(
    "dq_schema",
    """WITH types AS (
         SELECT * FROM (VALUES ('VARCHAR', 'string'), ('BIGINT', 'bigint'), ('INTEGER', 'int'),
           ('DOUBLE', 'double'), ('TIMESTAMP', 'timestamp_ntz')) AS v(duck, spark)),
       a AS (SELECT substr(column_name, 3) AS "column", spark AS left_type
             FROM (DESCRIBE customer) JOIN types ON column_type = duck),
       b AS (SELECT substr(column_name, 3) AS "column", spark AS right_type
             FROM (DESCRIBE supplier) JOIN types ON column_type = duck),
       c AS (SELECT "column", left_type,
                    CASE WHEN "column" = 'nationkey' THEN 'bigint' ELSE right_type END AS right_type
             FROM a FULL JOIN b USING ("column"))
       SELECT *, CASE WHEN right_type IS NULL THEN 'only_left'
                      WHEN left_type IS NULL THEN 'only_right' ELSE 'type_mismatch' END AS status
       FROM c WHERE left_type IS DISTINCT FROM right_type""",
)
def dq_schema(spark, sf):
    """Schema drift between two tables whose column prefixes are taken off."""

    def stripped(name: str):
        df = star_table(spark, sf, name)
        return df.toDF(*[c[2:] for c in df.columns])

    drifted = stripped("supplier").withColumn("nationkey", F.col("nationkey").cast("bigint"))
    return q.schema_diff(stripped("customer"), drifted)


@query(
    "dq_schema_consistency",
    """SELECT 'schema_consistency' AS check_type, 'bronze' AS table_name, 'silver' AS target,
              '_extra,l_linenumber,l_tax' AS columns, CAST(3 AS DOUBLE) AS metric,
              CAST(0 AS DOUBLE) AS threshold, false AS passed, 'l_tax' AS only_left,
              '_extra' AS only_right, 'l_linenumber' AS type_mismatch""",
)
def dq_schema_consistency(spark, sf):
    bronze = star_table(spark, sf, "lineitem")
    silver = bronze.drop("l_tax").withColumns(
        {
            "_extra": F.lit(1),
            "_is_valid": F.lit(True),
            "l_linenumber": F.col("l_linenumber").cast("bigint"),
        }
    )
    result = q.schema_consistency(bronze, silver, ["_is_valid"], ("bronze", "silver"))
    return flat(result, "only_left", "only_right", "type_mismatch")


_LIMITS = {"o_orderkey": 0.0, "l_partkey": 1.0, "l_returnflag": 40.0, "l_shipdate": 2.0}
_LIMIT_ROWS = ", ".join(f"('{c}', CAST({v} AS DOUBLE))" for c, v in _LIMITS.items())


@query(
    "dq_null_pct",
    f"""WITH {_MATCHED}, n AS ({null_rows_sql(_LIMITS, "matched")}),
          l AS (SELECT * FROM (VALUES {_LIMIT_ROWS}) AS v(column_name, lim))
        SELECT {
        _flat_sql("null_percentage", "silver", None, "column_name", "null_count * 100.0 / total",
                  "lim", "null_count * 100.0 / total <= lim",
                  null_count="null_count", total_rows="total")
    } FROM n JOIN l USING (column_name)""",
)
def dq_null_pct(spark, sf):
    return flat(q.null_pct(_matched(spark, sf), _LIMITS, "silver"), "null_count", "total_rows")


@query(
    "dq_no_nulls",
    f"""WITH {_MATCHED}, n AS ({null_rows_sql(("o_orderkey", "l_partkey"), "matched")})
        SELECT {
        _flat_sql("no_nulls", "silver", None, "column_name", "null_count * 100.0 / total", 0,
                  "null_count = 0", null_count="null_count")
    } FROM n
        UNION ALL SELECT 'no_nulls', 'silver', NULL, 'absent', NULL, 0, false, NULL""",
)
def dq_no_nulls(spark, sf):
    columns = ["o_orderkey", "l_partkey", "absent"]
    return flat(q.no_nulls(_matched(spark, sf), columns, "silver"), "null_count")


@query(
    "dq_duplicates",
    f"""WITH k AS (SELECT CASE WHEN l_linenumber > 2 THEN l_orderkey END AS a, l_linenumber,
                     count(*) AS n FROM lineitem GROUP BY 1, 2),
          c AS (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS d FROM k)
        SELECT {
        _flat_sql("duplicates", "bronze", None, "'l_orderkey,l_linenumber'",
                  "(total - d) * 100.0 / total", 0, "total = d",
                  total_rows="total", distinct_rows="d", duplicate_count="total - d")
    } FROM c""",
)
def dq_duplicates(spark, sf):
    key = F.when(F.col("l_linenumber") > 2, F.col("l_orderkey"))
    lines = star_table(spark, sf, "lineitem").withColumn("l_orderkey", key)
    result = q.duplicates(lines, _LINE_KEYS, 0.0, "bronze")
    return flat(result, "total_rows", "distinct_rows", "duplicate_count")


@query(
    "dq_freshness",
    f"""WITH m AS (SELECT date_diff('microsecond', max(ts), TIMESTAMP '2024-01-31 06:00:00')
                     / CAST(3600000000 AS DOUBLE) AS age FROM events)
        SELECT {
        _flat_sql("data_freshness", "events", None, "'ts'", "age", 24, "age >= 0 AND age <= 24")
    } FROM m""",
)
def dq_freshness(spark, sf):
    return flat(q.freshness(star_table(spark, sf, "events"), "ts", 24, NOW, "events"))


@query(
    "dq_min_rows",
    f"""SELECT {
        _flat_sql("min_rows", "orders", None, "''", "count(*)", 100,
                  "count(*) >= 100")
    } FROM orders""",
)
def dq_min_rows(spark, sf):
    return flat(q.min_rows(star_table(spark, sf, "orders"), 100, "orders"))


_FLAGGED = "SELECT count(*) AS n, count(*) FILTER (l_orderkey % 97 <> 0) AS ok FROM lineitem"


@query(
    "dq_flag_rate",
    f"""SELECT {
        _flat_sql("quality_flag_rate", "silver", None, "'data_quality_flag'", "ok * 100.0 / n",
                  95, "ok * 100.0 / n >= 95", passed_rows="ok", failed_rows="n - ok")
    } FROM ({_FLAGGED})""",
)
def dq_flag_rate(spark, sf):
    result = q.quality_flag_rate(flagged_trips(spark, sf), name="silver")
    return flat(result, "passed", "failed").toDF(
        "check_type", "table_name", "target", "columns", "metric", "threshold", "passed",
        "passed_rows", "failed_rows",
    )


@query(
    "dq_retention",
    f"""WITH {_COUNTS} SELECT {
        _flat_sql("retention", "bronze", "silver", "''", "t * 100.0 / s", 70,
                  "t * 100.0 / s >= 70",
                  band="CASE WHEN t * 100.0 / s >= 90 THEN 'Good' "
                       "WHEN t * 100.0 / s >= 70 THEN 'Moderate' ELSE 'Low' END",
                  source_count="s", target_count="t")
    } FROM c""",
)
def dq_retention(spark, sf):
    result = q.retention(*_bronze_silver(spark, sf))
    return flat(result, "band", "source_count", "target_count")


@query(
    "dq_gold_presence",
    """SELECT 'min_rows' AS check_type, 'daily_metrics' AS table_name, CAST(NULL AS VARCHAR) AS target,
              '' AS columns, CAST(count(DISTINCT CAST(o_orderdate AS DATE)) AS DOUBLE) AS metric,
              CAST(1 AS DOUBLE) AS threshold, count(*) > 0 AS passed, NULL AS error
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       UNION ALL SELECT 'min_rows', 'monthly_metrics', NULL, '', count(DISTINCT date_trunc('month', o_orderdate)), 1,
              count(*) > 0, NULL FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       UNION ALL SELECT 'min_rows', 'passenger_metrics', NULL, '', NULL, 1, false,
              'table not found'""",
)
def dq_gold_presence(spark, sf):
    df = trips(spark, sf, ("pickup_datetime", "fare_amount"))
    tables = {
        "daily_metrics": ru.daily(df, "pickup_datetime", ["fare_amount"]),
        "monthly_metrics": ru.monthly(df, "pickup_datetime", ["fare_amount"]),
        "passenger_metrics": None,
    }
    return flat(q.gold_presence(spark, tables), "error")


def _suite(spark, sf):
    bronze, silver = _bronze_silver(spark, sf)
    return q.suite(
        bronze,
        silver,
        _LINE_KEYS,
        {"l_orderkey": 0.0, "l_extendedprice": 5.0},
        ts_col="l_shipdate",
        max_age_hours=24 * 365,
        now=datetime(2001, 12, 31),
    )


_SUITE_SQL = f"""WITH {_COUNTS}, m AS (
          SELECT date_diff('microsecond', max(l_shipdate), TIMESTAMP '2001-12-31 00:00:00')
                 / CAST(3600000000 AS DOUBLE) AS age FROM lineitem)
        SELECT {
        _flat_sql("row_count", "bronze", "silver", "''", "abs(s - t) * 100.0 / s", 5,
                  "abs(s - t) * 100.0 / s <= 5")
    } FROM c
        UNION ALL SELECT 'schema_consistency', 'bronze', 'silver', '', 0, 0, true
        UNION ALL SELECT 'null_percentage', 'silver', NULL, 'l_orderkey', 0, 0, true
        UNION ALL SELECT 'null_percentage', 'silver', NULL, 'l_extendedprice', 0, 5, true
        UNION ALL SELECT 'duplicates', 'silver', NULL, 'l_orderkey,l_linenumber', 0, 0, true
        UNION ALL SELECT 'data_freshness', 'bronze', NULL, 'l_shipdate', round(age + 1e-9, 6),
                         8760, age >= 0 AND age <= 8760 FROM m"""


@query("dq_suite", _SUITE_SQL)
def dq_suite(spark, sf):
    return flat(_suite(spark, sf))


@query("dq_history", f"SELECT s.* FROM ({_SUITE_SQL}) s, (VALUES (1), (2)) AS runs(n)")
def dq_history(spark, sf):
    """Two runs kept in a table, and the latest results read back."""
    path = scratch_path(spark, "dq-history")
    results = reliable_checkpoint(_suite(spark, sf))
    table = "stratiform_dq_" + path.rsplit("-", 1)[-1]
    append_results(results, table, path)
    append_results(results, table)
    latest = q.recent_results(spark.read.schema(results.schema).parquet(path))
    spark.sql(f"DROP TABLE {table}")
    return flat(latest)
