"""Whole layers as they are run on a dataset, from files and a configuration to metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.config import ColumnRoles, TripMeasures
from stratiform.functions.casts import cast_by_mapping
from stratiform.plans.inputs import DEDUP_TIEBREAK
from stratiform.plans.medallion import to_bronze_text, to_gold, to_gold_metrics, to_silver, to_silver_text
from stratiform.plans.registry import dbl, query
from stratiform.session import scratch_path
from stratiform.sinks import create_or_merge, optimize_table
from stratiform.sources import read_tree, star_table

# A dataset's configuration in the form it has as a file.
_CONFIG = {
    "key_columns": ["line_key", "l_linenumber"],
    "date_columns": ["l_shipdate"],
    "metric_columns": ["price"],
    "dimension_columns": ["flag"],
    "string_columns": ["flag"],
    "null_handling_rules": {"line_key": "drop", "price": 0, "flag": "UNKNOWN"},
}
_RULES = {"bulk": "l_quantity > 5", "priced": "price > 0"}

_LINES = """lines AS (
  SELECT CASE WHEN l_orderkey % 97 <> 0 THEN l_orderkey END AS line_key, l_linenumber, l_shipdate, l_partkey, l_suppkey,
         l_quantity, l_extendedprice,
         CASE WHEN l_partkey % 13 <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS price,
         CASE WHEN l_suppkey % 17 <> 0 THEN '  ' || lower(l_returnflag) || ' ' END AS flag,
         l_discount AS _discount
  FROM lineitem),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line_key, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS n FROM lines)
  WHERE n = 1 AND line_key IS NOT NULL),
silver AS (
  SELECT line_key, l_linenumber, l_shipdate, l_quantity, coalesce(price, 0) AS price,
         coalesce(upper(trim(flag)), 'UNKNOWN') AS flag FROM latest)"""


def _lines(spark, sf):
    def some(column, by, n):
        return F.when(F.pmod(by, F.lit(n)) != 0, column)

    return star_table(spark, sf, "lineitem").select(
        some(F.col("l_orderkey"), "l_orderkey", 97).alias("line_key"),
        "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        some(F.col("l_extendedprice").cast("decimal(18,2)"), "l_partkey", 13).alias("price"),
        some(F.concat(F.lit("  "), F.lower("l_returnflag"), F.lit(" ")), "l_suppkey", 17).alias("flag"),
        F.col("l_discount").alias("_discount"),
    )


def _silver(spark, sf):
    roles = ColumnRoles.from_mapping(_CONFIG)
    return to_silver(_lines(spark, sf), roles, "l_shipdate", _RULES, DEDUP_TIEBREAK), roles


@query(
    "slv_layer_config",
    f"""WITH {_LINES}
        SELECT line_key, CAST(l_linenumber AS BIGINT) AS l_linenumber, {dbl("price")} AS price, flag,
               l_quantity > 5 AND price > 0 AS is_valid,
               nullif(concat_ws(';', CASE WHEN NOT l_quantity > 5 THEN 'bulk' END,
                                     CASE WHEN NOT price > 0 THEN 'priced' END), '') AS errors,
               CAST(0 AS BIGINT) AS null_columns, CAST(1 AS DOUBLE) AS score
        FROM silver""",
)
def slv_layer_config(spark, sf):
    """A silver layer by configuration: string columns, NULL rules, validity, completeness."""
    silver, _ = _silver(spark, sf)
    return silver.select(
        "line_key", "l_linenumber", "price", "flag", F.col("_is_valid").alias("is_valid"),
        F.col("_validation_errors").alias("errors"), F.col("_null_column_count").alias("null_columns"),
        F.col("_completeness_score").alias("score"),
    )


@query(
    "gld_layer_config",
    f"""WITH {_LINES}
        SELECT 'daily' AS table_name, count(*) AS rows, sum(n)::BIGINT AS records FROM
          (SELECT CAST(l_shipdate AS DATE) AS d, flag, count(*) AS n FROM silver GROUP BY 1, 2)
        UNION ALL SELECT 'monthly', count(*), sum(n)::BIGINT FROM
          (SELECT year(l_shipdate) AS y, month(l_shipdate) AS m, flag, count(*) AS n FROM silver GROUP BY 1, 2, 3)
        UNION ALL SELECT 'dimensions', count(DISTINCT flag), count(*) FROM silver""",
)
def gld_layer_config(spark, sf):
    """Silver merged into a table twice and optimised, and the gold tables made from it."""
    silver, roles = _silver(spark, sf)
    path = scratch_path(spark, "layer")
    table = "stratiform_" + path.rsplit("/", 1)[-1].replace("-", "_")
    early = F.col("l_shipdate") < "1996-01-01"
    for rows in (silver.where(early), silver.where(~early)):
        create_or_merge(rows, table, roles.keys, location=path)
    optimize_table(spark, table, where="l_linenumber = 1")
    gold = to_gold(spark.read.parquet(path), roles)
    spark.sql(f"DROP TABLE {table}")
    parts = [
        df.agg(F.count("*").alias("rows"), F.sum("record_count").alias("records")).select(F.lit(name).alias("table_name"), "rows", "records")
        for name, df in gold.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_TEXT_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
_TEXT_MEASURES = TripMeasures("l_extendedprice", "l_tax", "l_extendedprice", "l_quantity", "l_linenumber")


@query(
    "gld_layer_metrics",
    f"""SELECT CAST(l_linenumber AS BIGINT) AS passenger_count, count(*) AS total_trips,
               {dbl("sum(CAST(l_extendedprice AS DECIMAL(18,2)))")} AS total_fare, CAST(2023 AS BIGINT) AS "year"
        FROM lineitem GROUP BY 1""",
)
def gld_layer_metrics(spark, sf):
    """Files of two formats kept as text, cleansed as text, typed by a mapping, then measured."""
    root = scratch_path(spark, "text-layer")
    lines = star_table(spark, sf, "lineitem").select(*_TEXT_KEYS, "l_tax")
    odd = F.pmod("l_orderkey", F.lit(2)) == 1
    lines.where(odd).write.parquet(f"{root}/p")
    lines.where(~odd).write.option("header", True).csv(f"{root}/c")
    roles = ColumnRoles(keys=_TEXT_KEYS, dates=["l_shipdate"])
    bronze = to_bronze_text(read_tree(spark, root, lineage=True), "2023", "run-1")
    types = {"l_linenumber": "int", "l_extendedprice": "decimal(18,2)", "l_tax": "decimal(4,2)", "l_quantity": "decimal(18,2)"}
    typed = cast_by_mapping(to_silver_text(bronze, roles), types)
    metrics = to_gold_metrics(typed, "2023", "l_shipdate", _TEXT_MEASURES)["passenger_metrics"]
    return metrics.select(
        F.col("passenger_count").cast("bigint").alias("passenger_count"), "total_trips", "total_fare", F.col("year").cast("bigint").alias("year")
    )
