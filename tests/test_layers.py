"""The layers end to end, from files to gold tables."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from stratiform.config import DAILY_TYPES, ColumnRoles
from stratiform.functions.casts import cast_by_mapping
from stratiform.operators import quality as q
from stratiform.operators.layout import file_stats
from stratiform.operators.profiling import suggest_roles
from stratiform.plans.medallion import (
    ingest_folder,
    to_bronze_text,
    to_gold,
    to_gold_metrics,
    to_silver,
    to_silver_text,
)
from stratiform.session import scratch_path
from stratiform.sinks import append_results, create_or_merge, optimize_table, write_gold
from stratiform.sources import read_tree, trips

COLUMNS = (
    "trip_id",
    "pickup_datetime",
    "passenger_count",
    "trip_distance_mi",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "payment_type",
)
ROLES = ColumnRoles(
    keys=("trip_id",),
    dates=("pickup_datetime",),
    metrics=("fare_amount", "tip_amount"),
    dimensions=("payment_type",),
    strings=("payment_type",),
    null_rules={"trip_id": "drop", "passenger_count": 1},
)


@pytest.fixture
def prefix(spark):
    name = f"flow_{uuid.uuid4().hex[:8]}"
    yield name
    for t in spark.catalog.listTables():
        if t.name.startswith(name):
            spark.sql(f"DROP TABLE {t.name}")


@pytest.fixture(scope="module")
def folder(spark, sf_dir):
    root = scratch_path(spark, "test-layers")
    df = trips(spark, sf_dir, COLUMNS)
    df.write.parquet(f"{root}/2023/parquet")
    df.limit(10).write.option("header", True).csv(f"{root}/2023/csv")
    return f"{root}/2023"


def test_typed_layers(spark, folder, prefix):
    bronze, silver = f"{prefix}_bronze", f"{prefix}_silver"
    early, late = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 2, 6)
    assert ingest_folder(spark, folder, bronze, now=early) == [bronze, f"{bronze}_csv"]
    ingest_folder(spark, folder, bronze, now=late)
    once = spark.read.parquet(f"{folder}/parquet")
    assert spark.table(bronze).count() == 2 * once.count()

    for _ in range(2):
        create_or_merge(to_silver(spark.table(bronze), ROLES), silver, ROLES.keys)
    kept = spark.table(silver)
    assert kept.count() == once.select("trip_id").distinct().count()
    assert kept.select("_ingestion_date").distinct().first()[0] == late.date()

    gold = to_gold(kept, ROLES)
    for name, df in gold.items():
        by = {"daily": (), "monthly": ("agg_year", "agg_month"), "dimensions": ()}[name]
        write_gold(df, f"{prefix}_gold_{name}", by)
    daily = spark.table(f"{prefix}_gold_daily")
    assert daily.agg(F.sum("record_count")).first()[0] == kept.count()

    results = q.suite(
        spark.table(bronze), kept, ROLES.keys, {"trip_id": 0.0}, now=late + dt.timedelta(hours=1)
    )
    append_results(results, f"{prefix}_checks")
    passed = {r.check_type: r.passed for r in spark.table(f"{prefix}_checks").collect()}
    assert passed == {
        "row_count": False,  # half of the rows are repeats
        "schema_consistency": True,
        "null_percentage": True,
        "duplicates": True,
        "data_freshness": True,
    }


def test_text_layers(spark, folder):
    bronze = to_bronze_text(read_tree(spark, f"{folder}/parquet"), "2023", "r1")
    assert {t for _, t in bronze.dtypes} == {"string"}
    silver = to_silver_text(bronze, ROLES)
    numbers = {c: "double" for c in ("fare_amount", "tip_amount", "total_amount", "trip_distance")}
    typed = cast_by_mapping(silver.withColumnRenamed("trip_distance_mi", "trip_distance"), numbers)
    gold = to_gold_metrics(typed, "2023")
    assert gold["passenger_metrics"].agg(F.sum("total_trips")).first()[0] == silver.count()
    daily = cast_by_mapping(gold["daily_metrics"], DAILY_TYPES)
    assert dict(daily.dtypes)["avg_fare"] == "decimal(18,2)"
    assert dict(daily.dtypes)["aggregation_timestamp"] == "timestamp"


def test_optimize_table(spark, prefix):
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("p"), (F.col("id") % 50).alias("c"))
    df.repartition(30).write.saveAsTable(f"{prefix}_t")
    for options in ({}, {"cluster_by": ["c"]}, {"cluster_by": ["c"], "where": "p = 1"}):
        optimize_table(spark, f"{prefix}_t", **options)
        assert spark.table(f"{prefix}_t").agg(F.sum("id")).first()[0] == 4_498_500
    optimize_table(spark, f"{prefix}_t", partition_by=["p"])
    assert file_stats(spark.table(f"{prefix}_t")).count() == 3


def test_suggested_roles(spark, sf_dir):
    roles = suggest_roles(trips(spark, sf_dir, COLUMNS))
    assert roles.keys == ["trip_id"] and roles.dates == ["pickup_datetime"]
    assert roles.metrics == ["passenger_count", "trip_distance_mi"]  # decimals have no role
    assert roles.dimensions == ["payment_type"]
