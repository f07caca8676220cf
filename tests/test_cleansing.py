import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratiform.config import ColumnRoles
from stratiform.functions import demand as dm
from stratiform.functions import trip as tp
from stratiform.functions.casts import cast_all_to_string, cast_by_mapping
from stratiform.operators import cleansing as cl
from stratiform.operators.dedup import latest_per_key
from stratiform.plans.medallion import to_gold, to_gold_metrics, to_silver, to_silver_text


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_null_tokens_match_exactly(spark):
    values = ["", "null", "NULL", " NULL", "Null", "x", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    assert [r.v for r in cl.null_tokens(df).orderBy("i").collect()] == [
        None, None, None, " NULL", "Null", "x", None,
    ]


def test_null_tokens_leave_other_types_alone(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert cl.null_tokens(df).dtypes == [("a", "int"), ("b", "double")]


def test_standardize(spark):
    df = spark.createDataFrame([("  aB ", None)], "a string, b string")
    assert rows(cl.standardize_strings(df, ["a", "b"])) == [("AB", None)]
    assert rows(cl.standardize_strings(df, ["a"], "lower")) == [("ab", None)]
    assert rows(cl.standardize_strings(df, ["a"], None)) == [("aB", None)]


def test_handle_nulls_keeps_types(spark):
    df = spark.createDataFrame(
        [("k", None, None), (None, 2, "x")], "k string, n int, t string"
    )
    out = cl.handle_nulls(df, {"k": "drop", "n": 1, "t": 0})
    assert out.dtypes == df.dtypes
    assert rows(out) == [("k", 1, "0")]


def test_quality_flag(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None)], "k string, d string")
    flags = cl.quality_flag(df, "k", "d").groupBy("data_quality_flag").count()
    assert rows(flags) == [("FAILED", 2), ("PASSED", 1)]
    assert cl.passed_only(cl.quality_flag(df, "k", "d")).count() == 1


def test_validity_without_rules_is_true(spark):
    df = cl.validity_columns(spark.range(1))
    row = df.first()
    assert row._is_valid is True and row._validation_errors is None


def test_validity_counts_null_as_broken(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (-1, 50)], "a int, b int")
    out = cl.validity_columns(df, {"a_pos": "a > 0", "b_low": F.col("b") < 10})
    assert [(r._is_valid, r._validation_errors) for r in out.orderBy("b", "a").collect()] == [
        (False, "a_pos"),
        (True, None),
        (False, "a_pos;b_low"),
    ]


def test_completeness_skips_metadata(spark):
    df = spark.createDataFrame([(1, None, None), (1, 2, 3)], "a int, b int, _m int")
    assert [(r[3], r[4]) for r in cl.completeness(df).orderBy("b").collect()] == [(1, 0.5), (0, 1.0)]
    with pytest.raises(ValueError):
        cl.completeness(df.select("_m"))


def test_dedup_is_deterministic_and_idempotent(spark):
    data = [("k", 1, "a"), ("k", 2, "a"), ("k", 2, "b"), (None, 1, "x"), (None, 3, "y"), ("", 1, "e")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    for n in (1, 7):
        once = latest_per_key(df.repartition(n), ["k"], "t")
        assert rows(once) == [(None, 3, "y"), ("", 1, "e"), ("k", 2, "b")]
        assert rows(latest_per_key(once, ["k"], "t")) == rows(once)


def test_dedup_survives_a_hot_key(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("t"),
    )
    out = latest_per_key(hot, ["k"], "t")
    assert out.count() == 20_001
    assert out.where("k = 'hot'").first().t == 29_997


def test_try_cast_by_mapping(spark):
    df = spark.createDataFrame([("1.005", "x", "keep")], "d string, n string, o string")
    out = cast_by_mapping(df, {"d": "decimal(18,2)", "n": "bigint", "absent": "int"})
    assert rows(out) == [(Decimal("1.01"), None, "keep")]
    assert cast_all_to_string(spark.range(1)).dtypes == [("id", "string")]


def test_trip_derivations(spark):
    df = spark.createDataFrame(
        [
            (dt.datetime(2024, 3, 9, 17, 5), "JFK", "x", 6.0, 30.0, Decimal("10.00"), Decimal("12.50")),
            (dt.datetime(2024, 3, 9, 0, 0), None, "y", 6.0, 0.0, Decimal("0.00"), Decimal("1.00")),
        ],
        "pickup_datetime timestamp, pickup_zone string, dropoff_zone string, trip_distance_mi double,"
        "trip_duration_min double, fare_amount decimal(10,2), total_amount decimal(10,2)",
    )
    a, b = tp.derive_trip_columns(df).orderBy("hour", ascending=False).collect()
    assert (a.year, a.month, a.day, a.hour) == (2024, 3, 9, 17)
    assert (a.speed_mph, a.airport_trip, a.surge_proxy) == (12.0, 1, 0.25)
    assert (b.speed_mph, b.airport_trip, b.surge_proxy) == (None, 0, None)
    assert tp.quality_filter(df).count() == 1


@pytest.mark.parametrize(
    ("hour", "band"),
    [(6, 1.0), (7, 1.15), (9, 1.15), (10, 1.0), (16, 1.2), (19, 1.2), (20, 1.0), (22, 1.1), (2, 1.1), (3, 1.0)],
)
def test_time_band(spark, hour, band):
    assert spark.range(1).select(dm.time_band(F.lit(hour))).first()[0] == band


def test_calendar_outside_known_years(spark):
    df = spark.createDataFrame([("2019-07-04",), ("2025-07-04",), (None,)], "d string")
    out = dm.calendar_features(df, "d").orderBy("d").collect()
    assert [(r.is_holiday, r.year_index) for r in out] == [(False, None), (False, None), (True, 1.25)]
    assert len(dm.HOLIDAYS) == 63


def test_expected_distance_is_ordered(spark):
    df = spark.createDataFrame([("Queens", "JFK"), ("JFK", "Queens")], "pickup_zone string, dropoff_zone string")
    out = dm.expected_distance(df, dm.pair_distances(spark))
    assert sorted(r.expected_miles for r in out.collect()) == [3.5, 11.0]


ROLES = ColumnRoles(
    keys=("k",), dates=("d",), metrics=("m",), dimensions=("g",), strings=("g",), null_rules={"m": 0}
)


def _bronze(spark):
    return spark.createDataFrame(
        [
            ("a", dt.datetime(2024, 1, 1), 1, " x ", 1),
            ("a", dt.datetime(2024, 1, 1), 2, "X", 2),
            ("b", dt.datetime(2024, 2, 1), None, "y", 1),
        ],
        "k string, d timestamp, m int, g string, _ingestion_timestamp int",
    )


def test_silver_and_gold_compose(spark):
    silver = to_silver(_bronze(spark), ROLES)
    assert rows(silver.select("k", "m", "g", "_is_valid", "_completeness_score")) == [
        ("a", 2, "X", True, 1.0),
        ("b", 0, "Y", True, 1.0),
    ]
    gold = to_gold(silver, ROLES)
    assert set(gold) == {"daily", "monthly", "dimensions"}
    assert rows(gold["daily"].select("g", "m_sum", "record_count", "aggregation_level")) == [
        ("X", 2, 1, "daily"),
        ("Y", 0, 1, "daily"),
    ]
    assert "_gold_processed_timestamp" in gold["monthly"].columns
    assert rows(gold["dimensions"]) == [("X", 1, 1), ("Y", 1, 2)]


def test_text_silver_order_of_steps(spark):
    df = spark.createDataFrame(
        [("null", "d", "1"), ("", "d", "2"), ("k", "", "3")],
        "k string, d string, ingestion_timestamp string",
    )
    plain = to_silver_text(df, ROLES)
    assert plain.where("k is null").count() == 2
    assert to_silver_text(df, ROLES, normalize_first=True).where("k is null").count() == 1
    assert plain.where("data_quality_flag = 'FAILED'").count() == 3


def test_metric_tables(spark):
    df = spark.createDataFrame(
        [("2024-01-01", 9.5, 1.0, 10.5, 2.0, 1), ("2024-01-01", 10.0, None, 10.0, 4.0, 1)],
        "pickup_datetime string, fare_amount double, tip_amount double, total_amount double,"
        "trip_distance double, passenger_count int",
    ).withColumn("data_quality_flag", F.lit("PASSED"))
    tables = to_gold_metrics(df, "2024")
    day = tables["daily_metrics"].first()
    assert (day.total_trips, day.avg_tip, day.max_fare, day.avg_passengers) == (2, 1.0, 10.0, 1.0)
    assert tables["monthly_metrics"].first().active_days == 1
    assert tables["passenger_metrics"].first().year == "2024"


def test_config_from_mapping(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"key_columns": ["a"], "date_columns": ["d"], "null_handling_rules": {"a": "drop"}}')
    roles = ColumnRoles.from_json(path)
    assert roles.keys == ("a",) and roles.null_rules == {"a": "drop"} and roles.metrics == ()
