"""Quality checks, profiles and reports on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratiform.operators import profiling as pf
from stratiform.operators import quality as q
from stratiform.operators import reporting as rp
from stratiform.operators.layout import column_stats

NOW = dt.datetime(2024, 1, 2, 0, 0)


def only(df):
    (row,) = df.collect()
    return row


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "k int, v string, ts timestamp")


def test_row_counts(spark, empty):
    r = only(q.row_counts(spark.range(100), spark.range(95), 5.0))
    assert (r.metric, r.passed, r.details["variance"]) == (5.0, True, "5")
    assert only(q.row_counts(spark.range(100), spark.range(94), 5.0)).passed is False
    assert only(q.row_counts(empty, spark.range(3))).metric == 0.0


def test_schema_consistency(spark):
    a = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, _m double")
    b = spark.createDataFrame([(1, "x", 2)], "a bigint, c string, _m int")
    r = only(q.schema_consistency(a, b, ["_m"]))
    assert r.passed is False and r.columns == ["a", "b", "c"]
    assert (r.details["only_left"], r.details["only_right"], r.details["type_mismatch"]) == ("b", "c", "a")
    same = only(q.schema_consistency(a, a))
    assert same.passed is True and same.columns == []


def test_null_pct(spark, empty):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,)], "k int")
    assert only(q.null_pct(df, {"k": 25.0})).passed is True
    assert only(q.null_pct(df, {"k": 24.9})).passed is False
    assert only(q.null_pct(empty, {"k": 0.0})).passed is True
    assert q.null_pct(df, {}).count() == 0


def test_no_nulls(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    got = {r.columns[0]: r.passed for r in q.no_nulls(df, ["a", "b", "zz"]).collect()}
    assert got == {"a": False, "b": True, "zz": False}


def test_duplicates_null_is_a_value(spark, empty):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    r = only(q.duplicates(df, ["k"], 30.0))
    assert (r.details["duplicate_count"], r.passed) == ("1", False)
    assert only(q.duplicates(empty, ["k"])).passed is True


@pytest.mark.parametrize(
    ("newest", "passed", "metric"),
    [
        (dt.datetime(2024, 1, 1, 12), True, 12.0),
        (dt.datetime(2023, 12, 31, 23), False, 25.0),
        (dt.datetime(2024, 1, 3), False, -24.0),
        (None, False, -1.0),
    ],
)
def test_freshness(spark, newest, passed, metric):
    df = spark.createDataFrame([(newest.isoformat() if newest else None,)], "t string")
    r = only(q.freshness(df.select(F.to_timestamp("t").alias("t")), "t", 24, NOW))
    assert (r.passed, r.metric) == (passed, metric)


def test_min_rows_flag_rate_retention(spark, empty):
    assert only(q.min_rows(empty)).passed is False
    assert only(q.min_rows(spark.range(5), 5)).passed is True
    assert only(q.quality_flag_rate(empty)).passed is True
    flagged = empty.withColumn("data_quality_flag", F.lit("PASSED"))
    assert only(q.quality_flag_rate(flagged)).passed is False
    bands = [only(q.retention(spark.range(100), spark.range(n))).details["band"] for n in (90, 70, 69)]
    assert bands == ["Good", "Moderate", "Low"]
    assert q.retention(empty, spark.range(3)).count() == 0


def test_suite_and_recent(spark):
    df = spark.range(10).withColumn("_ingestion_timestamp", F.lit("2024-01-01 12:00:00").cast("timestamp"))
    results = q.suite(df, df, ["id"], {"id": 0.0}, now=NOW)
    assert results.schema.fieldNames() == q.RESULT_SCHEMA.fieldNames()
    assert [r.passed for r in results.collect()] == [True] * 5
    assert q.recent_results(results, 3).count() == 3


def test_profile_types_and_edges(spark, empty):
    df = spark.sql(
        """SELECT * FROM VALUES
        (1, 0.0D, 'a', true, DATE'2024-01-01', CAST(1.10 AS DECIMAL(5,2)), array(1,2), X'00'),
        (2, -0.0D, 'a', false, NULL, CAST(1.10 AS DECIMAL(5,2)), array(1,2), X'01'),
        (NULL, double('NaN'), NULL, true, NULL, NULL, NULL, X'00')
        AS t(i, d, s, b, dt, dec, arr, bin)"""
    )
    got = {r.column_name: (r.null_count, r.distinct_count) for r in pf.profile(df).collect()}
    assert got == {
        "i": (1, 3), "d": (0, 2), "s": (1, 2), "b": (0, 2),
        "dt": (2, 2), "dec": (1, 2), "arr": (1, 2), "bin": (0, 2),
    }
    near = {r.column_name: (r.null_count, r.distinct_count) for r in pf.profile(df, approx=True).collect()}
    assert near == got
    zero = pf.profile(empty).collect()
    assert [(r.total_rows, r.null_pct, r.distinct_count) for r in zero] == [(0, 0.0, 0)] * 3


def test_times_are_told_apart_in_any_zone(spark):
    """Local times that a clock change skips, and microseconds within nested values."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(
            """SELECT CAST(t AS timestamp_ntz) AS local, struct(CAST(t AS timestamp_ntz) AS t) AS local_in,
                      struct(CAST(u AS timestamp) AS t) AS instant_in
               FROM VALUES ('2024-03-10 02:30:00', '2024-01-01 00:00:00.000001'),
                           ('2024-03-10 03:30:00', '2024-01-01 00:00:00.000002'),
                           ('2024-03-10 03:30:00.000001', '2024-01-01 00:00:00.000002') AS v(t, u)"""
        )
        got = {r.column_name: r.distinct_count for r in pf.profile(df).collect()}
        assert got == {"local": 3, "local_in": 3, "instant_in": 2}
        assert pf.exact_duplicates(df).first().duplicate_rows == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_long_text_is_compared_whole(spark):
    base = "x" * 5000
    df = spark.createDataFrame([(base + "1",), (base + "2",), (base + "1",)], "t string")
    assert only(pf.profile(df)).distinct_count == 2
    assert only(pf.exact_duplicates(df)).duplicate_rows == 1


def test_roles_of_a_known_trip_table(spark):
    columns = {
        "trip_id": "string", "vendor_id": "int", "pickup_datetime": "timestamp",
        "dropoff_datetime": "timestamp", "passenger_count": "int", "trip_distance": "double",
        "pickup_longitude": "double", "rate_code": "int", "store_and_fwd_flag": "string",
        "payment_type": "int", "fare_amount": "double", "extra": "double", "tip_amount": "double",
        "tolls_amount": "double", "total_amount": "double", "price": "decimal(10,2)", "ok": "boolean",
    }
    df = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in columns.items()))
    roles = {r.column_name: r.role for r in pf.classify_columns(df).collect()}
    by_role = lambda role: {c for c, r in roles.items() if r == role}
    assert by_role("key") == {"trip_id", "vendor_id"}
    assert by_role("date") == {"pickup_datetime", "dropoff_datetime"}
    assert by_role("metric") == {
        "passenger_count", "trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount",
    }
    assert by_role(None) == {"price", "ok"}


def test_date_ranges_without_dates(spark):
    assert pf.date_ranges(spark.range(3)).count() == 0


def _shuffled_bytes(df) -> int:
    """Bytes that the exchanges of a collected frame wrote."""
    df.collect()

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get("shuffleBytesWritten").get().value() if kind == "ShuffleExchangeExec" else 0
        below = node.children()
        return own + sum(walk(below.apply(i)) for i in range(below.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_profile_by_bitmaps(spark):
    edge = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2**63 - 1, -(2**63), None, None, 5, 5]
    df = spark.createDataFrame([(v, None, v is None) for v in edge], "v long, gone int, flag boolean")
    names = ["v", "gone", "flag"]
    for some in (["v"], names):
        assert sorted(pf.profile(df, bitmaps=some).collect()) == sorted(pf.profile(df).collect())
    assert sorted(pf.profile(df.limit(0), bitmaps=names).collect()) == sorted(pf.profile(df.limit(0)).collect())
    with pytest.raises(ValueError, match="text"):
        pf.profile(spark.createDataFrame([("x",)], "text string"), bitmaps=["text"])


def test_bitmaps_shuffle_little_where_keys_are_dense(spark):
    n = 400_000
    df = spark.range(0, n, 1, 4).select("id", (F.xxhash64("id")).alias("sparse"), F.col("id").cast("string").alias("text"))
    assert pf.bitmap_columns(df) == ["id"]
    assert pf.bitmap_columns(df.select("text")) == [] and pf.bitmap_columns(df.limit(0)) == []
    by_bits = pf.profile(df, ["id"], bitmaps=["id"])
    assert by_bits.first().distinct_count == n
    assert _shuffled_bytes(by_bits) < 0.2 * 8 * n < _shuffled_bytes(pf.profile(df, ["id"]))


def test_column_stats(spark):
    df = spark.createDataFrame([("bb", 1), ("a", None)], "s string, n int")
    got = {r.column_name: (r.min_value, r.max_value, r.null_count, r.distinct_count, r.max_length) for r in column_stats(df).collect()}
    assert got == {"s": ("a", "bb", 0, 2, 2), "n": ("1", "1", 1, 1, 4)}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.5, 1.0, 1.0, None)], "x double")
    got = [r.frequency for r in rp.histogram(df, "x", 4).orderBy("bin").collect()]
    assert got == [1, 0, 1, 2]
    flat = rp.histogram(df.where("x = 1"), "x", 4).orderBy("bin").collect()
    assert [r.frequency for r in flat] == [2, 0, 0, 0] and flat[0].mean_value == 1.0


def test_null_profile_bands(spark):
    df = spark.createDataFrame([(1, None, None)] + [(1, 1, None)] * 9, "a int, b int, _c int")
    got = [(r.column_name, r.null_pct, r.band) for r in rp.null_profile(df).collect()]
    assert got == [("a", 0.0, "low"), ("b", 10.0, "medium")]
    assert rp.null_profile(df, ["_c"]).first().band == "high"
    assert rp.null_profile(df.limit(0)).count() == 0


def test_valid_pct_and_missing_layer(spark):
    assert rp.valid_pct(spark.range(2)).first().valid_pct == 100.0
    none = spark.range(0).withColumn("_is_valid", F.lit(True))
    assert rp.valid_pct(none).first().valid_pct == 0.0
    counts = rp.layer_counts(spark, {"a": spark.range(2), "b": None})
    assert sorted(tuple(r) for r in counts.collect()) == [("a", 2), ("b", 0)]


def test_daily_and_monthly_totals_agree(spark, sf_dir):
    from stratiform.operators.rollup import time_rollup
    from stratiform.sources import trips

    df = trips(spark, sf_dir, ("pickup_datetime", "fare_amount"))
    totals = {
        grain: time_rollup(df, "pickup_datetime", ["fare_amount"], grain=grain)
        .groupBy()
        .agg(F.sum("fare_amount_sum"), F.sum("record_count"))
        .first()
        for grain in ("daily", "monthly", "yearly")
    }
    assert totals["daily"] == totals["monthly"] == totals["yearly"]


def test_now_without_a_zone_is_utc(spark, monkeypatch):
    import time

    from stratiform.functions.audit import clock

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        seconds = spark.range(1).select(F.unix_seconds(clock(NOW))).first()[0]
    finally:
        monkeypatch.undo()
        time.tzset()
    assert seconds == 1_704_153_600
