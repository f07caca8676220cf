"""A key that holds a third of the rows, with thresholds lowered to test size."""

import contextlib

import pytest
from pyspark.sql import functions as F

from stratiform.operators.dedup import latest_per_key
from stratiform.operators.enrich import enrich
from stratiform.operators.layout import even_partitions, file_stats, partition_size
from stratiform.operators.merge import snapshot_diff, upsert
from stratiform.session import scratch_path, tune

ROWS = 300_000


@contextlib.contextmanager
def settings(spark, **conf):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def small_limits(spark):
    tune(spark)
    with settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        },
    ):
        yield


def hot(spark):
    """A third of the rows share one key; the payload keeps the shuffle from shrinking."""
    return spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        "id",
    )


def count_plan(df) -> tuple[int, str]:
    counted = df.agg(F.count("payload").alias("n"))
    n = counted.collect()[0].n
    return n, counted._jdf.queryExecution().executedPlan().toString()


def test_large_lookup_join_splits_the_hot_key(spark, small_limits):
    lookup = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), "id"
    )
    n, plan = count_plan(enrich(hot(spark), lookup, {"k": "key"}, {"id": "found"}))
    assert n == ROWS and "skew=true" in plan


def test_upsert_splits_the_hot_key(spark, small_limits):
    source = hot(spark).where("id % 3 <> 0 and id < 1000")
    n, plan = count_plan(upsert(hot(spark), source, ["k"]))
    assert n == ROWS and "skew=true" in plan


def test_missing_keys_stay_out_of_the_full_join(spark, small_limits):
    old = hot(spark).withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    diff = snapshot_diff(old, old, ["k"], ["payload"])
    counts = {tuple(r) for r in diff.groupBy("change_type").count().collect()}
    assert counts == {("insert", ROWS // 3), ("delete", ROWS // 3)}


def test_dedup_keeps_one_row_of_the_hot_key(spark, small_limits):
    """That it leaves each map task once is checked on the plan, elsewhere."""
    kept = latest_per_key(hot(spark).select("k", "id"), ["k"], "id")
    assert kept.count() == ROWS - ROWS // 3 + 1
    assert kept.where("k = 'hot'").first().id == ROWS - 3


def test_rebalance_splits_the_hot_folder(spark):
    tune(spark)
    folder = F.when(F.col("k") == "hot", 1).otherwise(F.col("id") % 8)
    with partition_size(spark, 200 * 1024):
        even = even_partitions(hot(spark).withColumn("p", folder), ["p"])
        path = scratch_path(spark, "test-rebalance")
        even.write.partitionBy("p").parquet(path)
    written = file_stats(spark.read.parquet(path)).where(F.col("file_path").contains("/p=1/"))
    sizes = [r.row_count for r in written.collect()]
    assert len(sizes) > 3 and max(sizes) < sum(sizes) / 2
