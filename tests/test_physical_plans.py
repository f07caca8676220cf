"""The plans that make the operators scale, checked on their explained text."""

import pytest

from stratiform.operators import rollup as ru
from stratiform.operators.dedup import latest_per_key
from stratiform.operators.quality import null_pct
from stratiform.plans import catalog
from stratiform.plans.inputs import flagged_trips, silver_trips, zone_trips
from stratiform.sources import star_table, trips


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_reduces_before_the_shuffle(spark, sf_dir):
    text = plan(latest_per_key(star_table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_shipdate"))
    exchange = text.index("Exchange hashpartitioning")
    assert "row_number(), 1, Partial" in text[exchange:]
    assert text.count("Exchange ") == 1


def test_aggregates_are_partial_first(spark, sf_dir):
    text = plan(ru.daily(trips(spark, sf_dir, ("pickup_datetime", "fare_amount")), "pickup_datetime", ["fare_amount"]))
    assert "partial_sum" in text and text.count("Exchange hashpartitioning") == 1


def test_trip_view_reads_only_needed_columns(spark, sf_dir):
    text = plan(trips(spark, sf_dir, ("fare_amount",)))
    assert "ReadSchema: struct<l_extendedprice:double>" in text and "Join" not in text


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(zone_trips(spark, sf_dir))
    assert "GreaterThan(l_quantity,0.2)" in text


def test_metrics_skip_what_the_flag_does_not_need(spark, sf_dir):
    passed = flagged_trips(spark, sf_dir)
    text = plan(ru.passenger_metrics(passed))
    assert "o_orderpriority" not in text and "supplier" not in text


def test_lookups_are_broadcast_when_small(spark, sf_dir):
    text = plan(silver_trips(spark, sf_dir))
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text


def test_lookups_given_as_rows_are_broadcast(spark, sf_dir):
    text = plan(catalog.queries()["feat_pair_distance"](spark, sf_dir))
    assert "SortMergeJoin" not in text and "LocalTableScan" in text


def test_null_check_scans_once(spark, sf_dir):
    limits = {c: 0.0 for c in ("o_orderkey", "o_custkey", "o_orderdate")}
    assert plan(null_pct(star_table(spark, sf_dir, "orders"), limits)).count("FileScan") == 1


SAFE = [n for n in catalog.queries() if not n.startswith(("src_", "snk_", "lay_", "dq_history"))]


@pytest.mark.parametrize("name", SAFE)
def test_no_python_and_no_cross_joins(spark, sf_dir, name):
    text = plan(catalog.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "InPandas"):
        assert bad not in text
