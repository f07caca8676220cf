"""Every registered query against its SQL, over the whole tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert "tip_pct" in df.columns and df.count() > 0


def test_foreign_keys_resolve(spark, sf_dir):
    """The trip view skips joins it does not need; that is only right if all keys match."""
    from stratiform.sources import star_table, trips

    assert trips(spark, sf_dir).count() == star_table(spark, sf_dir, "lineitem").count()


def test_sample_is_about_a_twentieth(spark, sf_dir):
    from stratiform.sources import star_table

    n = QUERIES["rpt_sample"](spark, sf_dir).groupBy().sum("trips").first()[0]
    total = star_table(spark, sf_dir, "lineitem").count()
    assert 0.03 * total < n < 0.07 * total
