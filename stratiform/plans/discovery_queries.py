"""Profiles, candidate keys, date ranges and column roles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.operators import profiling as pf
from stratiform.operators.layout import column_stats
from stratiform.plans.registry import query, r, rounded
from stratiform.plans.report_queries import _MATCHED, _MATCHED_COLUMNS, _matched
from stratiform.sources import star_table

_TYPES = {
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    "customer": {
        "c_custkey": "bigint",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    "part": {
        "p_partkey": "bigint",
        "p_name": "string",
        "p_brand": "string",
        "p_type": "string",
        "p_size": "int",
        "p_retailprice": "double",
    },
    "events": {
        "event_id": "bigint",
        "ts": "timestamp_ntz",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
        "props": "string",
    },
    "documents": {
        "doc_id": "bigint",
        "text": "string",
        "lang": "string",
        "source": "string",
        "n_chars": "bigint",
    },
}
_MATCHED_TYPES = dict(
    zip(
        _MATCHED_COLUMNS,
        ("bigint", "string", "bigint", "double", "string", "int", "timestamp_ntz"),
        strict=True,
    )
)


def _profile_sql(source: str, types: dict[str, str]) -> str:
    rows = [
        f"""SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type,
              count(*) AS total_rows, count(*) - count({c}) AS null_count,
              (count(*) - count({c})) * 100.0 / count(*) AS null_pct,
              count(DISTINCT {c}) + CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END
                AS distinct_count,
              (count(DISTINCT {c}) + CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END)
                * 100.0 / count(*) AS cardinality_pct FROM {source}"""
        for i, (c, t) in enumerate(types.items())
    ]
    return " UNION ALL ".join(rows)


@query("dsc_profile", f"WITH {_MATCHED} {_profile_sql('matched', _MATCHED_TYPES)}")
def dsc_profile(spark, sf):
    return pf.profile(_matched(spark, sf))


@query("dsc_profile_documents", _profile_sql("documents", _TYPES["documents"]))
def dsc_profile_documents(spark, sf):
    """Profile of a table with long text, compared whole."""
    return pf.profile(star_table(spark, sf, "documents"))


@query("dsc_profile_bitmaps", _profile_sql("orders", _TYPES["orders"]))
def dsc_profile_bitmaps(spark, sf):
    """The exact profile, neighbouring keys sharing bitmaps where that shuffles less."""
    orders = star_table(spark, sf, "orders")
    return pf.profile(orders, bitmaps=pf.bitmap_columns(orders))


@query("dsc_profile_approx")
def dsc_profile_approx(spark, sf):
    return pf.profile(star_table(spark, sf, "lineitem"), approx=True)


@query(
    "dsc_exact_duplicates",
    """WITH c AS (SELECT (SELECT count(*) FROM documents) AS total_rows, (SELECT count(*) FROM
         (SELECT DISTINCT text, lang, source, n_chars FROM documents)) AS distinct_rows)
       SELECT *, total_rows - distinct_rows AS duplicate_rows,
              (total_rows - distinct_rows) * 100.0 / total_rows AS duplicate_pct FROM c""",
)
def dsc_exact_duplicates(spark, sf):
    return pf.exact_duplicates(star_table(spark, sf, "documents").drop("doc_id"))


_PROFILED = ("orders", "customer", "part", "events")


def _profiles(spark, sf) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            pf.profile(star_table(spark, sf, t)).withColumn("table_name", F.lit(t))
            for t in _PROFILED
        ],
    )


_PROFILES_SQL = " UNION ALL ".join(
    f"SELECT *, '{t}' AS table_name FROM ({_profile_sql(t, _TYPES[t])})" for t in _PROFILED
)


@query(
    "dsc_candidate_keys",
    f"SELECT * FROM ({_PROFILES_SQL}) WHERE null_pct < 5 AND cardinality_pct > 80",
)
def dsc_candidate_keys(spark, sf):
    return pf.candidate_keys(_profiles(spark, sf))


@query(
    "dsc_cluster_candidates",
    f"SELECT * FROM ({_PROFILES_SQL}) WHERE distinct_count > 10 AND distinct_count < 1000",
)
def dsc_cluster_candidates(spark, sf):
    return pf.cluster_candidates(_profiles(spark, sf))


@query(
    "dsc_roles",
    f"""SELECT *, CASE
          WHEN column_name LIKE '%id%' OR column_name LIKE '%key%' THEN 'key'
          WHEN data_type LIKE '%timestamp%' OR data_type LIKE '%date%'
            OR column_name LIKE '%time%' OR column_name LIKE '%date%' THEN 'date'
          WHEN data_type IN ('int', 'bigint', 'long', 'double', 'float', 'decimal') THEN
            CASE WHEN regexp_matches(column_name, 'amount|fare|tip|total|distance|count')
                 THEN 'metric' ELSE 'dimension' END
          WHEN data_type IN ('string', 'varchar') THEN 'dimension' END AS role
        FROM ({_PROFILES_SQL})""",
)
def dsc_roles(spark, sf):
    return pf.with_role(_profiles(spark, sf))


@query(
    "dsc_date_ranges",
    """SELECT 'dropped' AS column_name, 'date' AS data_type,
              CAST(min(CAST(l_shipdate AS DATE)) AS VARCHAR) AS min_value,
              CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) AS max_value, true AS partition_by
       FROM lineitem
       UNION ALL SELECT 'l_shipdate', 'timestamp_ntz', CAST(min(l_shipdate) AS VARCHAR),
              CAST(max(l_shipdate) AS VARCHAR), false FROM lineitem""",
)
def dsc_date_ranges(spark, sf):
    lines = star_table(spark, sf, "lineitem").select(
        "l_orderkey", F.to_date("l_shipdate").alias("dropped"), "l_shipdate"
    )
    return pf.date_ranges(lines)


_WIDTHS = {"bigint": 8, "double": 8, "timestamp_ntz": 8, "int": 4}


def _stats_sql(source: str, types: dict[str, str]) -> str:
    def width(c: str, t: str) -> str:
        return f"length({c})" if t == "string" else f"CASE WHEN {c} IS NOT NULL THEN {_WIDTHS[t]} END"

    rows = [
        f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS null_count,
              count(DISTINCT {c}) AS distinct_count, CAST(min({c}) AS VARCHAR) AS min_value,
              CAST(max({c}) AS VARCHAR) AS max_value, {r(f"avg({width(c, t)})")} AS avg_length,
              CAST(max({width(c, t)}) AS BIGINT) AS max_length FROM {source}"""
        for c, t in types.items()
    ]
    return " UNION ALL ".join(rows)


@query("lay_column_stats", f"WITH {_MATCHED} {_stats_sql('matched', _MATCHED_TYPES)}")
def lay_column_stats(spark, sf):
    return rounded(column_stats(_matched(spark, sf)), "avg_length")
