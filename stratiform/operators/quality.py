"""Data-quality checks that return their results as rows of one fixed schema.

A check computes all its numbers in one pass over the data and decides nothing
for the caller: a failed check is a row with ``passed = false``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.config import SILVER_ADDED_COLUMNS
from stratiform.functions.audit import clock
from stratiform.session import local_frame, written

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("check_type", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("metric", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
        T.StructField("checked_at", T.TimestampType()),
    ]
)

# Retention bands, percent of rows that reach the next layer.
GOOD_RETENTION = 90.0
MODERATE_RETENTION = 70.0

# Share of rows that must carry the PASSED flag, in percent.
MIN_FLAG_RATE = 95.0


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent; 0 when there is nothing to take a share of."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def _result(
    check_type: str,
    table_name: str,
    target: str | None = None,
    columns: Column | Sequence[str] = (),
    metric: Column | None = None,
    threshold: Column | float | None = None,
    passed: Column | None = None,
    details: Mapping[str, Column] | None = None,
    now: datetime | None = None,
) -> list[Column]:
    """The result columns, typed; the inputs refer to an already aggregated frame."""
    names = (
        columns
        if isinstance(columns, Column)
        else F.array(*[F.lit(c) for c in columns])
    )
    pairs = [
        x for k, v in (details or {}).items() for x in (F.lit(k), v.cast("string"))
    ]
    values = {
        "check_type": F.lit(check_type),
        "table_name": F.lit(table_name),
        "target": F.lit(target),
        "columns": names,
        "metric": F.lit(metric),
        "threshold": F.lit(threshold),
        "passed": F.lit(passed),
        "details": F.create_map(*pairs),
        "checked_at": clock(now),
    }
    return [values[f.name].cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA]


def empty_results(spark: SparkSession) -> DataFrame:
    return local_frame(spark, [], RESULT_SCHEMA)


def _two_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row with the sizes of both frames as ``s`` and ``t``."""
    sides = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        target.select(F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    zero = F.lit(0).cast("long")
    return sides.agg(
        F.coalesce(F.sum("s"), zero).alias("s"), F.coalesce(F.sum("t"), zero).alias("t")
    )


def row_counts(
    source: DataFrame,
    target: DataFrame,
    tolerance_pct: float = 0.0,
    names: tuple[str, str] = ("source", "target"),
    now: datetime | None = None,
) -> DataFrame:
    """Do two tables differ in size by no more than a percentage of the source?"""
    gap = F.abs(F.col("s") - F.col("t"))
    pct = percent(gap, F.col("s"))
    return _two_counts(source, target).select(
        _result(
            "row_count",
            names[0],
            names[1],
            metric=pct,
            threshold=tolerance_pct,
            passed=pct <= tolerance_pct,
            details={
                "source_count": F.col("s"),
                "target_count": F.col("t"),
                "variance": gap,
            },
            now=now,
        )
    )


def schema_diff(left: DataFrame, right: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """Columns two frames do not share, or hold with different types."""

    def columns_of(df: DataFrame, type_name: str) -> DataFrame:
        rows = [(c, t) for c, t in df.dtypes if c not in excluded]
        return local_frame(df.sparkSession, rows, f"column string, {type_name} string")

    status = (
        F.when(F.col("right_type").isNull(), "only_left")
        .when(F.col("left_type").isNull(), "only_right")
        .when(F.col("left_type") != F.col("right_type"), "type_mismatch")
    )
    return (
        columns_of(left, "left_type")
        .join(columns_of(right, "right_type"), "column", "full")
        .withColumn("status", status)
        .where(F.col("status").isNotNull())
    )


def schema_consistency(
    left: DataFrame,
    right: DataFrame,
    excluded: Sequence[str] = (),
    names: tuple[str, str] = ("left", "right"),
    now: datetime | None = None,
) -> DataFrame:
    """Do two tables have the same columns with the same types?"""

    def listed(status: str) -> Column:
        hits = F.collect_list(F.when(F.col("status") == status, F.col("column")))
        return F.concat_ws(",", F.sort_array(hits))

    found = schema_diff(left, right, excluded).agg(
        F.count("*").alias("n"),
        F.sort_array(F.collect_list("column")).alias("names"),
        listed("only_left").alias("only_left"),
        listed("only_right").alias("only_right"),
        listed("type_mismatch").alias("type_mismatch"),
    )
    return found.select(
        _result(
            "schema_consistency",
            names[0],
            names[1],
            columns=F.col("names"),
            metric=F.col("n"),
            threshold=0.0,
            passed=F.col("n") == 0,
            details={s: F.col(s) for s in ("only_left", "only_right", "type_mismatch")},
            now=now,
        )
    )


def _null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its NULLs ``n`` and the table's ``total``, in one scan."""
    totals = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(columns)],
    )
    per_column = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("n"))
            for i, c in enumerate(columns)
        ]
    )
    return totals.select("total", F.inline(per_column))


def null_pct(
    df: DataFrame,
    max_pct: Mapping[str, float],
    name: str = "table",
    now: datetime | None = None,
) -> DataFrame:
    """Is the share of NULLs in each column within its limit?  One row per column."""
    if not max_pct:
        return empty_results(df.sparkSession)
    pairs = [F.lit(x) for c, p in max_pct.items() for x in (c, float(p))]
    limit = F.element_at(F.create_map(*pairs), F.col("column"))
    pct = percent(F.col("n"), F.col("total"))
    return _null_counts(df, list(max_pct)).select(
        _result(
            "null_percentage",
            name,
            columns=F.array("column"),
            metric=pct,
            threshold=limit,
            passed=pct <= limit,
            details={"null_count": F.col("n"), "total_rows": F.col("total")},
            now=now,
        )
    )


def no_nulls(
    df: DataFrame, columns: Sequence[str], name: str = "table", now: datetime | None = None
) -> DataFrame:
    """Are the columns free of NULLs?  A column the table lacks fails."""
    present = [c for c in columns if c in df.columns]
    missing = [c for c in columns if c not in df.columns]
    parts = [empty_results(df.sparkSession)]
    if present:
        parts = [
            _null_counts(df, present).select(
                _result(
                    "no_nulls",
                    name,
                    columns=F.array("column"),
                    metric=percent(F.col("n"), F.col("total")),
                    threshold=0.0,
                    passed=F.col("n") == 0,
                    details={"null_count": F.col("n"), "total_rows": F.col("total")},
                    now=now,
                )
            )
        ]
    if missing:
        absent = local_frame(df.sparkSession, [(c,) for c in missing], "column string")
        parts.append(
            absent.select(
                _result(
                    "no_nulls",
                    name,
                    columns=F.array("column"),
                    threshold=0.0,
                    passed=F.lit(False),
                    details={"error": F.lit("column not found")},
                    now=now,
                )
            )
        )
    return reduce(DataFrame.unionByName, parts)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with ``total`` rows and ``distinct_keys``; NULL is a key value.

    Rows are counted per key before the shuffle, so a repeated key is cheap.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total"),
            F.count("*").alias("distinct_keys"),
        )
    )


def duplicates(
    df: DataFrame,
    keys: Sequence[str],
    max_pct: float = 0.0,
    name: str = "table",
    now: datetime | None = None,
) -> DataFrame:
    """Is the share of rows beyond one per key within the limit?"""
    extra = F.col("total") - F.col("distinct_keys")
    pct = percent(extra, F.col("total"))
    return key_counts(df, keys).select(
        _result(
            "duplicates",
            name,
            columns=keys,
            metric=pct,
            threshold=max_pct,
            passed=pct <= max_pct,
            details={
                "total_rows": F.col("total"),
                "distinct_rows": F.col("distinct_keys"),
                "duplicate_count": extra,
            },
            now=now,
        )
    )


def freshness(
    df: DataFrame,
    ts_col: str,
    max_age_hours: float,
    now: datetime | None = None,
    name: str = "table",
) -> DataFrame:
    """Is the newest timestamp recent enough?

    An empty table, or a timestamp later than ``now``, fails.
    """
    newest = df.agg(F.max(F.col(ts_col).cast("timestamp")).alias("newest"))
    age = (F.unix_micros(clock(now)) - F.unix_micros("newest")) / F.lit(3.6e9)
    age = F.coalesce(age, F.lit(-1.0))
    return newest.select(
        _result(
            "data_freshness",
            name,
            columns=[ts_col],
            metric=age,
            threshold=float(max_age_hours),
            passed=(age >= 0) & (age <= max_age_hours),
            details={"max_timestamp": F.col("newest")},
            now=now,
        )
    )


def min_rows(
    df: DataFrame, n: int = 1, name: str = "table", now: datetime | None = None
) -> DataFrame:
    """Does the table have at least ``n`` rows?  ``metric`` is their number."""
    counted = df.agg(F.count("*").alias("rows"))
    return counted.select(
        _result(
            "min_rows",
            name,
            metric=F.col("rows"),
            threshold=float(n),
            passed=F.col("rows") >= n,
            now=now,
        )
    )


def flag_counts(df: DataFrame) -> DataFrame:
    flag = F.col("data_quality_flag")
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(flag == "PASSED").alias("passed_rows"),
        F.count_if(flag == "FAILED").alias("failed_rows"),
    )


def quality_flag_rate(
    df: DataFrame,
    min_pct: float = MIN_FLAG_RATE,
    name: str = "table",
    now: datetime | None = None,
) -> DataFrame:
    """Do enough rows carry the PASSED flag?  Tables without the flag pass."""
    if "data_quality_flag" not in df.columns:
        return df.sparkSession.range(1).select(
            _result(
                "quality_flag_rate",
                name,
                threshold=min_pct,
                passed=F.lit(True),
                details={"note": F.lit("no data_quality_flag column")},
                now=now,
            )
        )
    pct = percent(F.col("passed_rows"), F.col("total"))
    return flag_counts(df).select(
        _result(
            "quality_flag_rate",
            name,
            columns=["data_quality_flag"],
            metric=pct,
            threshold=min_pct,
            passed=pct >= min_pct,
            details={"passed": F.col("passed_rows"), "failed": F.col("failed_rows")},
            now=now,
        )
    )


def retention(
    bronze: DataFrame,
    silver: DataFrame,
    names: tuple[str, str] = ("bronze", "silver"),
    now: datetime | None = None,
) -> DataFrame:
    """Share of bronze rows that reached silver, with a band; no row for an empty bronze."""
    pct = percent(F.col("t"), F.col("s"))
    band = (
        F.when(pct >= GOOD_RETENTION, "Good")
        .when(pct >= MODERATE_RETENTION, "Moderate")
        .otherwise("Low")
    )
    return (
        _two_counts(bronze, silver)
        .where(F.col("s") > 0)
        .select(
            _result(
                "retention",
                names[0],
                names[1],
                metric=pct,
                threshold=MODERATE_RETENTION,
                passed=pct >= MODERATE_RETENTION,
                details={
                    "band": band,
                    "source_count": F.col("s"),
                    "target_count": F.col("t"),
                },
                now=now,
            )
        )
    )


def gold_presence(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], now: datetime | None = None
) -> DataFrame:
    """Does every named table exist with at least one row?  None stands for a missing one."""
    parts = []
    for name, df in tables.items():
        if df is not None:
            parts.append(min_rows(df, 1, name, now))
            continue
        parts.append(
            spark.range(1).select(
                _result(
                    "min_rows",
                    name,
                    threshold=1.0,
                    passed=F.lit(False),
                    details={"error": F.lit("table not found")},
                    now=now,
                )
            )
        )
    return reduce(DataFrame.unionByName, parts, empty_results(spark))


def suite(
    bronze: DataFrame,
    silver: DataFrame,
    keys: Sequence[str],
    null_limits: Mapping[str, float] | None = None,
    names: tuple[str, str] = ("bronze", "silver"),
    ts_col: str = "_ingestion_timestamp",
    row_tolerance_pct: float = 5.0,
    max_age_hours: float = 24.0,
    excluded: Sequence[str] = SILVER_ADDED_COLUMNS,
    now: datetime | None = None,
) -> DataFrame:
    """The five cross-layer checks as one frame.

    Three of them read the silver rows, which may be costly to make: the columns they use
    are written once.
    """
    limits = null_limits or {}
    kept = written(silver.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*keys, *limits]))), "suite")
    return reduce(
        DataFrame.unionByName,
        [
            row_counts(bronze, kept, row_tolerance_pct, names, now),
            schema_consistency(bronze, silver, excluded, names, now),
            null_pct(kept, limits, names[1], now),
            duplicates(kept, keys, 0.0, names[1], now),
            freshness(bronze, ts_col, max_age_hours, now, names[0]),
        ],
    )


def recent_results(results: DataFrame, n: int = 20) -> DataFrame:
    return results.orderBy(F.desc("checked_at"), "check_type", "table_name", "target").limit(n)
