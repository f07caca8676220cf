"""The tables behind the reports and dashboards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.operators.cleansing import business_columns
from stratiform.operators.quality import flag_counts, key_counts, percent
from stratiform.operators.rollup import mean
from stratiform.session import local_frame, written

# Bands of the NULL report, in percent.
LOW_NULLS = 5.0
MEDIUM_NULLS = 20.0

# Completeness above which a record counts as high quality; histogram bins.
HIGH_COMPLETENESS = 0.95
HISTOGRAM_BINS = 20

SAMPLE_FRACTION = 0.05
SAMPLE_SEED = 7


def od_avg_fare(df: DataFrame) -> DataFrame:
    """Mean fare by origin and destination zone."""
    return df.groupBy("pickup_zone", "dropoff_zone").agg(mean("fare_amount").alias("avg_fare"))


def od_pivot(df: DataFrame, destinations: Sequence[str]) -> DataFrame:
    """Mean fare as a matrix: a row per origin and a column per listed destination."""
    return (
        od_avg_fare(df)
        .groupBy("pickup_zone")
        .pivot("dropoff_zone", list(destinations))
        .agg(F.first("avg_fare"))
    )


def trips_by_zone_month(zone_monthly: DataFrame) -> DataFrame:
    month = F.make_date("year", "month", F.lit(1)).alias("year_month")
    return zone_monthly.groupBy("pickup_zone", month).agg(F.sum("trips").alias("trips"))


def revenue_by_month(zone_monthly: DataFrame) -> DataFrame:
    month = F.make_date("year", "month", F.lit(1)).alias("year_month")
    return zone_monthly.groupBy(month).agg(F.sum("revenue").alias("revenue"))


def bernoulli_sample(
    df: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    seed: int = SAMPLE_SEED,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Each row with probability ``fraction``, decided by a hash of its ``keys`` (all columns).

    The same rows are taken however the frame is partitioned or recomputed, which a
    random generator per task cannot promise.  Rows with equal keys share their fate.
    """
    names = df.columns if keys is None else keys
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    return df.where(draw < F.lit(round(fraction * 2**52)))


def trips_by_dow(df: DataFrame, date_col: str = "pickup_datetime") -> DataFrame:
    """Rows per weekday, Monday being 0."""
    return df.groupBy(F.weekday(date_col).alias("dow")).agg(F.count("*").alias("trips"))


def volume_trend(df: DataFrame, date_col: str) -> DataFrame:
    return (
        df.groupBy(F.to_date(date_col).alias("date"))
        .agg(F.count("*").alias("record_count"))
        .orderBy("date")
    )


def ingestion_volume(df: DataFrame, ts_col: str = "_ingestion_timestamp") -> DataFrame:
    """Records per day, the day as text."""
    return (
        df.groupBy(F.date_format(ts_col, "yyyy-MM-dd").alias("date"))
        .agg(F.count("*").alias("records_ingested"))
        .orderBy("date")
    )


def ingestion_volume_stats(volume: DataFrame) -> DataFrame:
    n = "records_ingested"
    return volume.agg(
        F.sum(n).alias("total_records"),
        F.avg(n).alias("avg_daily"),
        F.max(n).alias("max_daily"),
        F.min(n).alias("min_daily"),
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column with a low/medium/high band, fewest first.

    Metadata columns are left out unless named.  An empty table gives no rows.
    """
    columns = business_columns(df) if columns is None else list(columns)
    totals = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(columns)],
    ).where(F.col("total") > 0)
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("null_count"))
            for i, c in enumerate(columns)
        ]
    )
    pct = percent(F.col("null_count"), F.col("total"))
    band = F.when(pct < LOW_NULLS, "low").when(pct < MEDIUM_NULLS, "medium").otherwise("high")
    return (
        totals.select("total", F.inline(cells))
        .select("column_name", "null_count", pct.alias("null_pct"), band.alias("band"))
        .orderBy("null_pct", "column_name")
    )


def layer_counts(spark: SparkSession, layers: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per layer; a missing layer (None) counts 0."""

    def counted(name: str, df: DataFrame | None) -> DataFrame:
        if df is None:
            return spark.range(1).select(
                F.lit(name).alias("layer"), F.lit(0).cast("long").alias("record_count")
            )
        return df.agg(F.count("*").alias("record_count")).select(
            F.lit(name).alias("layer"), "record_count"
        )

    return reduce(DataFrame.unionByName, [counted(n, d) for n, d in layers.items()])


def completeness_stats(df: DataFrame, score: str = "_completeness_score") -> DataFrame:
    high = F.count_if(F.col(score) >= HIGH_COMPLETENESS)
    return df.agg(
        F.avg(score).alias("avg_completeness"),
        F.min(score).alias("min_completeness"),
        F.max(score).alias("max_completeness"),
        high.alias("high_quality_records"),
        F.count("*").alias("total_records"),
        percent(high, F.count("*")).alias("high_quality_pct"),
    )


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Frequencies in equal-width bins from the least to the greatest value.

    Bins are closed on the left, the last one on both sides; empty bins are kept.
    If all values are equal they fall into the first bin.  ``mean_value`` repeats
    the mean of the column.
    """
    # The range first, then the counts: two scans of the one column, and no shuffle of values.
    df = written(df.select(F.col(f"`{column}`").cast("double").alias("x")), "histogram")
    x = F.col("x")
    stats = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.avg(x).alias("mean")).first()
    lo, hi = F.lit(stats.lo).cast("double"), F.lit(stats.hi).cast("double")
    width = (hi - lo) / F.lit(float(bins))
    slot = F.floor(F.try_divide(x - lo, hi - lo) * F.lit(float(bins)))
    counted = (
        df.where(x.isNotNull())
        .groupBy(F.least(F.coalesce(slot, F.lit(0)), F.lit(bins - 1)).alias("bin"))
        .agg(F.count("*").alias("frequency"))
    )
    frame = local_frame(df.sparkSession, [(i,) for i in range(bins)], "bin bigint")
    return frame.join(counted, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_from"),
        (lo + (F.col("bin") + 1) * width).alias("bin_to"),
        F.coalesce("frequency", F.lit(0)).alias("frequency"),
        F.lit(stats.mean).cast("double").alias("mean_value"),
    )


def metric_series(gold: DataFrame, date_col: str, metric: str) -> DataFrame:
    return gold.select(date_col, metric).orderBy(date_col)


def month_label() -> Column:
    """``yyyy-MM`` from the year and month columns of a monthly aggregate."""
    return F.format_string("%d-%02d", "agg_year", "agg_month")


def monthly_records(gold: DataFrame) -> DataFrame:
    return gold.select(month_label().alias("month_label"), "record_count").orderBy("month_label")


def _valid_pct(df: DataFrame) -> Column:
    """Percent of valid rows as an aggregate; 100 for tables that do not track it."""
    if "_is_valid" not in df.columns:
        return F.lit(100.0)
    return percent(F.count_if(F.col("_is_valid")), F.count("*"))


def valid_pct(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("record_count"), _valid_pct(df).alias("valid_pct"))


def quality_rate(df: DataFrame) -> DataFrame:
    """Rows that passed and failed, and the share that passed."""
    return flag_counts(df).select(
        "passed_rows",
        "failed_rows",
        percent(F.col("passed_rows"), F.col("total")).alias("passed_pct"),
    )


def dedup_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What keeping one row per key removes, without building the result."""
    removed = F.col("total") - F.col("distinct_keys")
    return key_counts(df, keys).select(
        F.col("total").alias("rows_before"),
        F.col("distinct_keys").alias("rows_after"),
        removed.alias("rows_removed"),
        percent(removed, F.col("total")).alias("removed_pct"),
    )


def dashboard(layers: Mapping[str, DataFrame], columns: Mapping[str, int] | None = None) -> DataFrame:
    """Rows, columns and valid share per layer, each from one scan.

    ``columns`` tells how many a layer has whose frame holds only those that are used.
    """
    widths = columns or {}
    parts = [
        df.agg(F.count("*").alias("record_count"), _valid_pct(df).alias("valid_pct")).select(
            F.lit(name).alias("layer"),
            "record_count",
            F.lit(widths.get(name, len(df.columns))).cast("long").alias("column_count"),
            "valid_pct",
        )
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def table_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    return dashboard(tables).select(
        F.col("layer").alias("table_name"), "record_count", "column_count"
    )


def most_recent(df: DataFrame, date_col: str, n: int = 10) -> DataFrame:
    """The ``n`` newest rows; rows of one date are ordered by their other columns."""
    others = [f.name for f in df.schema if f.name != date_col and not isinstance(f.dataType, T.MapType)]
    return df.orderBy(F.desc(date_col), *(F.col(f"`{c}`") for c in others)).limit(n)
