"""Describing an unknown dataset: columns, keys, dates, roles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.config import ColumnRoles
from stratiform.operators.quality import percent
from stratiform.session import local_frame

# What makes a column a candidate key or a clustering column.
KEY_MAX_NULL_PCT = 5.0
KEY_MIN_CARDINALITY_PCT = 80.0
CLUSTER_MIN_DISTINCT = 10
CLUSTER_MAX_DISTINCT = 1000

# Words in column names that hint at a role, and type names.
KEY_WORDS = ("id", "key")
DATE_TYPE_WORDS = ("timestamp", "date")
DATE_WORDS = ("time", "date")
METRIC_WORDS = ("amount", "fare", "tip", "total", "distance", "count")
NUMBER_TYPES = ("int", "bigint", "long", "double", "float", "decimal")
TEXT_TYPES = ("string", "varchar")

_LONG_TEXT = 64

# JSON that tells all values apart; by default it cuts times to milliseconds.
LOSSLESS_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}
_COLUMN_LIST = "position int, column_name string, data_type string"


def _group_key(field: T.StructField) -> Column:
    """A value that is equal exactly when the column's values are, and cheap to shuffle.

    Long text is replaced by its SHA-256 digest with a marker in front, which is
    longer than any text kept as it is, so the two cannot be confused.
    """
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BinaryType):
        col = F.hex(col)
    elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
        col = F.to_json(col, LOSSLESS_JSON)
    elif not isinstance(field.dataType, (T.StringType, T.VarcharType, T.CharType)):
        return col
    digest = F.concat(F.lit("#"), F.sha2(col.cast("binary"), 256))
    return F.when(F.length(col) > _LONG_TEXT, digest).otherwise(col)


_WHOLE = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)

# Types whose values are whole numbers once shuffled, and about what one costs then.
_BITMAPPED = (*_WHOLE, T.DateType, T.TimestampType)
_BITMAP_BYTES = 4096
_CELL_BYTES = 24


def _cell(field: T.StructField) -> tuple[Column, Column, Column]:
    """The value as one of a whole number, a floating number or text."""
    whole = F.lit(None).cast("bigint")
    floating = F.lit(None).cast("double")
    text = F.lit(None).cast("string")
    key, kind = _group_key(field), field.dataType
    if isinstance(kind, _WHOLE):
        whole = key.cast("bigint")
    elif isinstance(kind, T.DateType):
        whole = F.unix_date(key).cast("bigint")
    elif isinstance(kind, T.TimestampType):
        whole = F.unix_micros(key)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        floating = key.cast("double")
    else:
        text = key.cast("string")
    return whole, floating, text


def _fields(df: DataFrame, columns: Sequence[str] | None) -> list[T.StructField]:
    return [f for f in df.schema if columns is None or f.name in columns]


def _described(df: DataFrame, fields: Sequence[T.StructField], numbers: DataFrame) -> DataFrame:
    """Put name, type and position next to per-column numbers; empty tables get zeros."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)]
    listed = local_frame(df.sparkSession, rows, _COLUMN_LIST)
    joined = listed.join(numbers, "position", "left").fillna(
        0, ["total_rows", "null_count", "distinct_count"]
    )
    total = F.col("total_rows")
    return joined.select(
        "position",
        "column_name",
        "data_type",
        "total_rows",
        "null_count",
        percent(F.col("null_count"), total).alias("null_pct"),
        "distinct_count",
        percent(F.col("distinct_count"), total).alias("cardinality_pct"),
    )


def bitmap_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Whole-number, date and time columns whose values are cheaper to shuffle as bitmaps.

    Sketches tell for each input partition how many values it would send one by one, and
    how many bitmaps.  One scan of these columns; no value is shuffled.
    """
    fields = [f for f in _fields(df, columns) if isinstance(f.dataType, _BITMAPPED)]
    if not fields:
        return []
    values = [_cell(f)[0] for f in fields]
    by_task = df.groupBy(F.spark_partition_id().alias("task")).agg(
        *(F.approx_count_distinct(v).alias(f"_v{i}") for i, v in enumerate(values)),
        *(F.approx_count_distinct(F.bitmap_bucket_number(v)).alias(f"_b{i}") for i, v in enumerate(values)),
    )
    cheaper = [
        F.coalesce(F.sum(f"_b{i}") * _BITMAP_BYTES < F.sum(f"_v{i}") * _CELL_BYTES, F.lit(False)).alias(f"_{i}")
        for i in range(len(fields))
    ]
    return [f.name for f, yes in zip(fields, by_task.agg(*cheaper).first(), strict=True) if yes]


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    approx: bool = False,
    bitmaps: Sequence[str] = (),
) -> DataFrame:
    """Type, NULLs and distinct values of every column; NULL is one distinct value.

    One scan serves all columns.  Exact counting turns the table into
    (column, value) cells and counts those, first within each map task: a value
    that fills a third of a column travels once per task.  ``approx`` counts with
    a sketch and shuffles no values at all, which suits wide tables of mostly
    distinct values.  Columns named in ``bitmaps`` (see ``bitmap_columns``) are counted
    exactly too, in a scan of theirs, but 32,768 neighbouring values share a row of 4 KB.
    """
    fields = _fields(df, columns)
    if approx:
        return _described(df, fields, _approximate(df, fields))
    placed = list(enumerate(fields))
    dense = [(i, f) for i, f in placed if f.name in bitmaps]
    unfit = [f.name for _, f in dense if not isinstance(f.dataType, _BITMAPPED)]
    if unfit:
        raise ValueError(f"not whole numbers, dates or times: {unfit}")
    others = [(i, f) for i, f in placed if f.name not in bitmaps]
    counted = [count(df, some) for count, some in ((_exact, others), (_by_bitmaps, dense)) if some]
    return _described(df, fields, reduce(DataFrame.unionByName, counted))


def _by_bitmaps(df: DataFrame, placed: Sequence[tuple[int, T.StructField]]) -> DataFrame:
    parts = [x for i, f in placed for x in (F.lit(i), _cell(f)[0])]
    cells = df.select(F.stack(F.lit(len(placed)), *parts).alias("position", "whole"))
    return (
        cells.groupBy("position", F.bitmap_bucket_number("whole").alias("stretch"))
        .agg(
            F.count("*").alias("n"),
            F.count("whole").alias("held"),
            F.bitmap_construct_agg(F.bitmap_bit_position("whole")).alias("bits"),
        )
        .groupBy("position")
        .agg(
            F.sum("n").alias("total_rows"),
            F.sum(F.col("n") - F.col("held")).alias("null_count"),
            F.sum(F.when(F.col("held") > 0, F.bitmap_count("bits")).otherwise(1)).alias("distinct_count"),
        )
    )


def _exact(df: DataFrame, placed: Sequence[tuple[int, T.StructField]]) -> DataFrame:
    parts = [x for i, f in placed for x in (F.lit(i), *_cell(f))]
    value = ("whole", "floating", "text")
    cells = df.select(F.stack(F.lit(len(placed)), *parts).alias("position", *value))
    missing = reduce(and_, [F.col(v).isNull() for v in value])
    return (
        cells.groupBy("position", *value)
        .agg(F.count("*").alias("n"))
        .groupBy("position")
        .agg(
            F.sum("n").alias("total_rows"),
            F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("null_count"),
            F.count("*").alias("distinct_count"),
        )
    )


def _approximate(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    parts = [F.count("*").alias("total_rows")]
    for i, f in enumerate(fields):
        parts += [
            F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_n{i}"),
            F.approx_count_distinct(_group_key(f)).alias(f"_d{i}"),
        ]
    per_column = [
        F.struct(
            F.lit(i).alias("position"),
            F.col(f"_n{i}").alias("null_count"),
            (F.col(f"_d{i}") + F.when(F.col(f"_n{i}") > 0, 1).otherwise(0)).alias(
                "distinct_count"
            ),
        )
        for i, f in enumerate(fields)
    ]
    return df.agg(*parts).select("total_rows", F.inline(F.array(*per_column)))


def exact_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows, and the rows beyond the first of each kind."""
    keys = [_group_key(f).alias(f.name) for f in _fields(df, columns)]
    counted = (
        df.select(keys)
        .groupBy(*[f"`{f.name}`" for f in _fields(df, columns)])
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total_rows"),
            F.count("*").alias("distinct_rows"),
        )
    )
    extra = F.col("total_rows") - F.col("distinct_rows")
    return counted.select(
        "*",
        extra.alias("duplicate_rows"),
        percent(extra, F.col("total_rows")).alias("duplicate_pct"),
    )


def candidate_keys(profiled: DataFrame) -> DataFrame:
    """Columns with few NULLs and mostly distinct values."""
    return profiled.where(
        (F.col("null_pct") < KEY_MAX_NULL_PCT)
        & (F.col("cardinality_pct") > KEY_MIN_CARDINALITY_PCT)
    )


def cluster_candidates(profiled: DataFrame) -> DataFrame:
    """Columns with enough, but not too many, distinct values to cluster by."""
    n = F.col("distinct_count")
    return profiled.where((n > CLUSTER_MIN_DISTINCT) & (n < CLUSTER_MAX_DISTINCT))


def date_ranges(df: DataFrame) -> DataFrame:
    """First and last value of every date-like column; the first one is recommended
    for partitioning."""
    dated = [(c, t) for c, t in df.dtypes if any(w in t for w in DATE_TYPE_WORDS)]
    schema = "column_name string, data_type string, min_value string, max_value string, partition_by boolean"
    if not dated:
        return local_frame(df.sparkSession, [], schema)
    bounds = df.agg(
        *[F.min(f"`{c}`").alias(f"_lo{i}") for i, (c, _) in enumerate(dated)],
        *[F.max(f"`{c}`").alias(f"_hi{i}") for i, (c, _) in enumerate(dated)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(t).alias("data_type"),
            F.col(f"_lo{i}").cast("string").alias("min_value"),
            F.col(f"_hi{i}").cast("string").alias("max_value"),
            F.lit(i == 0).alias("partition_by"),
        )
        for i, (c, t) in enumerate(dated)
    ]
    return bounds.select(F.inline(F.array(*rows)))


def _mentions(text: Column, words: Sequence[str]) -> Column:
    return text.rlike("|".join(words))


def with_role(columns: DataFrame) -> DataFrame:
    """Add the likely ``role`` of each described column, from its name and type.

    Types outside the plain numeric and text ones get no role.
    """
    name = F.lower("column_name")
    kind = F.lower("data_type")
    number_role = F.when(_mentions(name, METRIC_WORDS), "metric").otherwise("dimension")
    role = (
        F.when(_mentions(name, KEY_WORDS), "key")
        .when(_mentions(kind, DATE_TYPE_WORDS) | _mentions(name, DATE_WORDS), "date")
        .when(kind.isin(*NUMBER_TYPES), number_role)
        .when(kind.isin(*TEXT_TYPES), "dimension")
    )
    return columns.withColumn("role", role)


def classify_columns(df: DataFrame) -> DataFrame:
    """Name, type and role of every column, from the schema alone."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return with_role(local_frame(df.sparkSession, rows, _COLUMN_LIST))


def suggest_roles(df: DataFrame) -> ColumnRoles:
    """The classification as settings to start from; reads no data."""
    by_role: dict[str | None, list[str]] = {}
    for row in classify_columns(df).orderBy("position").collect():
        by_role.setdefault(row.role, []).append(row.column_name)
    return ColumnRoles(
        keys=by_role.get("key", []),
        dates=by_role.get("date", []),
        metrics=by_role.get("metric", []),
        dimensions=by_role.get("dimension", []),
    )
