"""Row-level cleansing: text, missing values, validity and completeness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.config import NULL_TOKENS
from stratiform.functions.audit import clock


def business_columns(df: DataFrame) -> list[str]:
    """Columns that carry data; a leading underscore marks metadata."""
    return [c for c in df.columns if not c.startswith("_")]


def standardize_strings(
    df: DataFrame, columns: Sequence[str], case: str | None = "upper"
) -> DataFrame:
    """Trim the columns, then change their case (``upper``, ``lower`` or None)."""
    to_case = {"upper": F.upper, "lower": F.lower, None: lambda c: c}[case]
    return df.withColumns({c: to_case(F.trim(F.col(c))) for c in columns})


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Turn text that spells "no value" into NULL.

    The match is exact: padded or differently cased spellings stay.
    """
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns(
        {c: F.when(~F.col(c).isin(*tokens), F.col(c)) for c in text}
    )


def handle_nulls(df: DataFrame, rules: Mapping[str, Any]) -> DataFrame:
    """Drop rows or fill values where a column is NULL.

    A rule is ``"drop"`` or the value to fill in, which takes the column's type.
    """
    required = [c for c, rule in rules.items() if rule == "drop"]
    for c in required:
        df = df.where(F.col(c).isNotNull())
    fills = {
        c: F.coalesce(F.col(c), F.lit(rule).cast(df.schema[c].dataType))
        for c, rule in rules.items()
        if rule != "drop"
    }
    return df.withColumns(fills) if fills else df


def quality_flag(df: DataFrame, key: str, date: str) -> DataFrame:
    """Mark rows FAILED that lack their key or their date, the others PASSED."""
    missing = F.col(key).isNull() | F.col(date).isNull()
    return df.withColumn(
        "data_quality_flag", F.when(missing, "FAILED").otherwise("PASSED")
    )


def passed_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("data_quality_flag") == "PASSED")


def validity_columns(
    df: DataFrame, rules: Mapping[str, str | Column] | None = None, now=None
) -> DataFrame:
    """Add ``_is_valid``, the names of broken rules, and the processing time.

    A rule holds only where it is true, so a NULL outcome breaks it.  Without
    rules every row is valid.
    """
    broken = [
        F.when(~F.coalesce(F.expr(r) if isinstance(r, str) else r, F.lit(False)), name)
        for name, r in (rules or {}).items()
    ]
    errors = F.nullif(F.concat_ws(";", *broken), F.lit("")) if broken else F.lit(None)
    errors = errors.cast("string")
    return df.select(
        "*",
        errors.isNull().alias("_is_valid"),
        errors.alias("_validation_errors"),
        clock(now).alias("_silver_processed_timestamp"),
    )


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add the number of NULL business columns of a row and the share that is filled."""
    columns = business_columns(df) if columns is None else list(columns)
    if not columns:
        raise ValueError("completeness needs at least one business column")
    missing = reduce(add, [F.col(f"`{c}`").isNull().cast("int") for c in columns])
    return df.select(
        "*",
        missing.alias("_null_column_count"),
        (F.lit(1) - missing / F.lit(len(columns))).alias("_completeness_score"),
    )
