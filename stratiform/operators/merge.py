"""Combining a table with newer versions of its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.session import reliable_checkpoint


class AmbiguousMatch(ValueError):
    """Several source rows want to update the same target row."""


class RepeatedKey(ValueError):
    """A frame that should hold each key once holds one twice."""


def check_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise when two rows share a complete key; runs one aggregate over the keys."""
    named = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("_n"))
    hit = named.where(F.col("_n") > 1).drop("_n").take(1)
    if hit:
        raise RepeatedKey(f"{what} repeats key {hit[0].asDict()}")


def check_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a target row has more than one source row; runs a job."""
    repeated = (
        source.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
        .drop("_n")
    )
    if not repeated.take(1):
        return
    hit = target.select(*keys).join(repeated, list(keys), "left_semi").take(1)
    if hit:
        raise AmbiguousMatch(f"source repeats key {hit[0].asDict()}, which the target holds")


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], check: bool = True
) -> DataFrame:
    """Rows of ``source``, and those of ``target`` whose keys it does not bring.

    NULL keys match nothing, so such source rows are inserted and such target
    rows stay.  A checked source is kept in the shared folder first: the check and both
    uses see the same rows, whatever it is computed from.
    """
    if check:
        source = reliable_checkpoint(source.select(*target.columns))
        check_single_match(target, source, keys)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def _differs(columns: Sequence[str], left: str, right: str) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return ~same


def _lacks_key(df: DataFrame, keys: Sequence[str]) -> Column:
    """Whether a row has no complete key; constant where the schema rules that out."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | (F.col(k).isNull() if df.schema[k].nullable else F.lit(False))
    return missing


def _versions(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join of two keyed frames as struct columns ``old`` and ``new``.

    Rows without a key match nothing.  They go around the join, because a full
    join would gather them all in one task.
    """
    left = old.select(*keys, F.struct("*").alias("old"))
    right = new.select(*keys, F.struct("*").alias("new"))
    no_left, no_right = _lacks_key(old, keys), _lacks_key(new, keys)
    paired = left.where(~no_left).join(right.where(~no_right), list(keys), "full")
    old_only = left.where(no_left).withColumn("new", F.lit(None).cast(right.schema["new"].dataType))
    new_only = right.where(no_right).withColumn("old", F.lit(None).cast(left.schema["old"].dataType))
    return paired.unionByName(old_only).unionByName(new_only)


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows inserted, updated or deleted between two snapshots, with ``change_type``.

    Deleted rows carry their old values, the others their new ones.  Either snapshot
    holds a key once; a repeated one raises, for it would pair with all its namesakes.
    """
    check_unique(old, keys, "the old snapshot")
    check_unique(new, keys, "the new snapshot")
    columns = [c for c in new.columns if c not in keys] if columns is None else list(columns)
    change = (
        F.when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull(), "delete")
        .when(_differs(columns, "old", "new"), "update")
    )
    return (
        _versions(old, new, keys)
        .select(*keys, F.coalesce("new", "old").alias("row"), change.alias("change_type"))
        .where(F.col("change_type").isNotNull())
        .select(*keys, *[F.col(f"row.{c}").alias(c) for c in columns], "change_type")
    )


def scd2(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: Column,
) -> DataFrame:
    """Type-2 history after a new snapshot.

    ``history`` has the keys, the tracked columns and ``valid_from``, ``valid_to``
    and ``is_current``.  A changed row is closed and reopened with its new values,
    an unknown key opens a row, and a key missing from the snapshot stays open.  The
    snapshot holds a key once, and the history one open row of it; otherwise this raises,
    for repeated rows would pair with all their namesakes.  NULL keys match nothing.
    """
    check_unique(history.where("is_current"), keys, "the open rows of the history")
    check_unique(snapshot, keys, "the snapshot")
    columns = [*keys, *tracked, "valid_from", "valid_to", "is_current"]
    closed = history.where(~F.col("is_current")).select(*columns)
    current = history.where("is_current").select(*keys, *tracked, "valid_from")
    paired = _versions(current, snapshot.select(*keys, *tracked), keys)

    def row(side: str, start: Column, end: Column, is_current: bool) -> Column:
        return F.struct(
            *[F.col(k) for k in keys],
            *[F.col(f"{side}.{c}").alias(c) for c in tracked],
            start.alias("valid_from"),
            end.alias("valid_to"),
            F.lit(is_current).alias("is_current"),
        )

    until = history.schema["valid_to"].dataType
    start = as_of.cast(history.schema["valid_from"].dataType)
    never = F.lit(None).cast(until)
    opened = row("new", start, never, True)
    kept = row("old", F.col("old.valid_from"), never, True)
    ended = row("old", F.col("old.valid_from"), as_of.cast(until), False)
    versions = (
        F.when(F.col("old").isNull(), F.array(opened))
        .when(F.col("new").isNull(), F.array(kept))
        .when(_differs(tracked, "old", "new"), F.array(ended, opened))
        .otherwise(F.array(kept))
    )
    return closed.unionByName(paired.select(F.inline(versions)))
