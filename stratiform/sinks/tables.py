"""Writing catalog tables.

``location`` makes a table external; leave it out for a managed one.  A rewrite keeps
a table's partition columns and its kind.  Rewritten rows of an external table go to a
folder ``version-...`` below its location; folders of earlier versions are left to the
caller, whose readers may still be at work in them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from stratiform.operators.enrich import checked_broadcast
from stratiform.operators.layout import analyze_table, even_partitions, zorder
from stratiform.operators.merge import upsert
from stratiform.session import reliable_checkpoint
from stratiform.sinks.rewrite import compact_files, merge_files

# The folder of one version of an external table's rows.
_VERSION = re.compile("/version-[0-9a-f]{12}$")

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _writer(
    df: DataFrame, mode: str, partition_by: Sequence[str], location: str | None
) -> DataFrameWriter:
    if partition_by:
        df = even_partitions(df, partition_by)
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("path", location) if location else writer


def append_or_create(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), location: str | None = None
) -> None:
    """Append to the table, or create it from the frame's schema."""
    exists = df.sparkSession.catalog.tableExists(table)
    mode = "append" if exists else "overwrite"
    _writer(df, mode, partition_by, None if exists else location).saveAsTable(table)


def overwrite_table(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), location: str | None = None
) -> None:
    """Replace the rows and the schema of the table."""
    _writer(df, "overwrite", partition_by, location).saveAsTable(table)


def create_or_merge(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    merge_mode: bool = True,
    location: str | None = None,
) -> None:
    """Upsert into an existing table, or write it anew.

    If the keys include the partition columns, a row and its successor lie in the
    same partition, and only the partitions the source touches are rewritten.
    Otherwise only the files that hold a matched key are.  If the table is to get other
    partition columns or another location, the merged rows go to a staging table, which
    then takes the name over: the old rows stay readable until the new ones are complete.
    """
    if not (merge_mode and df.sparkSession.catalog.tableExists(table)):
        overwrite_table(df, table, partition_by, location)
    elif own := _partitions_in_keys(df.sparkSession, table, keys):
        _merge_partitions(df, table, keys, own)
    elif _keeps_layout(df.sparkSession, table, partition_by, location):
        _merge_files(df, table, keys)
    else:
        _merge_table(df, table, keys, partition_by, location)


def _partitions_in_keys(spark: SparkSession, table: str, keys: Sequence[str]) -> list[str]:
    """The table's partition columns, if it has any and the keys include them all."""
    own = _own_partitions(spark, table)
    return own if set(own) <= set(keys) else []


def _own_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first().data_type.rstrip("/")


def _own_partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _keeps_layout(
    spark: SparkSession, table: str, partition_by: Sequence[str], location: str | None
) -> bool:
    """Whether a table's own folder and partition columns are the ones asked for."""
    if partition_by and list(partition_by) != _own_partitions(spark, table):
        return False
    bare = _VERSION.sub("", _own_location(spark, table)).removeprefix("file:")
    return location is None or bare == location.rstrip("/").removeprefix("file:")


def _after_rewrite(spark: SparkSession, table: str) -> None:
    if _own_partitions(spark, table):
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def _merge_files(df: DataFrame, table: str, keys: Sequence[str]) -> None:
    spark = df.sparkSession
    parts = _own_partitions(spark, table)
    merge_files(spark, _own_location(spark, table), df, keys, table=spark.table(table), partition_by=parts)
    _after_rewrite(spark, table)


def _merge_table(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    location: str | None,
) -> None:
    spark = df.sparkSession
    staging = _staging_name(table)
    partition_by, location = _layout(spark, table, partition_by, location)
    merged = upsert(spark.table(table), df, keys)
    overwrite_table(merged, staging, partition_by, location)
    _take_over(spark, staging, table)


def _layout(
    spark: SparkSession, table: str, partition_by: Sequence[str], location: str | None
) -> tuple[Sequence[str], str | None]:
    """Partition columns and folder for new rows of a table, as the table has them now.

    The rows of an external table go to a fresh folder below its location, never over
    the files that are being read.
    """
    columns = spark.catalog.listColumns(table)
    if not partition_by:
        partition_by = [c.name for c in columns if c.isPartition]
    if spark.catalog.getTable(table).tableType == "EXTERNAL" or location:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
        base = location or described.first().data_type
        location = f"{_VERSION.sub('', base.rstrip('/'))}/version-{uuid.uuid4().hex[:12]}"
    return partition_by, location


def _staging_name(table: str) -> str:
    return f"{table}_staging_{uuid.uuid4().hex[:12]}"


def _take_over(spark: SparkSession, staging: str, table: str) -> None:
    """Give a finished table the name of the one it replaces."""
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        # Renaming may move the folders, but not every catalog moves its partitions along.
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


def _merge_partitions(
    df: DataFrame, table: str, keys: Sequence[str], partition_by: Sequence[str]
) -> None:
    """Rewrite the touched partitions, from a copy that is complete before they go."""
    spark = df.sparkSession
    target = spark.table(table)
    touched = reliable_checkpoint(df.select(*partition_by).distinct())
    scope = target.join(checked_broadcast(touched), list(partition_by), "left_semi")
    unnamed = reduce(or_, [F.col(c).isNull() for c in partition_by])
    if not touched.where(unnamed).isEmpty():
        scope = scope.unionByName(target.where(unnamed))
    merged = reliable_checkpoint(upsert(scope.select(*target.columns), df, keys))
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        even_partitions(merged, partition_by).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def append_results(results: DataFrame, table: str, location: str | None = None) -> None:
    """Keep check results as history."""
    append_or_create(results.coalesce(1), table, location=location)


def write_gold(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
    location: str | None = None,
) -> None:
    """Write an aggregate, cluster it if asked to, and store its statistics."""
    if cluster_by:
        df = zorder(df, cluster_by, within=partition_by)
    else:
        df = even_partitions(df, partition_by)
    writer = df.write.format("parquet").mode(mode).partitionBy(*partition_by)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)
    analyze_table(df.sparkSession, table)


def optimize_table(
    spark: SparkSession,
    table: str,
    cluster_by: Sequence[str] = (),
    where: str | None = None,
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Rewrite a table with evenly sized files, clustered if asked to.

    ``where`` restricts the work to files that hold such rows, where the table keeps its
    layout: their small ones are merged, or all of them clustered, and other files are
    not touched.  Statistics are stored afterwards.
    """
    df = spark.table(table)
    if where is not None and _keeps_layout(spark, table, partition_by, location):
        compact_files(spark, _own_location(spark, table), where, cluster_by=cluster_by, table=df)
        _after_rewrite(spark, table)
        analyze_table(spark, table)
        return
    partition_by, location = _layout(spark, table, partition_by, location)
    chosen = F.lit(True) if where is None else F.coalesce(F.expr(where), F.lit(False))
    rows = df.where(chosen)
    if cluster_by:
        rows = zorder(rows, cluster_by, within=partition_by)
    else:
        rows = even_partitions(rows, partition_by)
    if where is not None:
        rows = rows.unionByName(df.where(~chosen))
    staging = _staging_name(table)
    writer = rows.write.format("parquet").partitionBy(*partition_by)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(staging)
    _take_over(spark, staging, table)
    analyze_table(spark, table)
