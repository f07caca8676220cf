"""Loading each source file exactly once, while the files' columns come and go.

A target folder ``dst`` has a folder for each batch of files, ``copy_batch=<n>``.  Beside
it lie two small tables: ``<dst>__loaded``, the ledger of files with their batch and
schema version, and ``<dst>__schemas``, the versions of the target's schema.  A version
only ever adds columns to the one before, so a batch can be read with any later one.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Iterator, Mapping, Sequence
from itertools import batched
from typing import Any
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.session import local_frame
from stratiform.sources.files import read_source
from stratiform.sources.inventory import list_files

FILES_PER_BATCH = 20_000
BATCH_COLUMN = "copy_batch"
RESCUED = "_rescued_data"
_CORRUPT = "_corrupt_record"
_LEDGER_SCHEMA = "path string, copy_batch long, schema_version long"
_VERSIONS_SCHEMA = "schema_version long, copy_batch long, schema string"


class LoadConflict(ValueError):
    """A source has a column that the target needs for itself."""


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return local_frame(spark, [], schema)


def _append_row(spark: SparkSession, rows: list[tuple], schema: str, path: str) -> None:
    local_frame(spark, rows, schema).coalesce(1).write.mode("append").parquet(path)


def loaded_files(spark: SparkSession, dst: str) -> DataFrame:
    """The ledger: path, copy_batch and schema_version of every file that was loaded."""
    return _read_or_empty(spark, dst.rstrip("/") + "__loaded", _LEDGER_SCHEMA)


def schema_versions(spark: SparkSession, dst: str) -> DataFrame:
    """schema_version, the batch that brought it, and the schema as JSON."""
    return _read_or_empty(spark, dst.rstrip("/") + "__schemas", _VERSIONS_SCHEMA)


def _latest(spark: SparkSession, dst: str) -> tuple[int, T.StructType | None]:
    row = schema_versions(spark, dst).orderBy(F.desc("schema_version"), F.desc(BATCH_COLUMN)).first()
    return (0, None) if row is None else (row.schema_version, T.StructType.fromJson(json.loads(row.schema)))


def loaded(spark: SparkSession, dst: str) -> DataFrame:
    """All rows of the target under its latest schema; older batches read NULL for newer columns."""
    _, schema = _latest(spark, dst)
    if schema is None:
        raise FileNotFoundError(f"nothing was loaded into {dst}")
    full = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType()), T.StructField(BATCH_COLUMN, T.LongType())])
    return spark.read.schema(full).parquet(dst)


def _csv_headers(spark: SparkSession, paths: Sequence[str], options: Mapping[str, Any]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header line.

    A file's first line is the one of its first split with the smallest number; it is
    found by a partial aggregate in the tasks that scan the lines, without parsing them.
    """
    lines = (
        spark.read.text(list(paths))
        .where(F.col("_metadata.file_block_start") == 0)
        .select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"))
    )
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("value"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("path").collect():
        text = row.value.removeprefix("﻿")
        names = next(csv.reader([text], delimiter=str(options.get("sep", ",")), quotechar=str(options.get("quote", '"'))), [])
        found.setdefault(tuple(names), []).append(unquote(row.path))
    return found


def _merged(spark: SparkSession, paths: Sequence[str], fmt: str, options: Mapping[str, Any]) -> list[DataFrame]:
    """Frames over files whose schemas can be merged; files are halved where they cannot."""
    extra = {"mergeSchema": True} if fmt == "parquet" else {}
    try:
        return [read_source(spark, list(paths), fmt, options={**options, **extra})]
    except (PySparkException, Py4JJavaError) as error:  # which one depends on where footers are read
        if len(paths) == 1 or "CANNOT_MERGE" not in str(error):
            raise
        half = len(paths) // 2
        return _merged(spark, paths[:half], fmt, options) + _merged(spark, paths[half:], fmt, options)


def _sources(
    spark: SparkSession, paths: Sequence[str], fmt: str, known: T.StructType | None, options: Mapping[str, Any]
) -> list[tuple[DataFrame, T.StructType]]:
    """Scans of the files, each with the types that its columns ask for if they are new.

    CSV is read as text by the names in each file's header, whatever their order.
    """
    if fmt != "csv":
        return [(df, df.schema) for df in _merged(spark, paths, fmt, options)]
    out = []
    for names, own in _csv_headers(spark, paths, options).items():
        types = {f.name.lower(): f.dataType for f in known or ()}
        if any(n.lower() not in types for n in names):
            guessed = read_source(spark, own, "csv", options=options).schema
            types = {f.name.lower(): f.dataType for f in guessed} | types
        raw = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _CORRUPT)])
        settings = {**options, "columnNameOfCorruptRecord": _CORRUPT, "enforceSchema": True}
        text = read_source(spark, own, "csv", raw, settings)
        out.append((text, T.StructType([T.StructField(n, types[n.lower()]) for n in names])))
    return out


def _fits(value: Column, cast: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether a cast kept all of a value."""
    if isinstance(source, T.StringType):
        if isinstance(target, T.DecimalType):
            kept = cast.cast("decimal(38,18)").eqNullSafe(value.try_cast("decimal(38,18)"))
        elif isinstance(target, T.DateType):
            kept = cast.cast("timestamp_ntz").eqNullSafe(value.try_cast("timestamp_ntz"))
        else:
            kept = F.lit(True)
    elif isinstance(target, T.StringType):
        kept = F.lit(True)
    else:
        kept = cast.try_cast(source).eqNullSafe(value)
    return value.isNull() | (cast.isNotNull() & kept)


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``target``, and what does not fit as JSON text.

    Names match whatever their case.  Missing columns are NULL.  A value that its
    column's type cannot hold in full becomes NULL there and goes to ``_rescued_data``
    under the column's name, as do values of columns that ``target`` lacks.
    """
    own = {f.name.lower(): f for f in df.schema}
    columns, rescued = [], []
    for f in target:
        source = own.pop(f.name.lower(), None)
        if source is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f"`{source.name}`")
        if source.dataType == f.dataType:
            columns.append(value.alias(f.name))
            continue
        cast = value.try_cast(f.dataType)
        fits = _fits(value, cast, source.dataType, f.dataType)
        columns.append(F.when(fits, cast).alias(f.name))
        rescued.append(F.struct(F.lit(f.name).alias("key"), F.when(~fits, _text(value, source.dataType)).alias("value")))
    for f in own.values():
        rescued.append(F.struct(F.lit(f.name).alias("key"), _text(F.col(f"`{f.name}`"), f.dataType).alias("value")))
    lost = F.lit(None).cast("string")
    if rescued:
        some = F.filter(F.array(*rescued), lambda e: e["value"].isNotNull())
        lost = F.when(F.size(some) > 0, F.to_json(F.map_from_entries(some)))
    return df.select(*columns, lost.alias(RESCUED))


def _text(value: Column, kind: T.DataType) -> Column:
    nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    return F.to_json(value) if nested else value.cast("string")


def _extended(known: T.StructType | None, sources: Sequence[T.StructType]) -> T.StructType:
    """``known`` and, behind it, the columns that only the sources have; all may be NULL."""
    fields = {f.name.lower(): f for f in known or ()}
    for schema in sources:
        for f in schema:
            fields.setdefault(f.name.lower(), T.StructField(f.name, f.dataType, True))
    return T.StructType(list(fields.values()))


def load_batch(
    spark: SparkSession,
    paths: Sequence[str],
    dst: str,
    number: int,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    options: Mapping[str, Any] | None = None,
    evolve: bool = True,
) -> int:
    """Load files as batch ``number``; returns the schema version.

    The batch's folder is replaced if it exists, so a batch may be repeated until its
    files are in the ledger, which are entered last.
    """
    dst, options = dst.rstrip("/"), dict(options or {})
    version, known = _latest(spark, dst)
    if known is None and schema is not None:
        known = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    sources = _sources(spark, paths, fmt, known, options)
    for _, own in sources:
        taken = {BATCH_COLUMN, RESCUED} & {f.name.lower() for f in own}
        if taken:
            raise LoadConflict(f"source column {taken.pop()} is one that the load adds")
    target = _extended(known, [own for _, own in sources] if evolve or known is None else [])
    if version == 0 or target != known:
        version += 1
        _append_row(spark, [(version, number, target.json())], _VERSIONS_SCHEMA, f"{dst}__schemas")
    rows = None
    for df, _ in sources:
        part = conform(df, target)
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        rows = spark.createDataFrame([], T.StructType([*target.fields, T.StructField(RESCUED, T.StringType())]))
    rows.write.mode("overwrite").parquet(f"{dst}/{BATCH_COLUMN}={number}")
    _append_row(spark, [(p, number, version) for p in paths], _LEDGER_SCHEMA, f"{dst}__loaded")
    return version


def _new_files(spark: SparkSession, src: str, pattern: str, ledger: DataFrame) -> Iterator[str]:
    listed = list_files(spark, src, pattern).select("path")
    fresh = listed.join(ledger.select("path"), "path", "left_anti").orderBy("path")
    return (row.path for row in fresh.toLocalIterator())


def copy_into(
    spark: SparkSession,
    src: str,
    dst: str,
    fmt: str = "parquet",
    pattern: str = "*",
    schema: T.StructType | str | None = None,
    options: Mapping[str, Any] | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    evolve: bool = True,
    reload: bool = False,
) -> int:
    """Append files below ``src`` that were not loaded before; returns how many.

    Only files missing from the ledger get opened: the comparison works on the listing,
    not on rows.  Each batch of files goes to a folder of its own and is entered in the
    ledger afterwards, so a load that died between the two rewrites the same folder when
    it is repeated.  ``reload`` takes all files, loaded or not.

    The first batch settles the types, unless ``schema`` does.  Later files may lack
    columns (NULL), bring new ones (added with ``evolve``, else kept in
    ``_rescued_data``) or order them differently.  Values that do not fit a column's
    type are kept in ``_rescued_data``: nothing is lost and no file blocks the load.
    Read the result with ``loaded``.
    """
    ledger = loaded_files(spark, dst)
    last = ledger.agg(F.max(BATCH_COLUMN)).first()[0]
    number = 0 if last is None else last + 1
    count = 0
    known = local_frame(spark, [], _LEDGER_SCHEMA) if reload else ledger
    for paths in batched(_new_files(spark, src, pattern, known), files_per_batch):
        load_batch(spark, paths, dst, number, fmt, schema, options, evolve)
        count += len(paths)
        number += 1
    return count
