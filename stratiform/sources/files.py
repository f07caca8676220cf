"""Readers with one calling convention for every supported file format."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions.casts import cast_all_to_string
from stratiform.session import local_frame
from stratiform.sources.inventory import list_files

# File endings that are read, and the reader each one needs.
FORMAT_OF_EXTENSION: Mapping[str, str] = {
    "parquet": "parquet",
    "parq": "parquet",
    "csv": "csv",
    "json": "json",
}

# What a scan knows about the file of each row.
LINEAGE = ("file_path", "file_name", "file_size", "file_modification_time")


def read_source(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Read files of one format.

    CSV files are taken to have a header.  Their types are inferred only when no
    schema is given, because inference costs a second pass over the text.  A header
    that disagrees with the schema raises: columns are never taken by position.
    """
    reader = spark.read.format(fmt)
    settings: dict[str, Any] = {}
    if fmt == "csv":
        settings = {"header": True, "inferSchema": schema is None, "enforceSchema": False}
    for key, value in {**settings, **(options or {})}.items():
        reader = reader.option(key, value)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def file_formats(
    spark: SparkSession, root: str, exts: Iterable[str] = tuple(FORMAT_OF_EXTENSION)
) -> list[str]:
    """Which of ``exts`` occur under ``root``; at most one entry per extension."""
    wanted = list(exts)
    rows = (
        list_files(spark, root, "*.{" + ",".join(wanted) + "}")
        .select("ext")
        .distinct()
        .collect()
    )
    found = {row.ext.lstrip(".") for row in rows}
    return [e for e in wanted if e in found]


def read_tree(
    spark: SparkSession,
    root: str,
    exts: Sequence[str] = tuple(FORMAT_OF_EXTENSION),
    as_strings: bool | None = None,
    options: Mapping[str, Any] | None = None,
    lineage: bool = False,
) -> DataFrame:
    """Read every data file below ``root``, whatever its format.

    There is one scan per format found, at any depth; the scans are united by column
    name, and so are Parquet files whose columns differ.
    Formats disagree on types, so columns become text when several formats are
    mixed, unless ``as_strings`` says otherwise.  With ``lineage`` each row has a column
    ``_metadata`` that tells its file: the hidden columns of a scan do not survive a
    union, so they are bound before it.  ``functions.audit`` reads either kind.
    """
    found = file_formats(spark, root, exts)
    if not found:
        raise FileNotFoundError(f"no {'/'.join(exts)} file under {root}")
    by_format: dict[str, list[str]] = {}
    for ext in found:
        by_format.setdefault(FORMAT_OF_EXTENSION[ext], []).append(ext)
    parts = []
    for fmt, endings in by_format.items():
        glob = "*.{" + ",".join(endings) + "}"
        parts.append(
            read_source(
                spark,
                root,
                fmt,
                options={
                    "recursiveFileLookup": True,
                    "pathGlobFilter": glob,
                    **({"mergeSchema": True} if fmt == "parquet" else {}),
                    **(options or {}),
                },
            )
        )
    if as_strings is None:
        as_strings = len(parts) > 1
    return _united(parts, as_strings, lineage)


def _united(parts: Sequence[DataFrame], as_strings: bool, lineage: bool) -> DataFrame:
    """Scans as one frame, by column name; ``_metadata`` is bound to each scan if wanted."""
    out = []
    for scan in parts:
        part = cast_all_to_string(scan) if as_strings else scan
        if lineage:
            hidden = [F.col(f"_metadata.{c}").alias(c) for c in LINEAGE]
            part = part.select("*", F.struct(*hidden).alias("_metadata"))
        out.append(part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


def route_by_format(
    spark: SparkSession, root: str, table_name: str, lineage: bool = False
) -> dict[str, DataFrame]:
    """Split a mixed folder into one frame per target table.

    Parquet files feed ``table_name`` and CSV files ``table_name`` + ``_csv``;
    anything else is left alone.  A file's ending tells its format; a file without one of
    the two endings has the format of the nearest folder above it named ``parquet`` or
    ``csv``.  ``lineage`` is as for ``read_tree``.
    """
    targets = {"parquet": table_name, "csv": f"{table_name}_csv"}
    base = root.rstrip("/").split("://")[-1].removeprefix("file:")
    inside = F.substr("path", F.instr("path", base + "/") + F.lit(len(base)))
    # The last folder of either name decides: the pattern is greedy.
    folder = F.regexp_extract(inside, r"^.*/(parquet|csv)/", 1)
    ending = F.ltrim("ext", F.lit("."))
    listed = list_files(spark, root).select(
        "path", F.when(ending.isin(*targets), ending).alias("by_ending"), F.when(folder != "", folder).alias("by_folder")
    )
    by_ending = file_formats(spark, root, targets)
    bare = listed.where("by_ending IS NULL AND by_folder IS NOT NULL").orderBy("path")
    named: dict[str, list[str]] = {}
    for row in bare.toLocalIterator():
        named.setdefault(row.by_folder, []).append(row.path)
    routed = {}
    for fmt, target in targets.items():
        if fmt in named:
            scans = [read_source(spark, named[fmt], fmt)]
            if fmt in by_ending:
                options = {"recursiveFileLookup": True, "pathGlobFilter": f"*.{fmt}"}
                scans.insert(0, read_source(spark, root, fmt, options=options | ({"mergeSchema": True} if fmt == "parquet" else {})))
            routed[target] = _united(scans, False, lineage)
        elif fmt in by_ending:
            routed[target] = read_tree(spark, root, (fmt,), lineage=lineage)
    return routed


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def reference_df(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str
) -> DataFrame:
    """A small lookup table with an explicit schema."""
    return local_frame(spark, rows, schema)
