"""Rewriting some files of a Parquet folder and leaving the others as they are.

New files are written to a hidden folder ``_rewrite-<id>`` of the table, followed by the
list of files that they replace.  Once that list is complete the rewrite will happen: new
files are moved in, replaced ones removed, the hidden folder last.  ``recover``, which
every rewrite calls first, finishes a rewrite that died after that point and drops one
that died before.  While files are moved, readers may see rows of both.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.operators.layout import TARGET_FILE_BYTES, even_partitions, open_folders, partition_size, zorder
from stratiform.operators.merge import check_single_match
from stratiform.session import local_frame, reliable_checkpoint

_WORK = re.compile(r"^_rewrite-[0-9a-f]{32}$")
_PARTITION = re.compile(r"/([^/=]+)=[^/]*")
_MOVES_AT_ONCE = 16


class Rewrite(NamedTuple):
    """How many files were replaced, and how many came in their place."""

    removed: int
    added: int


class _Files:
    """The few file operations a rewrite needs, on whatever store the path is in."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, path: str) -> list[str]:
        at = self._path(path)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def below(self, path: str) -> list[str]:
        """Data files below a folder, relative to it."""
        at = self._path(path)
        if not self._fs.exists(at):
            return []
        base = self._fs.makeQualified(at).toString() + "/"
        found, files = [], self._fs.listFiles(at, True)
        while files.hasNext():
            name = files.next().getPath().toString().removeprefix(base)
            if not any(part.startswith(("_", ".")) for part in name.split("/")):
                found.append(name)
        return found

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def move(self, source: str, target: str) -> None:
        to = self._path(target)
        self._fs.mkdirs(to.getParent())
        if not self._fs.rename(self._path(source), to):
            raise OSError(f"cannot move {source} to {target}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _each(work: Callable[[str], object], names: Iterable[str]) -> None:
    with ThreadPoolExecutor(_MOVES_AT_ONCE) as pool:
        list(pool.map(work, names))


def _finish(spark: SparkSession, path: str, work: str) -> None:
    """Move new files in, remove the replaced ones; may be repeated."""
    files = _Files(spark, path)
    _each(lambda name: files.move(f"{work}/data/{name}", f"{path}/{name}"), files.below(f"{work}/data"))
    _each(files.remove, (r.path for r in spark.read.schema("path string").parquet(f"{work}/replaced").toLocalIterator()))
    files.remove(work)
    spark.catalog.refreshByPath(path)


def recover(spark: SparkSession, path: str) -> int:
    """Finish or drop rewrites of a folder that died; returns how many there were."""
    path = path.rstrip("/")
    files = _Files(spark, path)
    unfinished = [f"{path}/{name}" for name in files.names(path) if _WORK.match(name)]
    for work in unfinished:
        if files.exists(f"{work}/replaced/_SUCCESS"):
            _finish(spark, path, work)
        else:
            files.remove(work)
    return len(unfinished)


def partition_columns(paths: Iterable[str], base: str) -> list[str]:
    """Names of the partition columns that the folders of files below ``base`` tell."""
    start = len(base.rstrip("/").split("://")[-1].removeprefix("file:"))
    for p in paths:
        inner = p[p.index(base.rstrip("/").split("://")[-1].removeprefix("file:")) + start :]
        return _PARTITION.findall(inner.rsplit("/", 1)[0])
    return []


def read_files(spark: SparkSession, table: DataFrame, base: str, paths: Sequence[str]) -> DataFrame:
    """Only some files of a table, with all its columns."""
    return spark.read.schema(table.schema).option("basePath", base).parquet(*paths)


def replace_files(
    spark: SparkSession,
    path: str,
    old: Sequence[str],
    rows: DataFrame,
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
) -> Rewrite:
    """Write ``rows`` into the folder and remove the files ``old``; no other is touched."""
    path = path.rstrip("/")
    work = f"{path}/_rewrite-{uuid.uuid4().hex}"
    with partition_size(spark, target_bytes):
        rows.write.partitionBy(*partition_by).parquet(f"{work}/data")
    added = len(_Files(spark, path).below(f"{work}/data"))
    local_frame(spark, [(p,) for p in old], "path string").coalesce(1).write.parquet(f"{work}/replaced")
    _finish(spark, path, work)
    return Rewrite(len(old), added)


def touched_files(df: DataFrame, where: str | None = None) -> list[tuple[str, int]]:
    """Path and size of each file of a scan that holds a row for which ``where`` is true.

    Conditions on partition columns prune folders; others reach the scan as filters.
    """
    rows = df if where is None else df.where(where)
    found = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    return [(unquote(r.path), r.size) for r in found.orderBy("path").collect()]


def first_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Positions of ``sizes`` in bins: largest first, each into the first bin with room."""
    bins: list[list[int]] = []
    room: list[int] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        b = next((b for b, free in enumerate(room) if free >= sizes[i]), None)
        if b is None:
            bins.append([i])
            room.append(capacity - sizes[i])
        else:
            bins[b].append(i)
            room[b] -= sizes[i]
    return bins


def compact_files(
    spark: SparkSession,
    path: str,
    where: str | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    cluster_by: Sequence[str] = (),
    table: DataFrame | None = None,
) -> Rewrite:
    """Merge small files into files of up to ``target_bytes``; other files keep their names.

    ``where`` restricts the work to files with such rows.  Files of less than half the
    target go into bins, folder by folder; bins of one file stay as they are.  With
    ``cluster_by`` all chosen files are rewritten instead, in the order of a curve.
    Only names and sizes of chosen files pass through the driver.  ``table`` is a scan of
    the folder, where its schema is known otherwise than from the files.
    """
    path = path.rstrip("/")
    recover(spark, path)
    table = spark.read.parquet(path) if table is None else table
    files = touched_files(table, where)
    parts = partition_columns((p for p, _ in files), path)
    if cluster_by:
        old = [p for p, _ in files]
        if not old:
            return Rewrite(0, 0)
        return replace_files(spark, path, old, zorder(read_files(spark, table, path, old), cluster_by, within=parts), parts, target_bytes)
    folders: dict[str, list[tuple[str, int]]] = {}
    for p, size in files:
        if 2 * size < target_bytes:
            folders.setdefault(p.rsplit("/", 1)[0], []).append((p, size))
    bins = [
        [own[i][0] for i in b]
        for own in folders.values()
        for b in first_fit_decreasing([size for _, size in own], target_bytes)
        if len(b) > 1
    ]
    if not bins:
        return Rewrite(0, 0)
    old = [p for b in bins for p in b]
    names = local_frame(spark, [(p, n) for n, b in enumerate(bins) for p in b], "_name string, _bin int")
    # A scan names files as URIs, in which a plus sign is one.
    name = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    placed = read_files(spark, table, path, old).select("*", name.alias("_name")).join(names, "_name")
    rows = placed.repartitionById(len(bins), "_bin").select(*table.columns)
    with open_folders(spark, 1):  # a task has a bin, whose files are of one folder
        return replace_files(spark, path, old, rows, parts, target_bytes)


def merge_files(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    target_bytes: int = TARGET_FILE_BYTES,
    table: DataFrame | None = None,
    partition_by: Sequence[str] | None = None,
) -> Rewrite:
    """Upsert into a Parquet folder, rewriting only the files that hold a matched key.

    Rows of ``source`` replace rows with the same keys; the others are added.  NULL keys
    match nothing.  A source that repeats a key which the table holds raises.  The
    source is kept in the shared folder, as it is read for the checks, for the search
    and for the new files.  The search reads only the table's keys, in row groups whose
    bounds overlap the source's, and names the files; their rows without a successor are
    written again together with the source.  ``table`` is a scan of the folder, and
    ``partition_by`` its columns, where they are known otherwise than from the files.
    """
    path = path.rstrip("/")
    recover(spark, path)
    table = spark.read.parquet(path) if table is None else table
    new = reliable_checkpoint(source.select(*table.columns))
    bounds = new.agg(*(f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max))).first().asDict()
    if any(v is None for v in bounds.values()):
        inside = F.lit(False)  # no complete key
    else:
        inside = reduce(and_, (F.col(k).between(F.lit(bounds[f"min_{k}"]), F.lit(bounds[f"max_{k}"])) for k in keys))
    scope = table.where(inside)
    check_single_match(scope, new, keys)
    held = scope.select(*keys, F.col("_metadata.file_path").alias("_file")).join(new.select(*keys), list(keys), "left_semi")
    old = [unquote(r["_file"]) for r in held.select("_file").distinct().orderBy("_file").collect()]
    parts = partition_columns(map(unquote, table.inputFiles()[:1]), path) if partition_by is None else list(partition_by)
    rows = new
    if old:
        rows = read_files(spark, table, path, old).join(new.select(*keys), list(keys), "left_anti").select(*table.columns).unionByName(new)
    return replace_files(spark, path, old, even_partitions(rows, parts), parts, target_bytes)

