"""Physical layout: file sizes, clustering along a space-filling curve, statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.operators.profiling import LOSSLESS_JSON, profile
from stratiform.session import partitions_of, reliable_checkpoint

TARGET_FILE_BYTES = 256 * 1024 * 1024
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

ZORDER_BITS = 6
ZORDER_SAMPLE_ROWS = 8_192
_SEED = 11

_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
}


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def partition_size(spark: SparkSession, target_bytes: int) -> Iterator[None]:
    """Let adaptive execution aim at ``target_bytes`` per partition for a while."""
    with _setting(spark, _ADVISORY, str(target_bytes)):
        yield


@contextmanager
def open_folders(spark: SparkSession, folders: int) -> Iterator[None]:
    """Let a task write to so many folders at once, for a while.

    Without it a task sorts all its rows by folder first, which takes memory for them.
    Rows that come after the first of one folder too many are still sorted: Spark does so
    once the number in its setting is reached.
    """
    with _setting(spark, _OPEN_FILES, str(folders + 1)):
        yield


def even_partitions(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Bring rows of one output folder together, in partitions of an even size.

    Rebalancing merges small partitions and splits a folder that holds much of
    the table over several tasks, which hashing by its key alone would not.
    """
    return df.hint("rebalance", *partition_by)


def compact(
    df: DataFrame,
    path: str,
    where: str | None = None,
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Rewrite a table to ``path`` with few files of about ``target_bytes``.

    With ``where`` only the matching rows are repacked; the others are copied in
    the partitions they have.  ``path`` must not be where ``df`` reads from.
    """
    if where is None:
        out = even_partitions(df, partition_by)
    else:
        chosen = F.coalesce(F.expr(where), F.lit(False))
        out = even_partitions(df.where(chosen), partition_by).unionByName(df.where(~chosen))
    with partition_size(df.sparkSession, target_bytes):
        out.write.partitionBy(*partition_by).parquet(path)


def _boundaries(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list[str]]:
    """Cut points that split each column into about ``2 ** bits`` equal shares.

    They come from a random sample of about ``ZORDER_SAMPLE_ROWS`` rows, drawn
    within the map tasks.  They steer the layout only, never the rows.
    """
    n = 1 << bits
    fraction = min(1.0, ZORDER_SAMPLE_ROWS / max(df.count(), 1))
    sample = df.select(*columns).sample(False, fraction, _SEED)

    def picks(c: str) -> Column:
        values = F.array_sort(F.collect_list(c))
        return F.array_distinct(
            F.transform(
                F.sequence(F.lit(1), F.lit(n - 1)),
                lambda i: F.get(values, F.floor(F.size(values) * i / n).cast("int")),
            )
        ).cast("array<string>")

    chosen = sample.agg(*[picks(c).alias(c) for c in columns]).first()
    return {c: [v for v in chosen[c] if v is not None] for c in columns}


def _share(column: Column, cuts: Sequence[str], kind: T.DataType) -> Column:
    """How many cut points are at or below the value, by binary search; NULL counts 0."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        below = column < F.lit(cuts[mid]).cast(kind)
        return F.when(below, search(lo, mid)).otherwise(search(mid + 1, hi))

    return F.when(column.isNull(), F.lit(0)).otherwise(search(0, len(cuts)))


def z_value(df: DataFrame, columns: Sequence[str], bits: int = ZORDER_BITS) -> Column:
    """Interleave the bits of the columns' shares, the first column leading."""
    if bits * len(columns) > 62:
        raise ValueError("too many columns for this many bits")
    cuts = _boundaries(df, columns, bits)
    z = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        share = _share(F.col(c), cuts[c], df.schema[c].dataType).cast("long")
        for b in range(bits):
            place = b * len(columns) + (len(columns) - 1 - i)
            bit = F.shiftright(share, b).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(bit, place))
    return z


def _with_row_identity(df: DataFrame) -> tuple[DataFrame, Column]:
    """A frame and a column that differs between its rows and survives recomputation.

    Parquet scans know the position of a row in its file.  Any other frame is
    written to the shared folder first, which fixes the order of its rows.
    """
    try:
        df.select("_metadata.row_index")
    except AnalysisException:
        return reliable_checkpoint(df), F.monotonically_increasing_id()
    return df, F.struct("_metadata.file_path", "_metadata.row_index")


def zorder(
    df: DataFrame,
    columns: Sequence[str],
    bits: int = ZORDER_BITS,
    within: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Arrange rows so that close values of all ``columns`` share files.

    ``within`` names the partition columns of the table, whose folders are kept
    apart.  Many rows, or copies of one row, may share a curve position; the hash
    of the row's identity in the sort key lets range partitioning split them.
    """
    names = df.columns
    df, identity = _with_row_identity(df)
    keyed = df.select("*", z_value(df, columns, bits).alias("_z"), F.xxhash64(identity).alias("_spread"))
    by = [*within, "_z", "_spread"]
    # Adaptive execution can merge ranges but never adds any.
    ranged = keyed.repartitionByRange(partitions or partitions_of(df), *by)
    return ranged.sortWithinPartitions(*by).select(*names)


def _width(field: T.StructField) -> Column:
    """Length of text and binary values; the size in bytes of other types."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.VarcharType, T.CharType, T.BinaryType)):
        return F.length(col)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.length(F.to_json(col))
    if isinstance(field.dataType, T.DecimalType):
        return F.lit(8 if field.dataType.precision <= 18 else 16)
    return F.lit(_FIXED_WIDTH.get(type(field.dataType), 8))


def column_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Least and greatest value, NULLs, distinct non-NULL values, mean and greatest length.

    Types of a fixed width report that as their length, as stored statistics do.
    """
    fields = [f for f in df.schema if columns is None or f.name in columns]
    parts = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c, LOSSLESS_JSON)
        width = F.when(c.isNotNull(), _width(f))
        parts += [
            F.min(c).cast("string").alias(f"_lo{i}"),
            F.max(c).cast("string").alias(f"_hi{i}"),
            F.avg(width).alias(f"_avg{i}"),
            F.max(width).cast("long").alias(f"_max{i}"),
        ]
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col(f"_lo{i}").alias("min_value"),
            F.col(f"_hi{i}").alias("max_value"),
            F.col(f"_avg{i}").alias("avg_length"),
            F.col(f"_max{i}").alias("max_length"),
        )
        for i, f in enumerate(fields)
    ]
    bounds = df.agg(*parts).select(F.inline(F.array(*rows)))
    counts = profile(df, [f.name for f in fields]).select(
        "column_name",
        "data_type",
        "null_count",
        (F.col("distinct_count") - F.when(F.col("null_count") > 0, 1).otherwise(0)).alias(
            "distinct_count"
        ),
    )
    return counts.join(bounds, "column_name")


def analyze_table(spark: SparkSession, name: str, columns: bool = True) -> None:
    """Store statistics of a catalog table for the optimizer."""
    spark.sql(
        f"ANALYZE TABLE {name} COMPUTE STATISTICS" + (" FOR ALL COLUMNS" if columns else "")
    )


def file_stats(df: DataFrame) -> DataFrame:
    """Path, bytes and rows of each file of a scan that holds rows.

    No data column is read, and rows are counted within the map tasks.
    """
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    ).agg(F.count("*").alias("row_count"))


def layout_stats(df: DataFrame) -> DataFrame:
    """Number and size of files, rows per file, and the folders' partition columns."""
    parts = F.regexp_extract_all("file_path", F.lit(r"/([^/=]+)=[^/]*"), 1)
    return file_stats(df).agg(
        F.count("*").alias("num_files"),
        F.sum("file_size").alias("size_bytes"),
        F.sum("row_count").alias("row_count"),
        F.avg("row_count").alias("avg_rows_per_file"),
        F.array_join(F.max(parts), ",").alias("partition_columns"),
    )


def cluster_depth(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How much the files of a scan overlap in each column: the fewer, the better clustered.

    Columns: column_name, num_files (with a value), max_depth (most files whose bounds
    hold one value) and avg_overlap (files, itself included, that a file's bounds meet).
    Bounds come from one aggregate by file.  A sweep over their ends, two rows a file,
    then counts the bounds begun and ended so far; starts sort before ends at one value.
    """
    by_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        *(f(F.col(f"`{c}`")).alias(f"{end}{i}") for i, c in enumerate(columns) for f, end in ((F.min, "lo"), (F.max, "hi")))
    )
    bounds = reliable_checkpoint(by_file)
    out = []
    for i, c in enumerate(columns):
        ends = bounds.where(F.col(f"lo{i}").isNotNull()).select(
            "file", F.inline(F.array(*(F.struct(F.col(f"{end}{i}").alias("at"), F.lit(k).alias("kind")) for k, end in enumerate(("lo", "hi")))))
        )
        sweep = Window.orderBy("at", "kind").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        begun = F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).over(sweep)
        ended = F.sum("kind").over(sweep)
        counted = ends.select("file", "kind", begun.alias("begun"), ended.alias("ended"))
        # A file meets those begun when it ends, but for those ended before it begins.
        out.append(
            counted.agg(
                F.lit(c).alias("column_name"),
                F.sum("kind").alias("num_files"),
                F.max(F.when(F.col("kind") == 0, F.col("begun") - F.col("ended"))).alias("max_depth"),
                (F.sum(F.when(F.col("kind") == 1, F.col("begun")).otherwise(-F.col("ended"))) / F.sum("kind")).alias("avg_overlap"),
            )
        )
    return reduce(DataFrame.unionByName, out)
