"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.session import scratch_path

# Words are maximal runs of anything but the six ASCII white-space bytes.
WORD = "[^\\x20\\x09-\\x0D]+"

# Bytes of an Arrow batch of texts.
BATCH_BYTES = 8 * 1024 * 1024

# Beyond this the planner's estimate of a size is taken for a guess.
UNKNOWN_BYTES = 2**50

# Whether Spark removes an execution's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Bytes of a range of rows that are numbered by range.
RANGE_BYTES = 64 * 1024 * 1024

# monotonically_increasing_id keeps the partition above these bits.
_PART_BITS = 33

# Numpy works on slices of an Arrow batch (which Spark bounds by bytes), since it needs
# a multiple of the text's size.
SLICE_BYTES = 256 * 1024


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches, which Python workers hold two of, unless the session does.

    The default bound is several times what a worker needs at once.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).rstrip("b") == str(64 * 1024 * 1024):
        spark.conf.set(key, str(BATCH_BYTES))


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to a table in the shared folder and read it back.

    Whatever is computed from it later survives lost executors, and its source is
    computed once.  Nothing needs the shuffles behind it any more once it is written,
    so their files go at once instead of when the driver next collects garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def size_in_bytes(df: DataFrame) -> int:
    """The planner's estimate of a frame's size; for scans, the size of their files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def partitions_for(docs: DataFrame, bytes_each: int) -> int:
    """Partitions for a shuffle of what is derived from ``docs``; grows with its size.

    Where the planner can't tell the size (it takes the greatest number for rows from
    the driver, and products for joins), the texts are measured.
    """
    size = size_in_bytes(docs)
    if size >= UNKNOWN_BYTES:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // bytes_each))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: 1, 2, .. in the given order, which should tell all rows apart.

    Rows are dealt by ranges of the order and written; a row's number is its place in
    its range plus the sizes of the ranges before, of which there is one row each.
    """
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size_in_bytes(rows) // RANGE_BYTES))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = staged(ranged.withColumn("_id", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("_part", F.shiftright("_id", _PART_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    place = F.col("_id") - F.shiftleft("_part", _PART_BITS) + 1
    return placed.join(offsets, "_part").withColumn(name, F.col("_before") + place).drop("_id", "_part", "_before")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text) for every row; keys differ and order rows by ``doc_id``.

    Where ids differ and none is null they are the keys.  Otherwise rows are written with
    a number each and put in order: null first, rows of one id by their texts' hashes.
    A null text becomes empty.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    twice = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if twice.isEmpty():
        return rows.select(F.col("doc_id").alias("key"), "doc_id", "text")
    rows = staged(rows.withColumn("_seq", F.monotonically_increasing_id()).withColumn("_hash", F.xxhash64("text")), "rows")
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash"), F.col("_seq")]
    keys = numbered(rows.select("doc_id", "_hash", "_seq"), order, "key").select("_seq", "key")
    return rows.join(keys, "_seq").select("key", "doc_id", "text")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    A column that is named in a projection may be copied into every place that uses
    it, even into a function that runs for each element of an array.
    """
    return F.transform(F.array(value), body)[0]


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch between rows so that each part has about ``size`` bytes of text."""
    import numpy as np
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.concatenate([[0], np.cumsum(sizes.astype("int64"))[:-1]]) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every vertex of ``edges(a, b)``: (doc_id, component_id).

    Alternates the large-star and small-star steps: every vertex hands its larger
    (then its smaller) neighbours to the smallest one it knows.  Each round is one
    aggregate and one join and is written to the shared folder; rounds grow with the
    logarithm of the longest path.
    """
    state = staged(
        edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(),
        "edges",
    )
    last = None
    while True:
        # Large star: the larger neighbours of u go to the smallest neighbour of u.
        both = state.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(
            state.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        ).distinct()
        # Small star: u and its smaller neighbours go to the smallest of these.
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(least, "hi")
        small = (
            moved.where("lo <> m")
            .select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
            .unionAll(least.select(F.col("m").alias("lo"), "hi"))
            .distinct()
        )
        state = staged(small, "edges")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    return state.select(F.col("hi").alias("doc_id"), F.col("lo").alias("component_id"))
