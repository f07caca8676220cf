"""Loading each source file exactly once, as a stream that stops when it is up to date."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from stratiform.sinks.copy_into import load_batch

FILES_PER_TRIGGER = 20_000


def load_new_files(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    options: Mapping[str, Any] | None = None,
    audit: bool = False,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Append files below ``src``, at any depth, that the checkpoint has not seen.

    The default trigger takes what is there, in bounded batches, and ends; pass
    ``{"processingTime": "1 minute"}`` to keep running.  The Parquet sink records
    its commits, so a batch repeated after a failure adds no rows twice.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    settings = {"maxFilesPerTrigger": FILES_PER_TRIGGER, "recursiveFileLookup": True, **(options or {})}
    for key, value in settings.items():
        reader = reader.option(key, value)
    rows = reader.load(src)
    if audit:
        rows = rows.select(
            "*",
            F.current_timestamp().alias("_ingestion_timestamp"),
            F.col("_metadata.file_path").alias("_source_file"),
        )
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", dst)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def load_evolving_files(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    fmt: str = "parquet",
    pattern: str = "*",
    schema: T.StructType | str | None = None,
    options: Mapping[str, Any] | None = None,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """The same while columns come and go, by the rules of ``sinks.copy_into``.

    The stream carries names of files only; their contents are read batch by batch, as
    each batch's columns ask for.  A batch is numbered by the stream, so that one that
    is repeated after a failure replaces its own folder.  Read the result with
    ``sinks.loaded``.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", FILES_PER_TRIGGER)
        .load(src)
        .select("path")
    )

    def load(batch: DataFrame, number: int) -> None:
        paths = [row.path for row in batch.orderBy("path").toLocalIterator()]
        if paths:
            load_batch(spark, paths, dst, number, fmt, schema, options)

    return (
        names.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
