"""What files lie under a folder, from the file listing alone (contents stay unread)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SAMPLES_PER_EXTENSION = 5


def list_files(
    spark: SparkSession, root: str, pattern: str = "*", max_depth: int | None = None
) -> DataFrame:
    """One row per file: ``path, length, modificationTime, ext, depth``.

    ``depth`` is the number of folders between ``root`` and the file.
    """
    base = root.rstrip("/").split("://")[-1].removeprefix("file:")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    name = F.substring_index("path", "/", -1)
    inside = F.substr("path", F.instr("path", base + "/") + F.lit(len(base) + 1))
    # A leading dot starts a hidden name, not an extension.
    ext = F.lower(F.regexp_extract(name, r"^.+(\.[^.]*)$", 1))
    listed = files.select(
        "*",
        F.when(ext == "", "no_extension").otherwise(ext).alias("ext"),
        (F.size(F.split(inside, "/")) - 1).alias("depth"),
    )
    return listed if max_depth is None else listed.where(F.col("depth") <= max_depth)


def file_inventory(spark: SparkSession, root: str, max_depth: int | None = None) -> DataFrame:
    """Count, bytes and a few sample paths per extension, most frequent first.

    ``max_depth`` counts folder levels read, the root being the first; all by default.
    """
    files = list_files(spark, root, max_depth=None if max_depth is None else max_depth - 1)
    totals = files.groupBy("ext").agg(
        F.count("*").alias("file_count"), F.sum("length").alias("total_bytes")
    )
    by_path = Window.partitionBy("ext").orderBy("path")
    samples = (
        files.withColumn("_n", F.row_number().over(by_path))
        .where(F.col("_n") <= SAMPLES_PER_EXTENSION)
        .groupBy("ext")
        .agg(F.sort_array(F.collect_list("path")).alias("sample_paths"))
    )
    return totals.join(samples, "ext").orderBy(F.desc("file_count"), "ext")
