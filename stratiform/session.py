"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings an operator relies on when keys are skewed or layouts are rewritten.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when the split costs the aggregate above it a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_PARTITION_BYTES = 128 * 1024 * 1024

# The planner's stand-in for a size it does not know is the greatest long integer.
_UNKNOWN_BYTES = 2**60


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Initial shuffle partitions for a job over ``input_bytes``; AQE merges small ones."""
    wanted = -(-input_bytes // _PARTITION_BYTES)
    return int(max(wanted, cores))


def partitions_of(df: DataFrame, least: int | None = None, bytes_each: int = _PARTITION_BYTES) -> int:
    """Partitions for dealing ``df`` out, from the planner's estimate of its bytes.

    At least ``least``, or as many as the session's shuffles have: the estimate may be of
    a source that is smaller than what is made of it.  Frames whose size is unknown count
    as they are partitioned now.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = least or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unknown = size >= _UNKNOWN_BYTES
    return max(least, df.rdd.getNumPartitions() if unknown else -(-size // bytes_each))


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings to a running session."""
    for key, value in ADAPTIVE_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_frame(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str
) -> DataFrame:
    """A few rows as a local relation.

    Going through Arrow lets the planner see the size, which it does not for rows
    handed over one by one; a join can then tell whether to broadcast them.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), struct)


def _shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that every executor can reach"
        )
    root = tempfile.mkdtemp(prefix="stratiform-")
    spark.conf.set("stratiform.scratch", root)
    return root


def shared_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, local only when unset."""
    return spark.conf.get("stratiform.scratch", None) or _shared_root(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder.  Nothing is created or removed here."""
    return f"{shared_root(spark)}/stratiform/{label}-{uuid.uuid4().hex}"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder, so that lost executors lose no data."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Keep a frame as a Parquet table in the shared folder, and read it back.

    For frames that several aggregates read: select the columns these use first.  Counts
    are taken from the table and not collected while it is written, since metrics that
    tasks report count twice when a lost executor's tasks run again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
