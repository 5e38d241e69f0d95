"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import math
import tempfile
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Runtime settings the engine relies on; all may be set on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Whole documents are stored and extracted in the projection, unless raw tables are to be shredded.
    "spark.sql.variant.writeShredding.enabled": "false",
    "spark.sql.variant.inferShreddingSchema": "false",
    "spark.sql.variant.allowReadingShredded": "true",
    # Counts from footers (``sources/footers.py``).
    "spark.sql.parquet.aggregatePushdown": "true",
}


EXTRACT_IN_SCAN = "spark.sql.variant.pushVariantIntoScan"


def configure(spark: SparkSession, shred_raw: bool = False) -> SparkSession:
    """Set what the engine relies on. With ``shred_raw``, raw tables are written shredded (``sinks/shredding.py``)
    and extractions are pushed into scans; a lake may hold files of both kinds and is read right either way."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set(EXTRACT_IN_SCAN, str(shred_raw).lower())
    return spark


# Shuffle data one task should handle: small enough to sort in executor memory without much spilling.
BYTES_PER_SHUFFLE_TASK = 128 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under a folder; a distributed listing that reads no contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at this path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


@contextlib.contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Within the block these settings hold; the session's own are restored afterwards."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextlib.contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int, most: int) -> Iterator[int]:
    """Within the block, shuffles start with enough partitions for this much input, at most ``most``.

    Adaptive execution merges small ones. The session's own setting is restored.
    """
    wanted = min(math.ceil(input_bytes / BYTES_PER_SHUFFLE_TASK), most)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    with settings(spark, {INITIAL_PARTITIONS: str(partitions)}):
        yield partitions


def shuffle_tasks(spark: SparkSession) -> int:
    """How many tasks a shuffle starts with."""
    return int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local one only where it is unset and Spark is local."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="assaylake-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written yet under the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch path that no later plan reads."""
    if not path.startswith(f"{scratch_root(spark)}/"):
        raise ValueError(f"{path} is not in the scratch folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
