"""Picking up landing files as they arrive, with the same parsing as the batch load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assaylake.schemas.raw import FILE_URI, RUN_DATE
from assaylake.sinks.raw import raw_merge_files
from assaylake.sources.ndjson import raw_envelope

RUN_DATE_IN_PATH = r"/(\d{4}-\d\d-\d\d)/(?:[^/]+/)*[^/]+\.ndjson(?:/[^/]*)?$"
# A day's files may lie in folders of the day, this deep.
DEPTH = 3


def landing_stream(spark: SparkSession, landing: str, resource_type: str) -> DataFrame:
    """Raw rows of new files of one type; the run date comes from the folder name."""
    folders = ",".join("/".join("*" * depth) for depth in range(1, DEPTH + 2))
    lines = (
        spark.readStream.format("text")
        .load(f"{landing}/{{{folders}}}/{resource_type}[-.]*ndjson")
        .select(F.btrim("value", F.lit(" \t\r\n\f\x0b")).alias("line"), F.col("_metadata.file_path").alias("file_uri"))
        .filter(F.col("line") != "")
    )
    return raw_envelope(lines, F.regexp_extract("file_uri", RUN_DATE_IN_PATH, 1))


def land_available(spark: SparkSession, landing: str, resource_type: str, path: str, checkpoint: str) -> StreamingQuery:
    """Bring every file not seen before into the raw table and stop.

    A batch replaces the rows of the files it holds, so one that is repeated after a failure, or a file that a batch
    load has brought in already, leaves the same table. The table stays an ordinary one: batch loads and other
    readers see the same rows.
    """
    rows = landing_stream(spark, landing, resource_type)

    def merge(batch: DataFrame, _: int) -> None:
        raw_merge_files(batch, path)

    return (
        rows.select("resource_id", "resource_type", "last_updated", "raw", FILE_URI, RUN_DATE)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
