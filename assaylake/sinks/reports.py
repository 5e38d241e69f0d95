"""Quality reports, one folder per run date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report_sink(results: DataFrame, path: str, run_date: str) -> None:
    """Write check results as JSON; a rerun replaces the report of its own date only."""
    (
        results.withColumn("run_date", F.lit(run_date))
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .json(path)
    )
