"""Raw tables, one partition per run date."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.schemas.raw import FILE_URI, RAW, RUN_DATE
from assaylake.session import remove_scratch, scratch_path
from assaylake.sinks.shredding import raw_layout
from assaylake.sinks.tables import clear_partition
from assaylake.sources.footers import partition_counts
from assaylake.sources.ndjson import landing_discover, ndjson_scan


def _write_by_day(rows: DataFrame, path: str, mode: str) -> None:
    """Overwriting swaps the run dates that ``rows`` hold and leaves the others."""
    ordered = rows.sortWithinPartitions(RUN_DATE, "resource_id").write.partitionBy(RUN_DATE)
    with raw_layout(rows.sparkSession):
        ordered.mode(mode).option("partitionOverwriteMode", "dynamic").parquet(path, compression="zstd")


def raw_append(rows: DataFrame, path: str) -> None:
    """Add rows; columns the table does not know yet are kept (read with ``raw_read``)."""
    _write_by_day(rows, path, "append")


def raw_replace(rows: DataFrame, path: str, run_date: str) -> None:
    """Make the table's ``run_date`` partition hold exactly these rows.

    The old partition is swapped when the job commits. A load without rows writes no partition,
    so it clears the old one explicitly.
    """
    # Whether anything arrived is asked first and stops at the first row: cheap next to the load.
    if rows.select("resource_id").isEmpty():
        clear_partition(rows.sparkSession, path, RUN_DATE, run_date, RAW)
        return
    _write_by_day(rows, path, "overwrite")


def raw_merge_files(rows: DataFrame, path: str) -> None:
    """Make the table hold exactly these rows of the files they come from; rows of other files stay.

    Only the run dates of these files are rewritten, from a copy of the rows in the shared folder.
    """
    spark = rows.sparkSession
    staging = scratch_path(spark, "raw-files")
    rows.write.partitionBy(RUN_DATE).parquet(staging)
    new = spark.read.schema(rows.schema).parquet(staging)
    days = [r[0] for r in new.select(RUN_DATE).distinct().collect()]  # one per landed day
    if days:
        try:
            old = spark.read.option("mergeSchema", "true").parquet(path).filter(F.col(RUN_DATE).isin(days))
            kept = old.join(new.select(FILE_URI).distinct(), FILE_URI, "left_anti")
            merged = kept.unionByName(new, allowMissingColumns=True)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            merged = new
        _write_by_day(merged, path, "overwrite")
    remove_scratch(spark, staging)


def raw_read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def load_run(spark: SparkSession, landing: str, run_date: str, raw_root: str) -> DataFrame:
    """Load one landed day into the raw tables, once or many times with the same result.

    Returns (resource_type, row_count); raises when nothing was landed.
    """
    landed = landing_discover(spark, landing, run_date).filter("resource_type is not null")
    types = [r[0] for r in landed.select("resource_type").distinct().orderBy("resource_type").collect()]
    for resource_type in types:
        rows = ndjson_scan(spark, landing, run_date, resource_type)
        raw_replace(rows, f"{raw_root}/{resource_type}", run_date)
    report = load_report(spark, raw_root, types, run_date)
    if report.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0] == 0:
        raise RuntimeError(f"no rows landed under {landing}/{run_date}")
    return report


def load_report(spark: SparkSession, raw_root: str, types: list[str], run_date: str) -> DataFrame:
    """Rows per loaded type, from the footers of one partition's files."""
    empty = spark.createDataFrame([], "resource_type string, row_count long")
    for resource_type in types:
        by_day = partition_counts(spark, f"{raw_root}/{resource_type}", RAW, RUN_DATE)
        counted = by_day.filter(F.col(RUN_DATE) == F.lit(run_date).cast("date")).agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")
        )
        empty = empty.unionByName(counted.select(F.lit(resource_type).alias("resource_type"), "row_count"))
    return empty
