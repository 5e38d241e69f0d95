"""Row counts of stored tables from Parquet footers, without reading a data page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.session import is_stored, settings

V1_SOURCES = "spark.sql.sources.useV1SourceList"


def partition_counts(spark: SparkSession, path: str, schema: T.StructType, by: str) -> DataFrame:
    """(``by``, row_count) of a table partitioned by ``by``; no rows where nothing is stored.

    The count is pushed into the scan, which only the second version of the Parquet source can do. It groups by
    the partition column alone, so the largest value of that column comes from the few rows that are left. A filter on
    the partition column prunes partitions; one on any other column would have to read data and is not for this table.
    """
    if not is_stored(spark, path):
        return spark.createDataFrame([], T.StructType([schema[by], T.StructField("row_count", T.LongType())]))
    others = [s for s in spark.conf.get(V1_SOURCES).split(",") if s.strip() not in ("", "parquet")]
    with settings(spark, {V1_SOURCES: ",".join(others)}):  # looked at when the source is chosen, here
        stored = spark.read.schema(schema).parquet(path)
    return stored.groupBy(by).agg(F.count("*").alias("row_count"))
