"""Mart tables on Parquet: whole-table, date-partitioned, and partition maintenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def view_sink(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def table_sink(df: DataFrame, path: str) -> DataFrame:
    """Rebuild a whole table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def clustered(df: DataFrame, date_column: str, cluster_by: Sequence[str]) -> DataFrame:
    """Rows grouped by date for writing, ordered by the cluster columns inside each file.

    REBALANCE lets adaptive execution size the write tasks: small days share one, and a day
    holding much of the table (also the NULL day) is split over many.
    """
    return df.hint("rebalance", F.col(date_column)).sortWithinPartitions(date_column, *cluster_by)


def partitioned_sink(
    df: DataFrame,
    path: str,
    date_column: str,
    cluster_by: Sequence[str],
    mode: str = "overwrite",
    only_touched: bool = False,
) -> DataFrame:
    """Write a table partitioned by day. ``only_touched`` keeps the days ``df`` does not mention."""
    writer = clustered(df, date_column, cluster_by).write.mode(mode).partitionBy(date_column)
    writer = writer.option("partitionOverwriteMode", "dynamic" if only_touched else "static")
    writer.parquet(path)
    return read_partitioned(df.sparkSession, path, df.schema)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table under its own schema, so a NULL-only or empty partition column keeps its type."""
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def clear_partition(
    spark: SparkSession, path: str, column: str, value: object, schema: T.StructType
) -> None:
    """Leave one partition in place without rows."""
    folder = NULL_PARTITION if value is None else str(value)
    kept = T.StructType([f for f in schema.fields if f.name != column])
    spark.createDataFrame([], kept).write.mode("overwrite").parquet(f"{path}/{column}={folder}")
