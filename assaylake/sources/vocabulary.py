"""Tab-separated vocabulary files: unquoted, one header row, dates as YYYYMMDD or YYYY-MM-DD."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.functions.scalars import required_cast
from assaylake.schemas.vocabulary import VOCABULARY_SCHEMAS


def vocabulary_date(value: Column) -> Column:
    """Eight digits are read as YYYYMMDD; anything else must be an ISO date."""
    dashed = F.regexp_replace(value, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return required_cast(dashed, "date", "vocabulary date")


def vocabulary_scan(spark: SparkSession, table: str, path: str) -> DataFrame:
    """One vocabulary file under its declared schema; quotes are ordinary characters."""
    schema = VOCABULARY_SCHEMAS[table]
    as_text = T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType)
            for f in schema.fields
        ]
    )
    rows = spark.read.csv(path, schema=as_text, sep="\t", quote="", header=True, mode="FAILFAST")
    return rows.select(
        *[
            vocabulary_date(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.DateType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )


def load_bundle(
    spark: SparkSession,
    locate: Callable[[str], str | None],
    target: str,
) -> tuple[dict[str, DataFrame], list[str]]:
    """Replace every vocabulary table whose file is present.

    ``locate`` gives the path of a table's file, or None. Returns the stored tables and
    the names that were skipped.
    """
    stored: dict[str, DataFrame] = {}
    skipped: list[str] = []
    for table in VOCABULARY_SCHEMAS:
        path = locate(table)
        if path is None:
            skipped.append(table)
            continue
        vocabulary_scan(spark, table, path).write.mode("overwrite").parquet(f"{target}/{table}")
        stored[table] = spark.read.parquet(f"{target}/{table}")
    return stored, skipped


def bundle_counts(stored: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) over the loaded tables."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in stored.items()
    ]
    result = counts[0]
    for each in counts[1:]:
        result = result.unionByName(each)
    return result
