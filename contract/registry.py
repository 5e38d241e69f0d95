"""Collects queries with their SQL counterparts."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contract.adapter import Tables
from contract.oracle import with_relations

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


@functools.lru_cache(maxsize=4)
def _tables(spark: SparkSession, application: str, folder: str) -> Tables:
    return Tables(spark, folder)


def tables(spark: SparkSession, folder: str) -> Tables:
    return _tables(spark, spark.sparkContext.applicationId, folder.rstrip("/"))


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and instants as UTC wall-clock times, the types SQL engines share."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may name the relations of ``contract.oracle``."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(build(tables(spark, folder)))

        run.__name__ = run.__qualname__ = name
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_relations(sql)
        return build

    return register
