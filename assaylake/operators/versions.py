"""Keeping the newest version of each resource."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.schemas.raw import FILE_URI, RUN_DATE

VERSION_ORDER = ("last_updated", RUN_DATE, FILE_URI)


def latest_version(
    df: DataFrame, key: str = "resource_id", order: Sequence[str] = VERSION_ORDER
) -> DataFrame:
    """One row per key: the greatest by ``order``, NULLs last.

    Ranking and keeping rank 1 lets Spark cut each key to one row per map task before the shuffle,
    so a key holding a large share of all versions does not travel or land in one task.
    """
    newest_first = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def updated_since(df: DataFrame, since: Column | None, column: str = "last_updated") -> DataFrame:
    """Rows at or after a high-water mark; boundary rows are processed again.

    It may run before ``latest_version``: the newest version of a key passes the filter exactly when
    it is the newest of the versions that pass, so old versions need not be shuffled.
    """
    return df if since is None else df.filter(F.col(column) >= since)


def high_water(df: DataFrame, column: str = "_loaded_at") -> DataFrame:
    """One row, one column ``mark``: the greatest value, or the epoch for an empty table."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp")
    return df.agg(F.coalesce(F.max(column), epoch).alias("mark"))
