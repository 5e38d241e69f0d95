"""Key-based upsert into a day-partitioned Parquet table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.session import remove_scratch, scratch_path
from assaylake.sinks.tables import clear_partition, partitioned_sink


def merge_by_key(target: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not in ``delta``, plus ``delta``; new columns are NULL on old rows."""
    kept = target.join(delta.select(key), key, "left_anti")
    return kept.unionByName(delta, allowMissingColumns=True)


def upsert_partitions(
    target_path: str,
    target: DataFrame,
    delta: DataFrame,
    key: str,
    date_column: str,
    cluster_by: Sequence[str],
) -> DataFrame:
    """Apply ``delta`` to the stored table, rewriting only days that gain, lose or change rows.

    A row whose date was corrected leaves its old day, so the days of matching old rows are rewritten
    with the days of the delta. The delta is stored in the shared scratch folder first, so its plan
    runs once and a rerun after a failure starts from the same rows. New files of a day replace the old
    ones only when the whole job commits, after every read of the old ones is done.

    Days that end up empty are cleared first, in a commit of their own. A failure between the two leaves rows that
    moved to another day out until the run is repeated; the repeated run finds them in its delta again.
    """
    spark = delta.sparkSession
    staging = scratch_path(spark, "upsert")
    delta.write.parquet(staging)
    delta = spark.read.schema(delta.schema).parquet(staging)

    # Narrow scans of key and partition column. At most one row per partition of the table comes back.
    keys = delta.select(key)
    stored = target.select(key, date_column)
    left = stored.join(keys, key, "left_semi").select(date_column, F.lit(True).alias("old"))
    gained = delta.select(date_column, F.lit(False).alias("old"))
    days = left.union(gained).groupBy(date_column).agg(F.bool_and("old").alias("only_old")).collect()
    if not days:
        remove_scratch(spark, staging)
        return target

    def in_days(values: list) -> Column:
        listed = F.col(date_column).isin([v for v in values if v is not None])
        return listed | F.col(date_column).isNull() if None in values else listed

    # A day that only lost rows may end up empty; overwriting with no rows would leave its old files.
    losing = [d[date_column] for d in days if d["only_old"]]
    emptied: set = set()
    if losing:
        kept = stored.filter(in_days(losing)).join(keys, key, "left_anti").select(date_column).distinct()
        emptied = set(losing) - {r[0] for r in kept.collect()}
    for day in emptied:
        clear_partition(spark, target_path, date_column, day, delta.schema)

    rewritten = [d[date_column] for d in days if d[date_column] not in emptied]
    merged = merge_by_key(target.filter(in_days(rewritten)), delta, key)
    written = partitioned_sink(merged, target_path, date_column, cluster_by, only_touched=True)
    remove_scratch(spark, staging)
    return written
