"""Joins that keep the grain of the fact side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.session import shuffle_tasks


def unique_key(lookup: DataFrame, keys: Mapping[str, Column], value: str = "concept_id") -> DataFrame:
    """(keys..., value) with one row per key; of several values the least is kept."""
    named = lookup.select(*[c.alias(k) for k, c in keys.items()], F.col(value))
    usable = named.dropna(subset=list(keys))
    return usable.groupBy(*keys).agg(F.min(value).alias(value))


def ambiguous_keys(lookup: DataFrame, keys: Mapping[str, Column], value: str = "concept_id") -> DataFrame:
    """Keys of a lookup that carry more than one value, with how many."""
    named = lookup.select(*[c.alias(k) for k, c in keys.items()], F.col(value)).distinct()
    return named.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n_values")).filter("n_values > 1")


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, Column],
    take: Mapping[str, str],
    bounded: bool,
    salts: int,
    spread_by: str,
    grouped: bool = False,
) -> DataFrame:
    """Left join of a lookup that is unique on its keys.

    ``on`` maps lookup columns to fact expressions, ``take`` maps output names to lookup columns.
    A lookup proven small is broadcast. Otherwise each lookup row is repeated once per salt and the fact
    rows of one code, or of no code, are spread over all salts: a hot code fills no single task.

    ``grouped`` says that the lookup is a grouping by its keys. Repeated rows are then grouped by key and salt, which changes no row
    but lets Spark see that they are unique: it leaves out the join where no column taken is read, as it does with
    a broadcast lookup. Grouping and join use one shuffle, with parts enough that salts of one code seldom meet.
    """
    keys = {f"_lk_{i}_{name}": name for i, name in enumerate(on)}
    right = lookup.select(
        *[F.col(name).alias(k) for k, name in keys.items()], *[F.col(c).alias(out) for out, c in take.items()]
    )
    match = [F.col(k) == on[name] for k, name in keys.items()]
    if bounded:
        joined = fact.join(F.broadcast(right), match, "left")
        return joined.drop(*keys)
    right = right.withColumn("_lk_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if grouped:
        right = right.repartition(max(shuffle_tasks(fact.sparkSession), 4 * salts), *keys, "_lk_salt")
        right = right.groupBy(*keys, "_lk_salt").agg(*[F.min(out).alias(out) for out in take])
    left = fact.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    joined = left.join(right, [*match, F.col("_salt") == F.col("_lk_salt")], "left")
    return joined.drop(*keys, "_salt", "_lk_salt")


# A sketch of fixed size finds heavy keys: this many counters, of which the largest are looked at.
SKETCH_COUNTERS, MOST_HEAVY = 100_000, 1_000
# A key is heavy from this many times the rows that one of the shuffle's tasks would get on average.
HEAVY_SHARES = 2


def heavy_keys(rows: DataFrame, columns: Sequence[str], tasks: int) -> dict[str, DataFrame]:
    """(key, parts) of the keys of each column that need more than one of ``tasks`` shuffle tasks; columns without any are left out.

    One scan of these columns; at most ``MOST_HEAVY`` keys a column come to the driver. Counts are estimates,
    which changes how rows are spread and never what a join returns. NULL is no key.
    """
    found = rows.agg(
        F.count("*").alias("_rows"),
        *[F.expr(f"approx_top_k(`{c}`, {MOST_HEAVY}, {SKETCH_COUNTERS})").alias(c) for c in columns],
    ).first()
    heavy = {}
    for column in columns:
        counts = [(e["item"], e["count"] * tasks) for e in found[column] or [] if e["item"] is not None]
        parts = [(key, -(-n // found["_rows"])) for key, n in counts if n > HEAVY_SHARES * found["_rows"]]
        if parts:
            kind = T.StructType([T.StructField("key", rows.schema[column].dataType), T.StructField("parts", T.LongType())])
            heavy[column] = rows.sparkSession.createDataFrame(parts, kind)
    return heavy


def _with_parts(rows: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    known = heavy.select(F.col("key").alias("_heavy"), F.col("parts").alias("_parts"))
    joined = rows.join(F.broadcast(known), F.col(key) == F.col("_heavy"), "left").drop("_heavy")  # at most MOST_HEAVY rows
    return joined.withColumn("_parts", F.coalesce("_parts", F.lit(1)))


def in_parts(fact: DataFrame, entity: DataFrame, key: str, entity_key: str, heavy: DataFrame, spread_by: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``_part`` to join on as well: fact rows of a heavy key are spread over its parts, and its entity row
    is repeated for each. Parts of all keys together are at most the shuffle's tasks plus the heavy keys."""
    left = _with_parts(fact, key, heavy).withColumn("_part", F.pmod(F.xxhash64(spread_by), F.col("_parts"))).drop("_parts")
    numbers = F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)
    right = _with_parts(entity, entity_key, heavy).withColumn("_part", F.explode(numbers)).drop("_parts")
    return left, right


def entity_left_join(
    fact: DataFrame, entity: DataFrame, reference: str, entity_key: str, spread_by: str, heavy: DataFrame | None = None
) -> DataFrame:
    """Left join to a large entity table that is unique on its key.

    References are often absent. An absent one joins nothing, so it takes a stand-in key that varies by row
    and never matches; otherwise all rows without a reference would meet in one task. Hot references are spread by
    ``heavy`` (see ``heavy_keys``); without it they are left to adaptive skew splitting, which may split the fact side.
    """
    stand_in = F.concat(F.lit("/absent/"), F.xxhash64(spread_by).cast("string"))
    keyed = fact.withColumn("_ref", F.coalesce(F.col(reference), stand_in))
    right = entity.withColumnRenamed(entity_key, "_entity_ref")
    same = (F.col("_ref") == F.col("_entity_ref")) & F.col(reference).isNotNull()
    if heavy is not None:
        keyed, right = in_parts(keyed, right, "_ref", "_entity_ref", heavy, spread_by)
        right = right.withColumnRenamed("_part", "_entity_part")
        same = same & (F.col("_part") == F.col("_entity_part"))
    return keyed.join(right, same, "left").drop("_ref", "_entity_ref", "_part", "_entity_part")
