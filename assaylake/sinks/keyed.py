"""Tables with one row per key that are kept up to date by changes, not rewritten.

A change writes the rows that are new or different as a further generation and rewrites only those folders that hold a
key which changed or went; folders without such a key are named again by the next version, untouched.

``KeyedStore`` spreads rows over buckets by a hash of the key. Each generation has its own number of buckets, a power of
two that grows with its rows, so a small night makes few folders. A generation carries a Bloom index of its keys: one
bit map of 32,768 bits per word, two bits per key. Looking for keys reads the index and then only folders that may hold
one. ``DayStore`` has a folder per day and generation; its callers know on which days a key's rows may lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.functions.bitmaps import is_set
from assaylake.session import remove_scratch, scratch_path
from assaylake.sinks.snapshots import GENERATION, Entry, Snapshot, SnapshotTable

BUCKET = "bucket"
# Generations (of a store) or folders (of a day) before the smaller ones are folded into the next write.
MOST_RUNS = 8
WORD_BITS, BITS_PER_KEY = 32_768, 16
INSERTED, CHANGED, WITHDRAWN = "inserted", "changed", "withdrawn"


def power_of_two(least: int) -> int:
    return 1 << max(0, least - 1).bit_length()


def same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def differences(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str], place: Sequence[str]) -> DataFrame:
    """(key, kind, old, new, place...) of rows that differ; ``old`` carries its place, rows are structs of ``columns``.

    Both sides have one row per key. Rows that are equal in all columns are no change.
    """
    pack = lambda: F.struct(*[F.col(f"`{c}`") for c in columns])
    left = old.select(F.col(key).alias("_old_key"), pack().alias("old"), *place)
    right = new.select(F.col(key).alias("_new_key"), pack().alias("new"))
    both = left.join(right, same("_old_key", "_new_key"), "full")
    kind = F.when(F.col("old").isNull(), INSERTED).when(F.col("new").isNull(), WITHDRAWN)
    kind = kind.when(~F.col("old").eqNullSafe(F.col("new")), CHANGED)
    whole_key = F.when(F.col("new").isNotNull(), F.col("_new_key")).otherwise(F.col("_old_key"))
    return both.select(whole_key.alias(key), kind.alias("kind"), "old", "new", *place).filter("kind is not null")


class Changes:
    """Stored differences of one table, and how many folders taking them in rewrote."""

    def __init__(self, rows: DataFrame, key: str, path: str | None):
        self.rows, self.key, self.path = rows, key, path
        self.rewritten = self.written = 0

    def news(self) -> DataFrame:
        """Rows as they are now."""
        return self.rows.filter("new is not null").select("new.*")

    def olds(self) -> DataFrame:
        """Rows as they were."""
        return self.rows.filter("old is not null").select("old.*")

    def appeared_or_gone(self) -> DataFrame:
        """Rows whose key came or went, one struct ``row`` each."""
        return self.rows.filter(F.col("kind") != CHANGED).select(F.coalesce("new", "old").alias("row"))

    def drop(self) -> None:
        if self.path:
            remove_scratch(self.rows.sparkSession, self.path)


class _Store:
    """What both kinds of stores share."""

    table: SnapshotTable
    key: str
    order: tuple[str, ...]

    @property
    def place(self) -> tuple[str, str]:
        return GENERATION, self.table.part

    def read(self, snapshot: Snapshot | None = None) -> DataFrame:
        return self.table.read(snapshot).select(*self.columns)

    def exists(self) -> bool:
        return bool(self.table.versions())

    def kept_changes(self, differing: DataFrame) -> Changes:
        """Differences, computed once and stored in the shared folder."""
        path = scratch_path(differing.sparkSession, "changes")
        differing.write.parquet(path)
        return Changes(differing.sparkSession.read.schema(differing.schema).parquet(path), self.key, path)

    def entry_of(self, row) -> Entry:
        value = row[self.table.part]
        return Entry(row[GENERATION], f"{self.table.part}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")

    def folders(self, rows: DataFrame) -> list[Entry]:
        """Folders that these located rows come from: one row per folder comes back."""
        return [self.entry_of(r) for r in rows.select(*self.place).distinct().collect()]

    def take_in(self, changes: Changes, base: Snapshot) -> Snapshot:
        """Publish the table with its changes; without any, nothing is written."""
        touched = self.folders(changes.rows.filter("old is not null"))
        if not touched and changes.rows.isEmpty():
            return base
        folded = self.crowded(base, touched, changes.news())
        replaced = sorted({*touched, *folded})
        gone = changes.rows.filter("old is not null").select(F.col(self.key).alias("_gone"))
        held = self.table.read(entries=replaced).select(*self.columns)
        kept = held.join(gone, same(self.key, "_gone"), "left_anti")
        new = self.publish(kept.unionByName(changes.news().select(*self.columns)), base, set(base.entries) - set(replaced))
        changes.rewritten, changes.written = len(touched), len([e for e in new.entries if e not in base.entries])
        return new

    def replace(self, rows: DataFrame) -> Snapshot:
        """The table made of these rows; readers of older versions are not disturbed."""
        return self.publish(rows.select(*self.columns), self.table.current(), set())

    def crowded(self, base: Snapshot, touched: Sequence[Entry], news: DataFrame) -> list[Entry]:
        raise NotImplementedError

    def publish(self, rows: DataFrame, base: Snapshot, others: set[Entry]) -> Snapshot:
        raise NotImplementedError


class KeyedStore(_Store):
    """Rows in hash buckets with an index of their keys; ``schema`` is that of the rows, without the bucket."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, rows_per_bucket: int):
        self.columns, self.rows_schema, self.key, self.order = schema.names, schema, key, (key,)
        self.rows_per_bucket = rows_per_bucket
        self.table = SnapshotTable(spark, path, T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())]), BUCKET)

    def _index(self, generation: int) -> str:
        return f"{self.table.path}/index/{GENERATION}={generation}"

    def crowded(self, base: Snapshot, touched: Sequence[Entry], news: DataFrame) -> list[Entry]:
        """Too many generations: the smaller half, by rows, joins the write."""
        alive = sorted(base.generations(), key=lambda g: (base.facts[g]["rows"], g))
        small = set(alive[: len(alive) - MOST_RUNS // 2]) if len(alive) >= MOST_RUNS else set()
        return [e for e in base.entries if e.generation in small]

    def publish(self, rows: DataFrame, base: Snapshot, others: set[Entry]) -> Snapshot:
        # The rows are made once: without their number there are no buckets, and counting would make them twice.
        spark = self.table.spark
        path = scratch_path(spark, "keyed")
        rows.write.parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
        count = rows.count()
        facts: dict[int, dict[str, int]] = {}
        entries: tuple[Entry, ...] = ()
        if count:
            buckets = power_of_two(-(-count // self.rows_per_bucket))
            placed = rows.withColumn(BUCKET, bucket_of(F.col(self.key), F.lit(buckets)))
            generation, entries = self.table.write(placed, self.order)
            words = max(1, -(-count * BITS_PER_KEY // (buckets * WORD_BITS)))
            keys = self.table.read(entries=entries).select(self.key, BUCKET)
            key_index(keys, self.key, words).write.mode("overwrite").parquet(self._index(generation))
            facts[generation] = {"rows": count, "buckets": buckets, "words": words}
        new = self.table.publish(base, {*others, *entries}, facts)
        remove_scratch(spark, path)
        return new

    def may_hold(self, keys: DataFrame, snapshot: Snapshot) -> list[Entry]:
        """Folders that may hold one of the keys, by the index; no folder with such a key is missing."""
        alive = sorted(snapshot.generations())
        if not alive:
            return []
        spark = self.table.spark
        runs = F.array(
            *[
                F.struct(F.lit(g).cast("long").alias(GENERATION), *[F.lit(snapshot.facts[g][n]).alias(n) for n in ("buckets", "words")])
                for g in alive
            ]
        )
        asked = keys.select(F.col(self.key).alias("_key")).distinct().withColumn("_run", F.explode(runs))
        asked = asked.select(
            F.col(f"_run.{GENERATION}").alias("_generation"),
            bucket_of(F.col("_key"), F.col("_run.buckets")).alias("_bucket"),
            word_of(F.col("_key"), F.col("_run.words")).alias("_word"),
            F.array(*bits_of(F.col("_key"))).alias("_bits"),
        ).distinct()
        schema = f"{BUCKET} int, word int, bits binary, {GENERATION} long"
        index = spark.read.schema(schema).option("basePath", f"{self.table.path}/index").parquet(*map(self._index, alive))
        hit = (
            (F.col(GENERATION) == F.col("_generation"))
            & (F.col(BUCKET) == F.col("_bucket"))
            & (F.col("word") == F.col("_word"))
        )
        found = index.join(asked, hit).filter(is_set(F.col("bits"), F.col("_bits")[0]) & is_set(F.col("bits"), F.col("_bits")[1]))
        entries = set(snapshot.entries)
        return [e for r in found.select(GENERATION, BUCKET).distinct().collect() if (e := self.entry_of(r)) in entries]

    def rows_of(self, keys: DataFrame, snapshot: Snapshot) -> DataFrame:
        """Rows of these keys, with their place; only folders that may hold one are read."""
        held = self.table.read(entries=self.may_hold(keys, snapshot), located=True)
        wanted = keys.select(F.col(self.key).alias("_wanted")).distinct()
        return held.join(wanted, same(self.key, "_wanted"), "left_semi")


class DayStore(_Store):
    """Rows in a folder per day; the files of a day hold ranges of the cluster columns that do not overlap."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, day: str, cluster_by: Sequence[str] = ()):
        self.columns, self.rows_schema, self.key = schema.names, schema, key
        self.order = tuple(dict.fromkeys((*cluster_by, key)))
        self.table = SnapshotTable(spark, path, schema, day)

    def crowded(self, base: Snapshot, touched: Sequence[Entry], news: DataFrame) -> list[Entry]:
        """Days with too many folders, among those that the write adds to anyway."""
        per: dict[str, int] = {}
        for e in base.entries:
            per[e.part] = per.get(e.part, 0) + 1
        full = {part for part, n in per.items() if n >= MOST_RUNS}
        if not full:
            return []
        gained = {self.part_of(r[0]) for r in news.select(self.table.part).distinct().collect()}
        return [e for e in base.entries if e.part in full & gained]

    def part_of(self, day) -> str:
        return f"{self.table.part}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"

    def publish(self, rows: DataFrame, base: Snapshot, others: set[Entry]) -> Snapshot:
        # The rows are made once, although their ranges are sampled first.
        spark = self.table.spark
        path = scratch_path(spark, "days")
        rows.write.parquet(path)
        _, entries = self.table.write(spark.read.schema(rows.schema).parquet(path), self.order)
        new = self.table.publish(base, {*others, *entries})
        remove_scratch(spark, path)
        return new

    def rows_of(self, keys: DataFrame, snapshot: Snapshot) -> DataFrame:
        """Rows of these keys, with their place; ``keys`` names the only day each of them may lie on: (key, day)."""
        days = [r[0] for r in keys.select(self.table.part).distinct().collect()]  # one row per day
        held = self.table.read(entries=snapshot.of_parts(map(self.part_of, days)), located=True)
        wanted = keys.select(F.col(self.key).alias("_wanted")).distinct()
        return held.join(wanted, same(self.key, "_wanted"), "left_semi")


# ---- buckets and index ----


def bucket_of(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key), buckets).cast("int")


def word_of(key: Column, words: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), words).cast("int")


def bits_of(key: Column) -> tuple[Column, Column]:
    spread = F.xxhash64(key, F.lit(2))
    return F.pmod(spread, F.lit(WORD_BITS)), F.pmod(F.shiftrightunsigned(spread, 32), F.lit(WORD_BITS))


def key_index(keys: DataFrame, key: str, words: int) -> DataFrame:
    """(bucket, word, bits): bit maps with two bits per key."""
    column = F.col(key)
    spread = keys.select(BUCKET, word_of(column, F.lit(words)).alias("word"), F.explode(F.array(*bits_of(column))).alias("_bit"))
    return spread.groupBy(BUCKET, "word").agg(F.bitmap_construct_agg("_bit").alias("bits"))
