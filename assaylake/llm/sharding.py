"""Shards of nearly equal bytes that keep groups of equal texts together.

Longest-processing-time scheduling: items sorted by size go, one by one, to the least-loaded shard, which a heap
tells. Groups above a small share of a shard are items of their own; there can only be so many. Smaller groups are
pre-aggregated into a fixed number of bundles by a hash of the text. So the heap sees a bounded number of items,
whatever the number of documents, and a bundle is too small to tip a shard.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import groups_for, keyed, place_in_group, stored

SHARDS = 24
# Bytes that a document takes besides its text.
OVERHEAD = 8
# Bundles of small groups, and most groups that are items of their own, per shard.
BUNDLES_PER_SHARD = 2_000
# Documents numbered by one task.
ROWS_PER_PART = 100_000


def least_loaded(items: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Shard of every (size, item): largest first, each to the shard with least so far; ties by item and shard."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, item in sorted(items, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        placed[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def balanced_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    Null text counts as an empty one, and is in one group with empty texts. Every row has a slot of its own, also
    where rows repeat or lack a doc_id. Loads differ by no more than the largest item that has to stay together.
    An empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select(
            "doc_id",
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("digest"),
        ),
        "shard-rows",
    )
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    most = shards * BUNDLES_PER_SHARD
    large = max(1, total // most)
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    # Groups above total / most: fewer than ``most``, so they may be broadcast and listed.
    own = groups.filter(F.col("size") > large)
    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("digest"), F.lit(most)))
    item = F.when(F.col("size") > large, F.col("digest")).otherwise(bundle)
    sizes = groups.groupBy(item.alias("item")).agg(F.sum("size").alias("size")).collect()  # at most 2 * most rows
    shard_of = least_loaded([(r["size"], r["item"]) for r in sizes], shards)
    spark = docs.sparkSession
    plan = spark.createDataFrame(list(shard_of.items()), "item string, shard int")
    named = rows.join(F.broadcast(own.select("digest", F.lit(True).alias("alone"))), "digest", "left")
    named = named.withColumn("item", F.when(F.col("alone"), F.col("digest")).otherwise(bundle))
    placed = named.join(F.broadcast(plan), "item").select("doc_id", "size", "text_crc32", "shard")
    slots = place_in_group(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot", groups_for(count, ROWS_PER_PART))
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, target: str, shards: int = SHARDS) -> None:
    """The documents themselves, in one folder per shard; a document is found by doc_id and checksum of its text."""
    places = balanced_shards(docs, shards).select(F.xxhash64("doc_id").alias("_id"), "text_crc32", "shard").distinct()
    rows = keyed(docs).withColumn("text_crc32", F.crc32(F.coalesce("row.text", F.lit("")).cast("binary")))
    found = rows.join(places, ["_id", "text_crc32"]).select(*[F.col(f"row.`{c}`") for c in docs.columns if c != "shard"], "shard")
    found.hint("rebalance", "shard").write.partitionBy("shard").parquet(target)
