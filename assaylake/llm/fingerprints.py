"""Document fingerprints from content-defined chunks.

A gear hash over the last 32 bytes decides where chunks end, so an edit moves only the boundaries near it. Chunking is
normalised: below the usual length a boundary must match a longer mask, above it a shorter one, which keeps lengths
near the usual. The fingerprint lists the digest and length of each different chunk; the share of a document's bytes
whose chunks another fingerprint holds is its containment in it.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from assaylake.llm.common import GROUP_BYTES, groups_for, stored

# Bytes: no chunk but the last is shorter or longer than these; boundaries get easier beyond the usual length.
LEAST, USUAL, MOST = 16, 64, 256
# Bits of the hash that must be zero at a boundary, below and above the usual length.
STRICT_BITS, LOOSE_BITS = 7, 5

_GEAR = np.array([zlib.crc32(bytes([i, 0x9E, 0x37])) for i in range(256)], np.uint32)


def gear_hash(data: bytes) -> np.ndarray:
    """At every byte the sum of gear values of the last 32 bytes, each shifted by its distance."""
    h = _GEAR[np.frombuffer(data, np.uint8)]
    reach = 1
    while reach < 32:  # from windows of ``reach`` bytes to windows twice as long
        wider = h.copy()
        wider[reach:] += h[:-reach] << np.uint32(reach)
        h, reach = wider, 2 * reach
    return h


def chunk_ends(data: bytes) -> list[int]:
    if not data:
        return []
    h = gear_hash(data)
    loose = np.flatnonzero((h >> np.uint32(32 - LOOSE_BITS)) == 0)
    strict = loose[(h[loose] >> np.uint32(32 - STRICT_BITS)) == 0] + 1
    loose = (loose + 1).tolist()
    strict = strict.tolist()
    ends, begin, size, i, j = [], 0, len(data), 0, 0
    while size - begin > LEAST:
        end = min(begin + MOST, size)
        while i < len(strict) and strict[i] < begin + LEAST:
            i += 1
        if i < len(strict) and strict[i] <= min(begin + USUAL, end):
            end = strict[i]
        else:
            while j < len(loose) and loose[j] <= begin + USUAL:
                j += 1
            if j < len(loose) and loose[j] < end:
                end = loose[j]
        ends.append(end)
        begin = end
    if begin < size:
        ends.append(size)
    return ends


def chunks(data: bytes) -> dict[str, int]:
    """Digest -> length of every different chunk."""
    found, begin = {}, 0
    for end in chunk_ends(data):
        found[xxhash.xxh3_64_hexdigest(data[begin:end])[:12]] = end - begin
        begin = end
    return found


def fingerprint(found: dict[str, int]) -> str:
    return ";".join(f"{digest}:{length}" for digest, length in sorted(found.items()))


def containment(of: dict[str, int], within: dict[str, int]) -> float:
    """Share of the bytes of ``of`` whose chunks are also in ``within``; an empty text is like an empty text only."""
    total = sum(of.values())
    if not total:
        return float(not within)
    return sum(length for digest, length in of.items() if digest in within) / total


# Blocks of consecutive documents; what the driver knows of a block is its first and last document.
MOST_BLOCKS = 100_000


def _edges(docs: DataFrame) -> list[tuple[tuple, tuple]]:
    """First and last (doc_id, version) of every block of the ascending order, about equal in bytes."""
    key = ["doc_id", "version"]
    sizes = docs.groupBy("doc_id", F.xxhash64("text").alias("version"))
    sizes = sizes.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64).alias("bytes"))
    held = stored(sizes, "text-sizes")
    total = held.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    block = max(GROUP_BYTES, total // MOST_BLOCKS)
    ranges = held.repartitionByRange(groups_for(total, 64 * block), *key).sortWithinPartitions(*key)
    ranges = stored(ranges.withColumn("at", F.monotonically_increasing_id()), "text-order")
    # A range is cut wherever its running total passes a block.
    part = F.shiftright("at", 33).alias("part")
    running = F.sum("bytes").over(W.partitionBy("part").orderBy("at").rowsBetween(W.unboundedPreceding, -1))
    cut = ranges.select("*", part).withColumn("block", F.floor(F.coalesce(running, F.lit(0)) / block))
    ends = cut.groupBy("part", "block").agg(F.min_by(F.struct(*key), "at").alias("low"), F.max_by(F.struct(*key), "at").alias("high"))
    return [(tuple(r["low"]), tuple(r["high"])) for r in ends.orderBy("part", "block").collect()]


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last third replaced by the beginning of the next document in descending order of doc_id
    (rows without one come last; the first follows the last). Null text counts as empty: no chunks, an empty
    fingerprint, likeness 1 to an empty text and 0 to any other. Rows that share a doc_id are ordered by the hash of
    their text; equal rows follow each other. A single document is its own next one. An empty table gives an empty
    result. Every text moves once, to the block of its neighbours; a task holds two documents at a time.
    """
    edges = _edges(docs)
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    if not edges:
        return spark.createDataFrame([], schema)
    order = lambda k: (k[0] is not None, k[0] if k[0] is not None else 0, k[1])  # noqa: E731  nulls first, as Spark sorts
    lows = [order(low) for low, _ in edges]
    # The document after a block's last one in descending order is the highest of the block below.
    guest_of: dict[tuple, list[int]] = {}
    for block in range(len(edges)):
        guest_of.setdefault(edges[block - 1][1], []).append(block)

    def deal(batches):
        for batch in batches:
            at, block, guest = [], [], []
            for i, k in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("version").to_pylist())):
                at.append(i)
                block.append(bisect.bisect_right(lows, order(k)) - 1)
                guest.append(False)
                for other in guest_of.get(k, ()):
                    at.append(i)
                    block.append(other)
                    guest.append(True)
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int32()), pa.array(guest, pa.bool_()), *taken.columns], names=["block", "guest", *batch.schema.names]
            )

    def run(batches):
        block, at, text, found = None, None, None, None  # the document that waits for its next one
        for batch in batches:
            ids, out = [], []
            for new_block, new_at, guest, new_text in zip(*[batch.column(c).to_pylist() for c in ("block", "doc_id", "guest", "text")]):
                waiting = block == new_block
                if guest and not waiting:
                    continue  # a copy of the guest that was already used
                new_found = chunks(new_text.encode())
                if waiting:
                    cut = len(text) // 3
                    edited = (text[: len(text) - cut] + new_text[:cut]).encode()
                    changed = chunks(edited)
                    ids.append(at)
                    out.append(
                        (len(text), hashlib.sha256(edited).hexdigest(), fingerprint(found), fingerprint(changed), containment(found, changed), containment(found, new_found))
                    )
                block, at, text, found = (None, None, None, None) if guest else (new_block, new_at, new_text, new_found)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("doc_id").type), *[pa.array(c) for c in zip(*out)]], names=names)

    names = [c.split()[0] for c in schema.split(", ")]
    rows = docs.select("doc_id", F.xxhash64("text").alias("version"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.mapInArrow(deal, f"block int, guest boolean, doc_id {kind}, version long, text string")
    together = dealt.repartition(len(edges), "block").sortWithinPartitions("block", "guest", F.desc("doc_id"), F.desc("version"))
    return together.select("block", "guest", "doc_id", "text").mapInArrow(run, schema)
