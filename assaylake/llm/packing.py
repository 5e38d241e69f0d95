"""Best-fit packing of documents into sequences, planned on the histogram of lengths.

Only counts of lengths reach the driver, at most one per length up to the sequence size. The plan packs whole classes
of equal bins at once and so has few segments: *pieces of this length with these ranks go to sequences from here on,
at this offset*. Every piece then finds its segment by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import groups_for, place_in_group, slices, stored
from assaylake.llm.tokens import tokenizer

SEQUENCE = 2048
END_ID = 0
# Pieces numbered by one task.
PIECES_PER_PART = 100_000


def best_fit(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Segments (length, first rank, count, first sequence, offset), longest pieces first.

    Each piece goes to the fullest open sequence with room; sequences equally full are one class, kept as runs of
    sequence numbers. Work and plan grow with the number of lengths and classes, not with the pieces.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs (first sequence, count)
    segments, opened = [], 0
    for length in sorted((n for n, c in histogram.items() if c), reverse=True):
        rank, left = 0, histogram[length]
        while left:
            free = min((r for r in room if r >= length), default=size)
            fit = min(free // length, left)  # pieces of this length that one sequence takes
            wanted = left // fit
            if free in room:
                first, count = room[free].pop()
                used = min(count, wanted)
                if used < count:
                    room[free].append((first + used, count - used))
                elif not room[free]:
                    del room[free]
            else:
                first, used = opened, wanted
                opened += used
            for j in range(fit):
                segments.append((length, rank, used, first, size - free + j * length))
                rank += used
            left -= fit * used
            rest = free - fit * length
            if rest:
                room.setdefault(rest, []).append((first, used))
    return segments


def pieces(docs: DataFrame, path: str, size: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): whole documents, or pieces of ``size`` tokens of longer ones."""

    def run(batches):
        coder, end = tokenizer(path, 4), end_id.to_bytes(4, "little")
        for batch in slices(batches):
            rows, at = [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, packed in enumerate(coder.encode(texts)):
                packed += end
                for k, begin in enumerate(range(0, len(packed), 4 * size)):
                    part = packed[begin : begin + 4 * size]
                    at.append(i)
                    rows.append((k, begin // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                piece, start, length, crc = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = docs.select("doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit_packing(docs: DataFrame, path: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its sequence: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty: a piece of the end id alone. Every row of the input takes places of its own, also
    where rows repeat or lack a doc_id; equal pieces are interchangeable. An empty table gives an empty result.
    """
    held = stored(pieces(docs, path, size, end_id), "pieces")
    histogram = {r["length"]: r["count"] for r in held.groupBy("length").count().collect()}  # at most ``size`` rows
    segments = sorted(best_fit(histogram, size))
    table = np.array(segments, np.int64).reshape(-1, 5)
    # Length and first rank as one ascending key.
    keys, counts_at = (table[:, 0] << 48) + table[:, 1], table
    parts = groups_for(sum(histogram.values()), PIECES_PER_PART)
    placed = place_in_group(held, ["length"], ["doc_id", "piece", "ids_crc32"], "rank", parts)

    def run(batches):
        for batch in batches:
            rank, length = batch.column("rank").to_numpy(), batch.column("length").to_numpy()
            row = counts_at[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = dict(held.dtypes)["doc_id"]
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
