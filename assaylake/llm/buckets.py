"""Questions that the documents of a bucket ask about keys they share with other buckets.

Documents lie in buckets of bounded size. A bucket sends its different keys, sorted, to ranges of keys; a range
answers every bucket it heard from with one value per key, in the same order. So an answer needs no key, a key that
all documents share is sent once per bucket, and the bucket finds the keys again from its own texts. The texts are
shuffled once: all passes over them in one plan read the same exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASK = "part int, bucket int, size long, keys binary, counts binary"
# Bytes of a key that travel: the highest ones. Keys that agree in them count as one, which may only make a key
# look shared; the exact comparison comes later.
KEY_BYTES = 6
ANSWER = "bucket int, kind int, part int, body binary"


def bucketed(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, doc_id, version, text), version being a hash of the text: equal rows share a bucket."""
    bucket = F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int")
    return docs.select(bucket.alias("bucket"), "doc_id", F.xxhash64("text").alias("version"), F.coalesce("text", F.lit("")).alias("text"))


def asked(bucket: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> pa.Table:
    """One row per range of keys. ``keys``: sorted and different, uint64; ``counts``: uint8."""
    cuts = np.searchsorted(keys, part_starts(parts))
    ends = [*cuts[1:].tolist(), len(keys)]
    packed = keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
    rows = [(p, bucket, e - b, packed[b:e].tobytes(), counts[b:e].tobytes()) for p, (b, e) in enumerate(zip(cuts.tolist(), ends)) if e > b]
    return pa.Table.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
        names=["part", "bucket", "size", "keys", "counts"],
    )


def part_starts(parts: int) -> np.ndarray:
    return np.array([(i << 64) // parts for i in range(parts)], np.uint64)


def answer_totals(table: pa.Table) -> pa.Table:
    """For every bucket that asked, the sum of the counts of each of its keys, up to 255."""
    sizes = table["size"].to_numpy()
    keys = np.zeros((int(sizes.sum()), 8), np.uint8)
    at = 0
    for n, packed in zip(sizes.tolist(), table["keys"]):  # one after the other: only one copy of all keys is held
        keys[at : at + n, :KEY_BYTES] = np.frombuffer(packed.as_buffer(), np.uint8).reshape(-1, KEY_BYTES)
        at += n
    keys = keys.view(">u8").ravel().byteswap(inplace=True).view(np.uint64)
    counts = np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint8)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    total = len(keys)
    del keys
    sums = np.add.reduceat(counts[order], first, dtype=np.int64)
    per_key = np.repeat(np.minimum(sums, 255).astype(np.uint8), np.diff(np.append(first, total)))
    answers = np.empty(total, np.uint8)
    answers[order] = per_key
    bodies = [x.tobytes() for x in np.split(answers, np.cumsum(sizes)[:-1])]
    n = table.num_rows
    return pa.Table.from_arrays(
        [table["bucket"].combine_chunks(), pa.array([0] * n, pa.int32()), table["part"].combine_chunks(), pa.array(bodies, pa.binary())],
        names=["bucket", "kind", "part", "body"],
    )


def answers(table: pa.Table, kind: int, dtype) -> np.ndarray:
    """The answers of a kind in the order in which the bucket's keys were sent."""
    rows = sorted((p, b) for k, p, b in zip(table["kind"].to_pylist(), table["part"].to_pylist(), table["body"].to_pylist()) if k == kind)
    return np.frombuffer(b"".join(b for _, b in rows), dtype)
