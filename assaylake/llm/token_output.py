"""Token ids as binary files: frequency ranks in variable-length bytes, control bytes apart.

Frequent ids get small ranks, and a rank takes one to four whole bytes. The lengths of four ranks make one control
byte; control and data bytes are separate columns of Parquet files, one row per document, in ascending doc_id order.
A reader looks every control byte up in a table of 256 rows and gathers all values of a document at once.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm.common import groups_for, slices, stored, text_bytes
from assaylake.llm.tokens import tokenizer
from assaylake.session import scratch_path

END_ID = 2
# Bytes of text whose ids one output file holds.
FILE_TEXT = 32 * 1024 * 1024

# The four lengths of a control byte.
_LENGTHS = (1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3)).astype(np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes. Ranks are below 2**32."""
    ranks = ranks.astype("<u4")
    lengths = (ranks > 0xFF).view(np.uint8) + (ranks > 0xFFFF).view(np.uint8) + (ranks > 0xFFFFFF).view(np.uint8)
    widest = int(lengths.max(initial=0)) + 1
    rows = ranks.view(np.uint8).reshape(-1, 4)[:, :widest]
    data = rows[np.arange(widest, dtype=np.uint8) <= lengths[:, None]]
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = lengths
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    offsets = np.cumsum(lengths, dtype=np.int64) - lengths
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    value = padded[offsets].astype(np.uint32)
    for byte in range(1, int(lengths.max(initial=1))):
        value |= (padded[offsets + byte] * (lengths > byte)).astype(np.uint32) << np.uint32(8 * byte)
    return value


def _tokenised(docs: DataFrame, path: str, end_id: int, width: int) -> DataFrame:
    """(doc_id, n_tokens, ids): ids packed in ``width`` bytes and compressed."""

    def run(batches):
        coder, squeeze = tokenizer(path, width), zstandard.ZstdCompressor(level=1)
        end = end_id.to_bytes(width, "little")
        for batch in slices(batches):
            ids, counts = [], []
            for packed in coder.encode([t or "" for t in batch.column("text").to_pylist()]):
                counts.append(len(packed) // width + 1)
                ids.append(squeeze.compress(packed + end))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"]
            )

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, ids binary")


def _unpacked(blob: bytes, width: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), f"<u{width}")


def frequency_ranks(tokenised: DataFrame, vocabulary: int, width: int) -> np.ndarray:
    """Ids by falling frequency, then by id. The driver sees one count per id of the vocabulary."""

    def run(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for blob in batch.column("ids").to_pylist():
                total += np.bincount(_unpacked(blob, width), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    counts = tokenised.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    total = np.zeros(vocabulary, np.int64)
    for row in counts.toLocalIterator():
        total[row["id"]] = row["n"]
    return np.argsort(-total, kind="stable").astype("<u4")


def write_tokens(docs: DataFrame, path: str, target: str, end_id: int = END_ID, vocabulary: int | None = None) -> None:
    """Write ``target``/tokens and ``target``/ids (the id of every rank).

    Null text counts as empty and so holds the end id alone. Rows without doc_id come first; rows that share a
    doc_id keep places of their own, in the order of their ids. An empty table gives empty files.
    """
    from tokenizers import Tokenizer

    vocabulary = vocabulary or max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1)
    width = 2 if vocabulary <= 1 << 16 else 4
    held = stored(_tokenised(docs, path, end_id, width), "token-ids")
    by_rank = frequency_ranks(held, vocabulary, width)
    rank_of = np.empty(vocabulary, "<u4")
    rank_of[by_rank] = np.arange(vocabulary, dtype="<u4")

    def run(batches):
        at = 0
        for batch in batches:
            rows = []
            for blob in batch.column("ids").to_pylist():
                rows.append(encode_ranks(rank_of[_unpacked(blob, width)]))
            counts = batch.column("n_tokens").to_numpy()
            begins = at + np.cumsum(counts) - counts
            at += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(begins), batch.column("n_tokens")]
                + [pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1)],
                names=["doc_id", "part", "start_in_part", "n_tokens", "control", "data"],
            )

    files = groups_for(text_bytes(docs), FILE_TEXT)
    ordered = held.repartitionByRange(files, "doc_id", "n_tokens").sortWithinPartitions("doc_id", "n_tokens", "ids")
    ordered = ordered.withColumn("part", F.spark_partition_id())
    kind = dict(ordered.dtypes)["doc_id"]
    ordered.mapInArrow(
        run, f"doc_id {kind}, part int, start_in_part long, n_tokens long, control binary, data binary"
    ).write.option("compression", "uncompressed").parquet(f"{target}/tokens")
    spark = docs.sparkSession
    ranks = spark.createDataFrame(list(enumerate(by_rank.tolist())), "rank long, id long")
    ranks.coalesce(1).write.parquet(f"{target}/ids")  # as long as the vocabulary


def read_tokens(spark: SparkSession, target: str, run, schema: str) -> DataFrame:
    """Decode the files and hand ``run(doc_id, start, ids)`` every document; it gives the values after ``doc_id``.

    ``start`` counts the ids of all documents before it: its place in the file plus the ids of the files before,
    which one row per file tells.
    """
    held = spark.read.parquet(f"{target}/tokens")
    totals = {r["part"]: r["n"] for r in held.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    firsts, total = {}, 0
    for part in sorted(totals):
        firsts[part], total = total, total + totals[part]
    by_rank = np.zeros(max(1, spark.read.parquet(f"{target}/ids").count()), "<u4")
    for r in spark.read.parquet(f"{target}/ids").toLocalIterator():
        by_rank[r["rank"]] = r["id"]
    names = [c.split()[0] for c in schema.split(", ")]

    def decode(batches):
        for batch in batches:
            rows = []
            for at, part, begin, n, control, data in zip(*[c.to_pylist() for c in batch.columns]):
                rows.append((at, *run(at, firsts[part] + begin, by_rank[decode_ranks(control, data, n)])))
            if rows:
                columns = [batch.column(0)] + [pa.array(c) for c in list(zip(*rows))[1:]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names])

    rows = held.select("doc_id", "part", "start_in_part", "n_tokens", "control", "data")
    return rows.mapInArrow(decode, f"doc_id {dict(rows.dtypes)['doc_id']}, {schema}")


def token_digests(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Write the token files to the shared folder and return, from them: doc_id, start, n_tokens, ids_crc32."""
    target = scratch_path(docs.sparkSession, "token-files")
    write_tokens(docs, path, target, end_id)

    def digest(_, start, ids):
        return start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())

    return read_tokens(docs.sparkSession, target, digest, "start long, n_tokens long, ids_crc32 long")
