"""What the training-data operators share.

A row is a document. ``doc_id`` and ``text`` may be null, and rows may repeat; rows that agree in both are
told apart nowhere and get the same answer, unless an operator gives every row a place of its own.
Operators select the columns they need at once, so further columns of the input never clash with theirs.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.session import scratch_path

# Characters that separate words: space and the controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
# Text handed to one Python group at a time.
GROUP_BYTES = 8 * 1024 * 1024


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps survive lost executors and reuse it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame) -> DataFrame:
    """(row, _id, _v): whole rows, beside hashes of doc_id and text to join by; the names in a row clash with nothing."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return whole.select("row", F.xxhash64("row.doc_id").alias("_id"), F.xxhash64("row.text").alias("_v"))


def word_count(text: Column) -> Column:
    """Number of words, without building them: every word starts where no word character stands before."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.coalesce(
        F.size(F.filter(F.split(spaced, " "), lambda piece: piece != "")).cast("long"), F.lit(0)
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row: an optimiser may otherwise repeat it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def groups_for(total: int, each: int = GROUP_BYTES) -> int:
    """How many groups of about ``each`` hold ``total``: grows with the data, so groups do not."""
    return max(1, -(-int(total) // each))


def ranked(df: DataFrame, order: list[str], rank: str, label: str) -> DataFrame:
    """``df`` with its 0-based place in the order, found without sorting everything in one task.

    Ranges are sorted apart and stored with their row numbers; the counts of the ranges, one row each, give
    every range its first place.
    """
    sorted_ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    held = stored(sorted_ranges.withColumn("_at", at), label)
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = held.groupBy(part.alias("_part")).count().collect()  # one row per range
    first, total = {}, 0
    for one in sorted(counts):
        first[one["_part"]] = total
        total += one["count"]
    firsts = df.sparkSession.createDataFrame(list(first.items()) or [(0, 0)], "_part long, _first long")
    placed = held.withColumn("_part", part).join(F.broadcast(firsts), "_part")  # one row per range again
    return placed.withColumn(rank, F.col("_first") + row).select(*df.columns, rank)


def place_in_group(df: DataFrame, group: list[str], order: list[str], place: str, parts: int) -> DataFrame:
    """``df`` with a gapless 0-based place within ``group``; a group of any size is numbered in ``parts`` parts.

    Rows are spread over parts by a hash of ``order``; parts are numbered apart and then put one behind the
    other. Rows equal in ``order`` are interchangeable.
    """
    from pyspark.sql import Window as W

    spread = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    keys = [*group, "_part"]
    counts = spread.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    numbered = spread.withColumn("_row", F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1)
    return (
        numbered.join(offsets, keys)
        .withColumn(place, (F.col("_before") + F.col("_row")).cast("long"))
        .drop("_before", "_row", "_part")
    )


def single_thread() -> None:
    """Spark runs a task per core; libraries must not start threads of their own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def slices(batches, rows: int = 1024):
    """Arrow batches in pieces, so that only few texts are Python strings at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)
