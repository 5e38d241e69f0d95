"""Sets of whole numbers as bit maps of 32,768 bits, one row per bucket of numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_set(bits: Column, position: Column) -> Column:
    """Whether a bit is set; NULL where there is no bit map."""
    octet = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(octet, (position % 8).cast("int")) == 1


def bitmaps(ids: DataFrame, column: str) -> DataFrame:
    """(bucket, bits): every number of the column; NULLs are left out."""
    known = ids.select(F.col(column).cast("long").alias("id")).filter("id is not null")
    placed = known.select(F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("_bit"))
    return placed.groupBy("bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def holds(bits: Column, number: Column) -> Column:
    return F.coalesce(is_set(bits, F.bitmap_bit_position(number)), F.lit(False))
