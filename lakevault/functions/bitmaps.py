"""Exact sets of whole numbers as bitmaps, a row per range of 32,768 numbers that holds one.

Bitmaps of parts are merged by OR, so a distinct count can be put together from slices that
were counted once, and a set too large for one value is many rows. A range costs 4 KB
however few of its numbers are there: numbers should be dense (keys, positions of a hash),
and are counted from 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: numbers of a range: Spark's bitmaps have 4096 bytes
RANGE = 32768
BUCKET, BITS = "bucket", "bits"


def build(df: DataFrame, number: Column, *by: str) -> DataFrame:
    """(by, bucket, bits): the set of ``number`` for each ``by``; nulls are in no set."""
    rows = df.select(*by, number.cast("long").alias("_n")).where(F.col("_n").isNotNull())
    return rows.groupBy(*by, F.bitmap_bucket_number("_n").alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias(BITS)
    )


def merge(sets: DataFrame, *by: str) -> DataFrame:
    """The union of the sets of each ``by``."""
    return sets.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count(sets: DataFrame, *by: str) -> DataFrame:
    """(by, n): how many different numbers the sets of each ``by`` hold."""
    return merge(sets, *by).groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).alias("n"))


def holds(bits: Column, number: Column) -> Column:
    """Whether ``number`` is in the bitmap of its range; false for no bitmap."""
    at = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, F.pmod(at, F.lit(8)).cast("int"))
    return F.coalesce(F.pmod(bit, F.lit(2)) == 1, F.lit(False))
