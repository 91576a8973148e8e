"""A filter of fixed size that tells rows whose hash is surely not in a set from those that need a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: 2 MB whatever the set.
FILTER_BITS = 1 << 24


def with_hit(df: DataFrame, name: str, mark: Column, hashes: DataFrame) -> DataFrame:
    """*df* and a column *name*: false where *mark*, a 64-bit hash, is not among *hashes*, a table of one column.

    It is true for all that are, and for others that share their bit. The filter is
    broadcast, so that neither side is shuffled but for the bits.
    """
    # FILTER_BITS / 32768 rows of 4 kB
    marks = F.broadcast(_bit_filter(hashes.toDF("__hash")))
    slot = F.pmod(mark, F.lit(FILTER_BITS)) + 1
    marked = df.select("*", slot.alias("__slot")).withColumn("__bucket", F.bitmap_bucket_number("__slot"))
    hit = F.coalesce(_bit_is_set(F.col("__bits"), F.bitmap_bit_position("__slot")), F.lit(False))
    return marked.join(marks, "__bucket", "left").select(*(F.col(f"`{c}`") for c in df.columns), hit.alias(name))


def _bit_filter(hashes: DataFrame) -> DataFrame:
    """``(__bucket, __bits)``: a bit for every hash, at its place modulo FILTER_BITS."""
    slots = hashes.select((F.pmod("__hash", F.lit(FILTER_BITS)) + 1).alias("slot"))
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("__bits")
    )


def _bit_is_set(bits: Column, position: Column) -> Column:
    byte = F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.getbit(value, (position % 8).cast("int")) == 1
