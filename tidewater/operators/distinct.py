"""Exact distinct counts of whole numbers as bitmaps that can be merged.

A value has a bucket of 32,768 and a place in it, so (keys, bucket, bitmap) rows of any two stretches of data merge by OR, whatever values they share,
and counts of months come from the bitmaps of hours without reading a row again. A bitmap has 4 KB however many rows it stands for; sets of
values grow with the values, and sketches are not exact. Values that are not whole numbers have no place; count them by sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WHOLE = ("tinyint", "smallint", "int", "bigint")


def place(of: str) -> tuple[Column, Column]:
    """Bucket and place of a value; both null for null."""
    value = F.expr(of).cast("long")
    return F.bitmap_bucket_number(value), F.bitmap_bit_position(value)


def bitmaps(rows: DataFrame, keys: list[Column | str], of: str) -> DataFrame:
    """(keys, bucket, bitmap) of the values that are not null; built within tasks before the shuffle."""
    if rows.select(F.expr(of)).dtypes[0][1] not in WHOLE:
        raise TypeError(f"{of} is not a whole number")
    bucket, bit = place(of)
    return rows.where(F.expr(of).isNotNull()).groupBy(*keys, bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bitmap"))


def merged(held: DataFrame, keys: list[Column | str]) -> DataFrame:
    """Bitmaps of fewer keys."""
    return held.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(held: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Exact counts per key; buckets share no value, so their counts add up. Bitmaps of one key and bucket must be merged before."""
    return held.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
