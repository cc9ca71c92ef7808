"""Ids already collected: novelty, growth and retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RETENTION_DAYS = 90
ISO_DATE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}){0,2}(\.\d+)?([+-]\d{2}:?\d{2}|Z)?)?$"


def unseen(posts: DataFrame, seen: DataFrame, key: str = "id") -> DataFrame:
    """Posts whose id is not in the seen state."""
    return posts.join(seen.select(key), key, "left_anti")


# Bits of the sketch of a day; a day of many more ids than this has a sketch that says nothing.
SKETCH_BITS = 1 << 27


def _bit(key: Column) -> Column:
    """A key's bit in a sketch, counted from 1."""
    return F.pmod(F.xxhash64(key), F.lit(SKETCH_BITS)) + 1


def sketch(seen: DataFrame, day: str, key: str = "id") -> DataFrame:
    """day, seau, bits: bitmaps with a bit for every id of a day, where there are any."""
    bit = _bit(F.col(key))
    return seen.groupBy(day, F.bitmap_bucket_number(bit).alias("seau")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))


def days_of(ids: DataFrame, sketches: DataFrame, day: str, key: str = "id") -> DataFrame:
    """Days that may hold one of the ids; all others hold none of them."""
    bit = _bit(F.col(key))
    asked = ids.select(F.bitmap_bucket_number(bit).alias("seau"), F.bitmap_bit_position(bit).alias("_place")).distinct()
    octet = F.conv(F.hex(F.expr("substring(bits, int(_place div 8) + 1, 1)")), 16, 10).cast("int")
    held = F.expr("shiftright(_octet, int(_place % 8)) & 1") == 1
    # Sketches of one day come from several runs; any of them may hold the bit.
    return asked.join(sketches, "seau").withColumn("_octet", octet).filter(held).select(day).distinct()


def seen_at() -> Column:
    """When an id was first seen; NULL for an unreadable date."""
    return F.when(F.col("vu_le_raw").rlike(ISO_DATE), F.col("vu_le_raw").try_cast("timestamp"))


def first_sightings(posts: DataFrame) -> DataFrame:
    """id, vu_le_raw: the earliest capture of each id."""
    return posts.groupBy("id").agg(F.min("scrape_le").alias("vu_le_raw"))


def retain(seen: DataFrame, now: Column | datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """Drop ids first seen more than ``days`` ago; an unreadable date is kept."""
    at = now if isinstance(now, Column) else F.lit(now)
    return seen.filter(seen_at().isNull() | (seen_at() >= at - F.expr(f"INTERVAL {days} DAYS")))


def next_seen(
    seen: DataFrame, new_posts: DataFrame, now: Column | datetime, days: int = RETENTION_DAYS
) -> DataFrame:
    """The seen state after a run: old entries stay as they are, new ids join them."""
    return retain(seen.unionByName(unseen(first_sightings(new_posts), seen)), now, days)
