"""Sets of integers as bitmaps: kept per month, united without a look at the rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BYTES = 4096  # of the bitmap of a bucket, as Spark's bitmap functions cut them


def id_bitmaps(df: DataFrame, slots: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, bucket, bitmap) of all integers in ``slots``; NULLs are left out.

    A task sends one bitmap of 4 kB per bucket, however often an id repeats; ids that lie close share a bucket.
    """
    ids = df.select(*by, F.explode(F.array(*slots)).alias("_id")).filter(F.col("_id").isNotNull())
    return ids.groupBy(*by, F.bitmap_bucket_number("_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bitmap"))


def unite(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The union per ``by``: of months that were counted apart, say."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def id_counts(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct ids per ``by``; months may overlap."""
    return unite(bitmaps, by).groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias("ids"))


def ids(bitmaps: DataFrame, name: str) -> DataFrame:
    """The distinct integers of all bitmaps, ``name``."""
    byte = F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(_BYTES)), lambda j: F.conv(
        F.hex(F.expr("bitmap").substr(j, F.lit(1))), 16, 10).cast("int"))).alias("place", "byte")
    bits = unite(bitmaps).select("bucket", byte).filter("byte > 0").select(
        "bucket", "place", "byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
    position = F.expr("cast(place * 8 + bit as bigint)")
    # Positive ids count from bucket 1 on, zero and negative ones from bucket 0 down.
    value = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * _BYTES * 8 + position + 1).otherwise(F.col("bucket") * _BYTES * 8 - position)
    return bits.filter(F.getbit("byte", F.col("bit")) == 1).select(value.alias(name))
