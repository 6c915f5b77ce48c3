"""Rows whose key can't be among chosen ones, told where they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 27


def with_may_be_in(rows: DataFrame, chosen: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds ``name``: false only where a row's ``keys`` aren't in ``chosen``.

    One bit per hash of a chosen key, 16 bits or more a key, at most ``FILTER_BITS``
    (16 MB) in all, are sent to the tasks; so rows that can't meet ``chosen`` are known
    where they are read and needn't be shuffled. A null key is a key of its own.
    """
    bits = min(FILTER_BITS, max(1 << 16, 1 << (16 * chosen.count()).bit_length()))
    number = F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1
    dealt = chosen.select(F.bitmap_bucket_number(number).alias("_bucket"), F.bitmap_bit_position(number).alias("_bit"))
    maps = dealt.repartition("_bucket").groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    placed = rows.withColumns({"_bucket": F.bitmap_bucket_number(number), "_bit": F.bitmap_bit_position(number)})
    met = placed.join(F.broadcast(maps), "_bucket", "left")
    byte = F.conv(F.hex(F.substring("_map", (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    held = F.getbit(byte.cast("int"), (F.col("_bit") % 8).cast("int")) == 1
    return met.select(*rows.columns, F.coalesce(held, F.lit(False)).alias(name))
