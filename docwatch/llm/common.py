"""Pieces that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docwatch.operators.key_filter import with_may_be_in  # noqa: F401

# White space as every contract of this subpackage means it: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def text_of(column: str | Column = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """The maximal runs of characters that aren't white space, in order."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def shift(array: Column, by: int) -> Column:
    """The array without its first ``by`` elements."""
    return F.slice(array, by + 1, F.greatest(F.size(array) - by, F.lit(0)))


def place_in_group(rows: DataFrame, keys: list[str], order: list[str], counts: DataFrame, bucket_rows: int) -> DataFrame:
    """Adds ``place``: the row's number within its ``keys``, from 0, gapless.

    ``counts`` has ``n`` for each of the keys. A group is cut into hash ranges of
    about ``bucket_rows`` rows, so no task sorts a large group whole: ranges are
    numbered one after the other and rows within a range by ``order``. Rows alike
    in all of ``order`` fall into one range; their order doesn't matter.
    """
    width = F.ceil(F.col("n") / F.lit(bucket_rows)).cast("long")
    cut = rows.join(counts.select(*keys, "n"), keys).withColumn(
        "_range", F.pmod(F.xxhash64(*order), F.greatest(width, F.lit(1)))
    )
    sizes = cut.groupBy(*keys, "_range").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    numbered = cut.withColumn("_row", F.row_number().over(inside) - 1)
    return (
        numbered.join(starts, [*keys, "_range"])
        .withColumn("place", F.col("_start") + F.col("_row"))
        .drop("_range", "_start", "_row", "n")
    )
