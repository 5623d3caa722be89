"""Cross filters over bitmaps: who has a value is a row of bits, so filters are answered without the rows.

Bits lie in buckets of 32,768 rows; a bitmap row is one value of one dimension
in one bucket, 4 KiB at most before compression.  Values of a dimension are united, dimensions
met, bucket by bucket; no step holds more than a bucket's bits of a value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITMAPS = "dimension string, value string, bucket long, bits binary"


def bitmaps(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """Rows of ``BITMAPS`` for ``rows``, which should be stored: numbers are given as they are read.  A null is the value ''."""
    cells = F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("")).alias("value")) for d in dimensions])
    numbered = rows.select(F.monotonically_increasing_id().alias("id"), cells.alias("cells"))
    placed = numbered.select(F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("bit"), F.explode("cells").alias("c"))
    return placed.groupBy("c.dimension", "c.value", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _met(maps: DataFrame, wanted: dict[str, list]) -> DataFrame:
    """(bucket, bits) of the rows that have one of the values of every dimension."""
    sides = []
    for dimension, values in wanted.items():
        mine = maps.filter((F.col("dimension") == dimension) & F.col("value").isin(*["" if v is None else str(v) for v in values]))
        sides.append(mine.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits")))
    every = reduce(DataFrame.unionByName, sides).groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("n"))
    return every.filter(F.col("n") == len(wanted)).drop("n")


def count(maps: DataFrame, **wanted) -> DataFrame:
    """One row: how many rows have one of the wanted values in each dimension."""
    return _met(maps, wanted).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def facet(maps: DataFrame, dimension: str, **wanted) -> DataFrame:
    """(value, n) of a dimension among the rows that pass the filters; values without any are left out."""
    values = maps.filter(F.col("dimension") == dimension).select("value", "bucket", "bits")
    if wanted:
        met = _met(maps, wanted).withColumnRenamed("bits", "other")
        both = values.join(met, "bucket").select("value", "bucket", F.explode(F.array("bits", "other")).alias("bits"))
        values = both.groupBy("value", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"))
    return values.groupBy("value").agg(F.sum(F.bitmap_count("bits")).alias("n")).filter("n > 0")
