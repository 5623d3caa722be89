"""Exact quantiles per group without holding a group's values anywhere.

Values are counted per bucket of their signed logarithm, map-side first; a running sum
over a group's buckets, of which there are at most some ten thousands, says in
which buckets the wanted ranks lie; only the values of these are looked at again,
and only their distinct ones are put in order.  A hot group is spread over its
buckets, and no task gathers a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize
from .narrow import sieve

#: Buckets per doubling of 1 + |value|.
FINENESS = 256


def _ranks(p: float, n: Column, discrete: bool) -> tuple[Column, Column]:
    """The ranks (from 0) that a quantile lies between; both are the nearest rank if ``discrete``."""
    if discrete:
        nearest = F.greatest(F.ceil(F.lit(p) * n).cast("long") - 1, F.lit(0).cast("long"))
        return nearest, nearest
    return F.floor(F.lit(p) * (n - 1)).cast("long"), F.ceil(F.lit(p) * (n - 1)).cast("long")


def quantiles(rows: DataFrame, group: list[str], value: str, wanted: dict[str, float], least: int = 1, discrete: bool = False, sift: bool = False) -> DataFrame:
    """Per group of at least ``least`` rows: n, and for each name its quantile and the values below and above it (name, name_low, name_high).

    ``value`` is a column of numbers, of which missing, NaN and infinite ones don't count; ``group`` may be empty.  Quantiles
    are interpolated, or the nearest rank if ``discrete``.  With ``sift``, for many groups, the wanted buckets are written
    first, and rows of other buckets stay where they are instead of being moved to meet them.
    """
    one = F.lit(0).alias("whole_")
    by = group or ["whole_"]
    own = rows.select(*[F.col(g) for g in group] or [one], F.col(value).cast("double").alias("value_")).filter(F.abs("value_") < float("inf"))
    own = own.withColumn("bucket_", F.floor(F.signum("value_") * F.log2(1 + F.abs("value_")) * FINENESS).cast("int"))
    counts = own.groupBy(*by, "bucket_").agg(F.count("*").alias("c_"))
    over = Window.partitionBy(*by)
    placed = counts.withColumns({"n": F.sum("c_").over(over), "to_": F.sum("c_").over(over.orderBy("bucket_").rowsBetween(Window.unboundedPreceding, 0))}).filter(F.col("n") >= least)
    every = F.array_distinct(F.array(*[r for p in wanted.values() for r in _ranks(p, F.col("n"), discrete)]))
    start = F.col("to_") - F.col("c_")
    needed = placed.withColumns({"start_": start, "ranks_": F.filter(every, lambda r: (r >= start) & (r < F.col("to_")))}).filter(F.size("ranks_") > 0)
    needed = needed.select(*[F.col(g).alias(f"{g}_of") for g in by], F.col("bucket_").alias("bucket_of"), "n", "start_", "ranks_")
    if sift:
        needed = materialize(needed.withColumn("wanted_", F.xxhash64(*[f"{g}_of" for g in by], "bucket_of")), "buckets")
        own, needed = sieve(own, F.xxhash64(*by, "bucket_"), needed, "wanted_"), needed.drop("wanted_")
    same = F.col("bucket_") == F.col("bucket_of")
    for g in by:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}_of"))
    values = own.join(needed, same).groupBy(*by, "bucket_", "value_").agg(F.count("*").alias("c_"), F.first("n").alias("n"), F.first("start_").alias("start_"), F.first("ranks_").alias("ranks_"))
    inside = Window.partitionBy(*by, "bucket_").orderBy("value_").rowsBetween(Window.unboundedPreceding, 0)
    at = values.withColumn("to_", F.col("start_") + F.sum("c_").over(inside))
    hit = at.withColumn("hit_", F.filter("ranks_", lambda r: (r >= F.col("to_") - F.col("c_")) & (r < F.col("to_")))).filter(F.size("hit_") > 0)
    found = hit.select(*by, "n", F.explode("hit_").alias("rank_"), "value_")
    aggregates = [F.max("n").alias("n")]
    for name, p in wanted.items():
        low, high = _ranks(p, F.col("n"), discrete)
        aggregates += [F.max(F.when(F.col("rank_") == low, F.col("value_"))).alias(f"{name}_low"), F.max(F.when(F.col("rank_") == high, F.col("value_"))).alias(f"{name}_high")]
    out = found.groupBy(*by).agg(*aggregates)
    for name, p in wanted.items():
        part = F.lit(0.0) if discrete else F.lit(p) * (F.col("n") - 1) - F.floor(F.lit(p) * (F.col("n") - 1))
        out = out.withColumn(name, F.col(f"{name}_low") + (F.col(f"{name}_high") - F.col(f"{name}_low")) * part)
    return out if group else out.drop("whole_")
