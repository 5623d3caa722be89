"""Quantiles and distinct counts from sketches that are stored per group and year and merged.

A sketch of a group and year is some kilobytes, whatever the rows: years are
added by merging, without their rows.  Counts are exact; a quantile's
rank is off by ``RANK_ERROR`` of the rows at most, by the sketch's own bound at
99 %; distinct counts from sketches are exact up to ``2**LG_ENTRIES`` and within
some 3 % beyond.  Where they must be exact at any number, :func:`things` stores
what occurs in a group and year, a row each, and :func:`counted` merges years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import finite

#: Size of a quantile sketch, its error, and the size of a distinct sketch.
K, RANK_ERROR, LG_ENTRIES = 800, 0.005, 12


def sketched(facts: DataFrame, group: list[str], value: str = "monto_devengado", distinct: str | None = None) -> DataFrame:
    """(group, year, values, things): a row to store per group and year; NaN and infinities count as missing."""
    things = F.theta_sketch_agg(distinct, F.lit(LG_ENTRIES)) if distinct else F.lit(None).cast("binary")
    return facts.groupBy(*group, F.col("periodo").alias("year")).agg(F.kll_sketch_agg_double(finite(F.col(value).cast("double")), F.lit(K)).alias("values"), things.alias("things"))


def merged(stored: DataFrame, group: list[str]) -> DataFrame:
    """Stored sketches as one per ``group``."""
    return stored.groupBy(*group).agg(F.kll_merge_agg_double("values", F.lit(K)).alias("values"), F.theta_union_agg("things", F.lit(LG_ENTRIES)).alias("things"))


def quantiles_of(sketches: DataFrame, group: list[str], wanted: dict[str, float]) -> DataFrame:
    """n, the distinct count and the wanted quantiles of each sketch; quantiles are null where nothing was counted."""
    n = F.kll_sketch_get_n_double("values")
    found = {name: F.when(n > 0, F.kll_sketch_get_quantile_double("values", F.lit(p))) for name, p in wanted.items()}
    return sketches.select(*group, n.alias("n"), F.theta_sketch_estimate("things").alias("distinct"), *[c.alias(name) for name, c in found.items()])


def things(facts: DataFrame, group: list[str], distinct: str) -> DataFrame:
    """(group, year, thing): what to store per group and year for distinct counts that are exact at any number."""
    return facts.filter(F.col(distinct).isNotNull()).select(*group, F.col("periodo").alias("year"), F.col(distinct).alias("thing")).distinct()


def counted(stored: DataFrame, group: list[str]) -> DataFrame:
    """The distinct things of each ``group`` over all stored years; a group without any has no row."""
    return stored.select(*group, "thing").distinct().groupBy(*group).agg(F.count("*").alias("distinct"))
