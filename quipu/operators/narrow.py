"""Ways to move few bytes of many rows: what a step needs is decided on hashes or sums, and whole rows follow only where they count.

All are exact: a hash only says which rows may count, and what follows judges
their real keys.  What decides is written first, so that Spark knows its size
before it plans the join and broadcasts it where it is small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize

#: Rows that :func:`reaching` broadcasts at most.
SLOTS = 1 << 16
#: Bits that are gathered at once, bits of one row of a sieve, bits for each of its hashes, and the logarithm of the most bits that are broadcast: 16 MB.
PIECE, SMALL, ROOM, MOST_BITS = 1 << 15, 1 << 10, 16, 27


def marked(rows: DataFrame, hashed: Column, chosen: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``maybe_``: true for all whose hash is in the column ``name`` of ``chosen``, a written table, and for about one in ``ROOM`` of the others.

    Rows stay where they are: what is broadcast are bits, of which a hash sets
    one.  Beyond 2 ** ``MOST_BITS`` bits it becomes a coarser filter, not a larger one.
    """
    bits = F.lit(1 << min(MOST_BITS, max(PIECE.bit_length() - 1, (ROOM * chosen.count()).bit_length())))
    piece = lambda h: F.floor(F.pmod(h, bits) / PIECE).cast("long")
    # Dealt by piece first, so that a piece's 4 KB are made once and not by each task.
    dealt = chosen.select(piece(F.col(name)).alias("piece_"), F.pmod(F.col(name), F.lit(PIECE)).alias("at_")).repartition("piece_")
    gathered = dealt.groupBy("piece_").agg(F.bitmap_construct_agg("at_").alias("bits_"))
    # A join copies the bits of a row's piece, so these are cut small; what has no bit set is left out.
    parts = PIECE // SMALL
    cut = F.explode(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.struct((F.col("piece_") * parts + i).alias("piece_"), F.substring(F.col("bits_"), i * (SMALL // 8) + 1, F.lit(SMALL // 8)).alias("bits_"))))
    pieces = gathered.select(cut.alias("c")).select("c.*").filter(F.bitmap_count("bits_") > 0)
    at = F.pmod(hashed, F.lit(SMALL))
    byte = F.conv(F.hex(F.substring(F.col("bits_"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    # At most 2 ** MOST_BITS bits: a proven bound for the broadcast.
    return rows.join(F.broadcast(pieces), F.floor(F.pmod(hashed, bits) / SMALL).cast("long") == F.col("piece_"), "left").select(*rows.columns, maybe.alias("maybe_"))


def sieve(rows: DataFrame, hashed: Column, chosen: DataFrame, name: str) -> DataFrame:
    """Those of ``rows`` that :func:`marked` marks."""
    return marked(rows, hashed, chosen, name).filter("maybe_").drop("maybe_")


def without(rows: DataFrame, key: str, other: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``rows`` whose ``key`` is not in ``other(key)``, a written table: those that stay where they are, and the few that were moved to be sure."""
    judged = marked(rows, F.xxhash64(key), other.select(F.xxhash64(key).alias("hidden_")), "hidden_")
    moved = judged.filter("maybe_").drop("maybe_").join(other, key, "left_anti")
    return judged.filter("not maybe_").drop("maybe_"), moved


def repeated(rows: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """Rows of ``rows`` among which are all whose ``keys`` occur ``least`` times or more, and few others.  Eight bytes a row are moved."""
    if least < 2:
        return rows
    often = rows.groupBy(F.xxhash64(*keys).alias("often_")).agg(F.count("*").alias("n_")).filter(F.col("n_") >= least).select("often_")
    return sieve(rows, F.xxhash64(*keys), materialize(often, "repeated"), "often_")


def reaching(rows: DataFrame, stats: DataFrame, group: list[str], value: str, limit: Column) -> DataFrame:
    """Rows of ``rows`` among which are all whose ``value`` is at least the ``limit`` of their group in ``stats``.

    Groups are dealt into slots by their hash, and a row has to reach the least
    limit of its slot; more groups make it a coarser filter, not a larger one.
    """
    slot = F.pmod(F.xxhash64(*group), F.lit(SLOTS))
    least = stats.groupBy(slot.alias("slot_")).agg(F.min(limit).alias("least_"))
    # At most SLOTS rows: a proven bound for the broadcast.
    return rows.join(F.broadcast(least), (slot == F.col("slot_")) & (F.col(value) >= F.col("least_")), "left_semi")


def alike(rows: DataFrame, other: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """Rows of ``rows`` whose ``keys`` are in ``other``, where nulls are alike; with the columns ``more`` of ``other`` if any are named."""
    named = other.select(*[F.col(k).alias(f"other_{n}_") for n, k in enumerate(keys)], *more)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"other_{n}_")) for n, k in enumerate(keys)])
    return rows.join(named, on, "inner" if more else "left_semi").select(*rows.columns, *more)
