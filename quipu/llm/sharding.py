"""Shard placement through a permutation-filled lookup table, with SQL functions only.

The table has a prime number of slots.  Every shard has a preference order of
the slots: start at an offset and step by a skip, both made of its name, which
for a prime size visits each slot once.  The shards take turns; each claims the
first slot of its order that is still free.  All shards end with nearly equal
numbers of slots, and when the set of shards changes few slots change hands.

A row's slot is its key's hash modulo the table's size, and a broadcast lookup
gives its shard in constant time.  The table's size is a parameter (8,191 rows
by default), not a function of the data, so the broadcast is bounded; no row is
shuffled, whatever key is hot.

Defined results
    null key: hashed like the empty string.  A key of any length is hashed
    whole.  Repeated rows go to the same shard.  Extra columns are ignored by the
    digest and kept by :func:`place`, which gives its own columns names that
    clash with none; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import fresh

SLOTS = 8191
SHARDS = 64


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{k:04d}" for k in range(n)]


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the index of the shard that claimed it."""
    if not is_prime(slots) or len(names) > slots or not names or len(set(names)) != len(names):
        raise ValueError("slots must be prime and at least as many as the shards, which need different names")

    def number(name: str, salt: str) -> int:
        return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")

    next_slot = [number(x, "offset") % slots for x in names]
    skip = [number(x, "skip") % (slots - 1) + 1 for x in names]
    owner = [-1] * slots
    free = slots
    while free:
        for k in range(len(names)):
            at = next_slot[k]
            while owner[at] >= 0:
                at = (at + skip[k]) % slots
            owner[at] = k
            next_slot[k] = (at + skip[k]) % slots
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: 60 bits of its text's MD5, modulo the number of slots."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def table_frame(spark: SparkSession, names: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard) rows of the lookup table, made of a literal."""
    packed = ",".join(map(str, lookup_table(names, slots)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(packed), ","))).select(F.col("pos").alias("slot"), F.col("col").cast("int").alias("shard"))


def place(rows: DataFrame, key: str = "doc_id", names: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``shard_slot`` and ``shard_id`` (under other names if those are taken)."""
    slot, shard = fresh(rows, "shard_slot"), fresh(rows, "shard_id")
    table = table_frame(rows.sparkSession, names or shard_names(), slots).select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    columns = [F.col(f"`{c}`") for c in rows.columns]
    return rows.withColumn(slot, slot_of(F.col(f"`{key}`"), slots)).join(F.broadcast(table), slot).select(*columns, slot, shard)


def shard_loads(placed: DataFrame, shard: str = "shard_id", size: Column | None = None) -> DataFrame:
    """Rows and bytes per shard; sums are made map-side first."""
    return placed.groupBy(shard).agg(F.count("*").alias("n_rows"), F.sum(size if size is not None else F.lit(0)).alias("n_bytes"))


def sql(names: list[str] | None = None, slots: int = SLOTS) -> str:
    """DuckDB form of op10's rows, over the same table."""
    table = ",".join(map(str, lookup_table(names or shard_names(), slots)))
    return f"""
WITH lookup AS (SELECT [{table}] AS owner), d AS (
  SELECT doc_id, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {slots} AS INTEGER) AS shard_slot FROM documents
)
SELECT d.doc_id, d.shard_slot, CAST(lookup.owner[d.shard_slot + 1] AS INTEGER) AS shard_id FROM d, lookup
"""
