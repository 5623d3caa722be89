"""Token counts by a map-side two-tier lookup.

Tier one is a compact table of the token counts of frequent pre-tokens,
broadcast (at most ``table_rows`` entries, a proven bound).  Tier two is a
worker's own bounded cache: pre-tokens outside the table are encoded once per
worker.  Counts are exact whatever the table holds, since the table only saves
work; no text and no stream of pre-tokens is shuffled.

The table comes from all documents.  A task counts its pre-tokens map-side in a
bounded counter, which forgets the rarer half when it is full, and hands on its
``task_rows`` most frequent; these summaries are added up, and the level above
which at most ``table_rows`` lie is read off a histogram of their logarithms, so
that no task and no driver sorts them.

Defined results
    null or empty text: 0 bytes, 0 tokens.  A special token's string inside a
    text counts as that token, as the library does by default; such texts are
    encoded whole by the library, all others part by part.  A very long text is
    counted whole.  Repeated rows and rows without a key are counted one by
    one; extra columns, whatever their names, are ignored.  An empty table gives
    no rows.
"""

from __future__ import annotations

import uuid
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, cache_of, prepare
from .bpe_cache import LONGEST_KEPT, CachedEncoder, encoder

TABLE_ROWS = 65_536
#: What a task hands on, and what it counts at once.
TASK_ROWS, TASK_COUNTED = 8_192, 200_000


def most_frequent(seen: Counter, rows: int) -> Counter:
    """The ``rows`` most frequent of a counter; of equal ones those that come first in order."""
    return Counter(dict(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:rows]))


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", table_rows: int = TABLE_ROWS, task_rows: int = TASK_ROWS, counted: int = TASK_COUNTED) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of ``docs``, at most ``table_rows``."""

    def count(batches):
        enc, seen = encoder(path), Counter()
        for pdf in batches:
            for t in pdf["t"]:
                if t and enc.cached(t):
                    seen.update(enc.parts(t))
                    if len(seen) > counted:
                        seen = most_frequent(seen, counted // 2)
        top = most_frequent(Counter({p: n for p, n in seen.items() if len(p) <= LONGEST_KEPT}), task_rows)
        width = enc.dtype.itemsize
        if top:  # a frame of empty lists has no column types
            yield pd.DataFrame({"part": list(top), "n": list(top.values()), "tokens": [len(enc.cache[p]) // width for p in top]})

    with Scratch(docs.sparkSession) as scratch:
        tops = docs.select(F.col(f"`{text}`").alias("t")).mapInPandas(count, "part string, n long, tokens int")
        sums = scratch.put(tops.groupBy("part", "tokens").agg(F.sum("n").alias("n")).withColumn("level", F.floor(F.log2("n") * 8).cast("int")), "frequent")
        left, least = table_rows, 0
        # A level is an eighth of a power of two: at most 512 rows.
        for r in sums.groupBy("level").agg(F.count("*").alias("rows")).orderBy(F.desc("level")).collect():
            left -= r["rows"]
            if left < 0:
                least = r["level"] + 1
                break
        return {r["part"]: r["tokens"] for r in sums.filter(F.col("level") >= least).select("part", "tokens").toLocalIterator()}


class Lengths(dict):
    """Tier one; misses go to tier two, which is emptied when it is full."""

    def __init__(self, table: dict[str, int], enc: CachedEncoder, most: int):
        super().__init__(table)
        self.enc, self.most, self.rest = enc, most, {}

    def __missing__(self, part: str) -> int:
        n = self.rest.get(part)
        if n is None:
            n = len(self.enc.cache.encode(part)) // self.enc.dtype.itemsize
            if len(part) <= LONGEST_KEPT:
                if len(self.rest) >= self.most:
                    self.rest.clear()
                self.rest[part] = n
        return n

    def of(self, text: str) -> int:
        if self.enc.cached(text):
            return sum(map(self.__getitem__, self.enc.parts(text)))
        return len(self.enc.ids(text))


def tiers_of(number: str, table, path: str, most: int) -> Lengths:
    """A worker's tiers for one call of :func:`count_tokens`; those of an earlier call are dropped."""
    enc, held = encoder(path), cache_of("byte pairs")
    if held.get("tiers", ("",))[0] != number:
        held["tiers"] = number, Lengths(table.value, enc, most)
    return held["tiers"][1]


def count_tokens(spark: SparkSession, docs: DataFrame, path: str, limit: int = 1024, text: str = "text", key: str = "doc_id", most: int = 500_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether the count is over ``limit``; one map over ``docs``."""
    prepare(spark)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, text))
    number = uuid.uuid4().hex

    @F.pandas_udf("n_bytes long, n_tokens long")
    def counted(texts: pd.Series) -> pd.DataFrame:
        tiers = tiers_of(number, table, path, most)
        whole = [t or "" for t in texts]
        return pd.DataFrame({"n_bytes": [len(t.encode()) for t in whole], "n_tokens": [tiers.of(t) for t in whole]}, dtype="int64")

    return (
        docs.select(F.col(f"`{key}`").alias("doc_id"), counted(F.col(f"`{text}`")).alias("c"))
        .select("doc_id", "c.n_bytes", "c.n_tokens", (F.col("c.n_tokens") > limit).alias("over_limit"))
    )
