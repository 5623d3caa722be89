"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialize, remove, shared_dir, stored  # noqa: F401  the operators' helpers for tables that cut lineage
from ..ship import ship
from ..sources.star import spread

#: Rows and bytes of one Arrow batch: a worker holds a few of these at a time.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20

#: Rows that a Parquet reader decodes at once, and bytes of a row group, which a writer holds whole: a task's heap follows both.
READ_ROWS = 256
GROUP_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Bound what one Arrow batch and one Parquet reader or writer hold, so that memory does not follow the text lengths or the size of a
    task, and ship this package to the workers.

    The settings stay for the rest of the session: plans are lazy, so they must hold when a result is read or written.
    """
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))
    spark.conf.set("parquet.block.size", str(GROUP_BYTES))


class Scratch:
    """Tables of one computation, in one shared folder that goes with them."""

    def __init__(self, spark: SparkSession):
        self.folder, self.count = shared_dir(spark), 0

    def put(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        return stored(df, f"{self.folder}/{self.count}_{name}")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        remove(self.folder)


_CACHES: dict[str, dict] = {}


def cache_of(owner: str) -> dict:
    """What a worker keeps for one kind of operator.

    Workers outlive the stages that fill their caches; the first call for
    another kind empties the others, and hands their memory back.
    """
    if owner not in _CACHES:
        _CACHES.clear()
        _CACHES[owner] = {}
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)
    return _CACHES[owner]


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def key_columns(key: str) -> list[Column]:
    """``k``, 0 where the key is null, and ``keyed``: a null among whole numbers would turn all of its batch into doubles in pandas."""
    k = F.col(f"`{key}`").cast("long")
    return [k.isNotNull().alias("keyed"), F.coalesce(k, F.lit(0)).cast("long").alias("k")]


def keys_of(pdf: pd.DataFrame) -> list[int | None]:
    """The keys of :func:`key_columns`."""
    return [k if keyed else None for keyed, k in zip(pdf["keyed"].tolist(), pdf["k"].tolist())]


def whole_numbers(values) -> pd.Series:
    """64-bit integers of which some may be None."""
    return pd.Series(list(values), dtype="Int64")


def held_out(key: Column, folds: int = 5) -> Column:
    """Rows set aside for testing: crc32 of the key, as text, modulo ``folds`` is 0."""
    return F.crc32(key.cast("string").cast("binary")) % folds == 0


def labelled(labels: DataFrame, value: Column, folds: int = 5) -> DataFrame:
    """(labelled_id, value): the keys of ``labels`` that have a value and aren't held out.  ``value`` is an aggregate, since keys may be repeated."""
    rows = labels.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds))
    return rows.groupBy(F.col("doc_id").alias("labelled_id")).agg(value.alias("value")).filter("value is not null")


def labelled_sample(labels: DataFrame, value: Column, most: int, folds: int = 5) -> DataFrame:
    """About ``most`` rows of :func:`labelled`, or all if there are fewer.

    The keys are those whose hash lies below a level set from their count, so
    that nothing is sorted; twice ``most`` is a bound that no hash of a larger
    table passes.
    """
    rows = labelled(labels, value, folds)
    scale = 1 << 40
    level = scale * most // max(rows.count(), most)
    return rows.filter(F.pmod(F.xxhash64("labelled_id"), F.lit(scale)) < level)


def documents(spark: SparkSession, sf_dir: str, *order: str) -> DataFrame:
    """The documents, dealt out (by ``order`` if given) if their files give fewer tasks than there are cores."""
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"), *order)
