"""What a raw source looks like: columns, flags, and kinds of identities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.identity import identifier_type
from ..operators.quality import value_counts
from .facts import FLAGS, canonical_columns, canonical_name

SAMPLE_ROWS = 250_000


def first_rows(raw: DataFrame, most: int) -> DataFrame:
    """About the first ``most`` rows, where they are: each task gives its share, so no task gathers them all."""
    parts = max(1, raw.rdd.getNumPartitions())
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return raw.withColumn("nth_", nth).filter(F.col("nth_") < -(-most // parts)).drop("nth_")


def source_profile(raw: DataFrame, rows: int | None = SAMPLE_ROWS, top: int = 20) -> dict:
    """Header mapping, value counts of the flag columns, and counts by kind of identity.

    rows: about the first so many rows only, an equal share of each task, which
    is the feature of a quick profile; None profiles all.
    """
    seen = canonical_columns(raw if rows is None else first_rows(raw, rows))
    flags = [c for c in FLAGS.values() if c in seen.columns]
    kinds = seen.groupBy(identifier_type("beneficiario_source_id").alias("kind")).agg(F.count("*").alias("n")) if "beneficiario_source_id" in seen.columns else None
    return {
        "canonical_column_mapping": {c: canonical_name(c) for c in raw.columns},
        "value_counts": value_counts(seen.select(*[F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in flags]), flags, top) if flags else None,
        "identity_types": kinds,
        "sample_rows": seen.agg(F.count("*").alias("n")),
    }


def exploded(documents: DataFrame, c: str) -> DataFrame:
    """The entries of an array of the documents, one row each; an entry that is a record gives its fields."""
    rows = documents.select(F.explode(c).alias("entry"))
    return rows.select("entry.*") if isinstance(rows.schema["entry"].dataType, StructType) else rows


def read_documents(spark, path: str) -> DataFrame:
    """Whole JSON documents; a file that doesn't parse gives no row."""
    return spark.read.option("multiLine", "true").option("mode", "DROPMALFORMED").json(path)
