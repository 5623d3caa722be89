"""Corpus pipeline: quality rules, toxicity, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before it
wrote, and all but the last return the columns of documents.  No ``ORACLE_SQL``:
SQL has no zstandard, no XXH64 and no tokenizer; ``tests/llm`` holds the
pipeline against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.llm import packing, quality, simhash, toxicity
from quipu.llm._common import documents, shared_dir
from quipu.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the compression bands and the base rules; the bands are fitted on the labelled rows of the whole ``documents``."""
    return quality.keep_good(docs, quality.fit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not predicted toxic; the model is fitted on the labelled rows of the whole ``documents``."""
    model = toxicity.fit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that of the least doc_id, however often a doc_id occurs."""
    return simhash.keep_first(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with a checksum for the ids; packed in the order of doc_id, since the stages before may move rows."""
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    pieces = packing.pack_documents(ordered, tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", near_dedup),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    folder = shared_dir(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}_{name}")
            docs = spark.read.parquet(f"{folder}/{k}_{name}")
    return docs
