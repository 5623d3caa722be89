"""The queries op1 to op13 and their DuckDB forms, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, centroids, chat_format, packing, quality, records, sharding, simhash, sp_prefix, token_counts, toxicity, url_filter, vector_codes
from ._common import documents, prepare, shared_dir, spread


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_toxicity(docs, model)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chat_format.rotate_perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    spans = F.array_join(F.transform("target_spans", lambda s: F.concat_ws("-", s["start"], s["end"])), " ")
    return rendered.withColumn("target_spans", spans)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(spark, documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(documents(spark, sf_dir, "doc_id"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    folder = shared_dir(spark)
    files = records.write_records(documents(spark, sf_dir), folder, tokenizer_path("byte_bpe_50k.json"))
    return records.read_records(spark, folder, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score_quality(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda vec_id: vec_id % 50 == 0)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_prefix.encode_documents(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(documents(spark, sf_dir).select("doc_id")).select("doc_id", "shard_slot", "shard_id")


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(spread(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, _ = vector_codes.compress(spread(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    return coded.drop("label")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered, _ = centroids.cluster_vectors(spread(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    return clustered


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_simhash_near_dedup,
        op3_chat_formatting,
        op4_token_counts,
        op5_packing,
        op6_token_records,
        op7_quality_rules,
        op8_nearest_neighbours,
        op9_sentencepiece,
        op10_sharding,
        op11_url_filters,
        op12_vector_codes,
        op13_centroid_clustering,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op3_chat_formatting": chat_format.SQL,
    "op10_sharding": sharding.sql(),
    "op11_url_filters": url_filter.sql(),
    "op12_vector_codes": vector_codes.sql(),
    "op13_centroid_clustering": centroids.sql(),
}
