import zstandard

import corpus_pipeline
from quipu.llm import quality, toxicity
from quipu.llm.queries import tokenizer_path
from tests.llm.test_simhash import plain_components, plain_kept, plain_print

SF = "/root/testdata/sf0.001"


def test_run_equals_stage_by_stage_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    squeeze = zstandard.ZstdCompressor(level=3).compress
    bands = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    good = {k: t for k, t in docs.items() if quality.judge(t, bands, squeeze)[-1]}
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    matcher = toxicity.Matcher(model)
    clean = {k: t for k, t in good.items() if toxicity.score_of(toxicity.features(toxicity.words_of(t), matcher, model.window), model.weights) < 0.5}
    ids = sorted(clean)
    first = set(plain_components([plain_print(clean[k]) for k in ids], ids))
    assert len(docs) > len(good) > len(clean) > len(first)
    from tokenizers import Tokenizer

    from tests.llm.test_tokens import check_pieces

    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = corpus_pipeline.run(spark, SF).collect()
    check_pieces(rows, {k: lib.encode(clean[k], add_special_tokens=False).ids + [2] for k in first})


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_nulls_and_nothing(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0)], spark.read.parquet(f"{SF}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).collect()
        assert stage(spark, docs.filter("spark_partition_id() < 0"), SF).count() == 0


def test_repeated_keys_lose_no_text(spark, tmp_path):
    """Every document twice under the keys of others: what has no copy stays, whatever its key."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    again = docs.selectExpr("(doc_id + 7) % 50 as doc_id", "concat(text, ' ', text) as text", "lang", "source", "n_chars")
    both = docs.unionByName(again).unionByName(docs.limit(20))
    kept = corpus_pipeline.near_dedup(spark, both, SF).collect()
    rows = [(r["doc_id"], r["text"]) for r in both.collect()]
    groups = plain_kept(rows)
    assert len(kept) == len(groups) and all(sum((r["doc_id"], r["text"] or "") in g for r in kept) >= 1 for g in groups)


def test_readers_and_writers_hold_a_bounded_share_of_a_task(spark, tmp_path):
    """A writer held 128 MB, and a reader 4,096 texts, for each task that runs at once."""
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from quipu.llm._common import GROUP_BYTES, prepare

    prepare(spark)
    words = [F.md5(F.concat("id", F.lit(f" {k}"))) for k in range(400)]
    spark.range(5000, numPartitions=1).select(F.col("id").alias("doc_id"), F.concat(*words).alias("text")).write.parquet(f"{tmp_path}/long")
    (part,) = (tmp_path / "long").glob("part-*")
    groups = pq.ParquetFile(part).metadata
    assert groups.num_row_groups > 2 and max(groups.row_group(k).total_byte_size for k in range(groups.num_row_groups)) < 2 * GROUP_BYTES
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) * 12800 < GROUP_BYTES
    assert spark.read.parquet(f"{tmp_path}/long").agg(F.sum(F.length("text"))).first()[0] == 5000 * 400 * 32
