import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quipu.llm import bpe_cache, packing, queries, records, sp_prefix, token_counts

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "a", "\n\n a  b\t", "it's I'LL don't", "x<|endoftext|>y", "<|startoftext|>", "漢字 かな 😀", "Σίσυφος ΟΔΟΣ", "é é İ ı", "\x1c\x1d a", "1234 ½ ²", "a" * 30_000, "..,!? -- __ |#", "  x y", "<unk> <s> ▁▁ <0x0A>"]


def texts_of(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def odd_frame(spark):
    return spark.createDataFrame([(None if k == 3 else k, t, "x") for k, t in enumerate(ODD)], "doc_id long, text string, n_tokens string").repartition(2)


def nothing(df):
    """No rows, in partitions that reach the workers: the optimiser can't fold the condition."""
    return df.filter("spark_partition_id() < 0")


@pytest.mark.parametrize("rows", [[(1, "one"), (2, "two words")], [(1, None), (2, "")], [(1, "<|endoftext|>")], []])
def test_parts_without_rows_or_words(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    lib = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(spark, df, queries.tokenizer_path("byte_bpe_50k.json")).collect()}
    assert got == {k: len(lib.encode(t or "", add_special_tokens=False).ids) for k, t in rows}


def test_large_keys_beside_a_null(spark, tmp_path):
    keys = [2**53 + 1, None, 2**53 + 3, 2**53 + 5, -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(k, f"text {n}") for n, k in enumerate(keys)], "doc_id long, text string").coalesce(1)
    want = sorted(keys, key=lambda k: (k is not None, k or 0))
    pieces = packing.pack_documents(df, queries.tokenizer_path("word_bpe_49k.json")).orderBy("sequence_id", "offset").collect()
    assert list(dict.fromkeys(r["doc_id"] for r in pieces)) == want
    files = records.write_records(df, f"file://{tmp_path}/k", queries.tokenizer_path("byte_bpe_50k.json"))
    assert [r["doc_id"] for r in records.read_records(spark, f"file://{tmp_path}/k", files).orderBy("start").collect()] == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_ids_are_the_library_s(name):
    enc = bpe_cache.CachedEncoder(queries.tokenizer_path(name), most=50)
    lib = Tokenizer.from_file(queries.tokenizer_path(name))
    rng = random.Random(8)
    letters = "  \n\t aabETs'.,!9²éÿŁſ|<_x\x1cΣ漢́ı"
    covered = [chr(c) for c in range(0x2100) if not bpe_cache.UNSAFE.match(chr(c))]
    samples = [t or "" for t in ODD] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    samples += [f"{c} a{c}b {c}{c} '{c}s 1{c}.{c}" for c in covered]
    for t in samples:
        assert enc.ids(t).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_cache_starts_anew_after_many_misses():
    ids = bpe_cache.Ids(str.encode, 2)
    for k in range(100):
        assert ids[str(k)] == str(k).encode()
    assert len(ids) <= 2


def test_token_counts(spark):
    lib = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    docs = texts_of(spark)
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op4_token_counts(spark, SF).collect()}
    assert got == {k: (len(t.encode()), (n := len(lib.encode(t, add_special_tokens=False).ids)), n > 1024) for k, t in docs.items()}
    rows = token_counts.count_tokens(spark, odd_frame(spark), queries.tokenizer_path("byte_bpe_50k.json"), most=5).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(lib.encode(t or "", add_special_tokens=False).ids) for t in ODD)
    assert token_counts.count_tokens(spark, nothing(odd_frame(spark)), queries.tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_frequent_lengths_come_from_all_documents(spark):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    enc = bpe_cache.CachedEncoder(path)
    texts = ["мир и труд " * 50, "common words here " * 40, "世界 " * 30, "x<|endoftext|>y", None, ""] + [f"rare{k} " for k in range(60)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    found = token_counts.frequent_lengths(df, path, table_rows=12)
    assert 0 < len(found) <= 12 and {" труд", " words", " common", " here", " и"} <= set(found)
    assert all(n == len(enc.cache.encode(p)) // enc.dtype.itemsize for p, n in found.items())
    assert set(token_counts.frequent_lengths(df, path, table_rows=12, counted=40)) <= set(token_counts.frequent_lengths(df, path))


def best_cost(at, penalty, costs):
    best = [0.0] + [None] * (len(at) - 1)
    for j in range(1, len(at)):
        options = []
        for i in range(j):
            n = at[j] - at[i]
            if n <= costs.size:
                free = n >= costs.least_power and n & (n - 1) == 0
                options.append(best[i] + (0 if free else costs.size - n))
        best[j] = min(options) + penalty[j] + costs.per_window
    return best[-1]


def test_plan_is_the_cheapest():
    rng, costs = random.Random(6), packing.Costs(size=64, least_power=8, per_window=3, hard=20, sentence=2)
    for _ in range(200):
        at = [0]
        for _ in range(rng.randint(1, 40)):
            at.append(at[-1] + rng.randint(1, 30))
        penalty = [0.0, *(float(rng.choice([0, 2, 20])) for _ in at[1:-1]), 0.0]
        cuts = packing.plan_cuts(at, penalty, costs)
        assert cuts[-1] == at[-1] and all(0 < b - a <= 64 for a, b in zip([0, *cuts], cuts))
        total = sum(penalty[at.index(b)] + 3 + (0 if (n := b - a) >= 8 and n & (n - 1) == 0 else 64 - n) for a, b in zip([0, *cuts], cuts))
        assert total == pytest.approx(best_cost(at, penalty, costs))


def check_pieces(rows, ids_of, size=4096):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids_of)
    for k, mine in by_doc.items():
        at = 0
        for r in sorted(mine, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids_of[k])
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids_of[k][r["start"] : at], "<u4").tobytes())
        assert at == len(ids_of[k])
    padding = 0
    for mine in by_sequence.values():
        at = 0
        for r in sorted(mine, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding / sum(r["length"] for r in rows)


def test_packing_holds_every_id_once(spark):
    lib = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    ids_of = {k: lib.encode(t, add_special_tokens=False).ids + [2] for k, t in texts_of(spark).items()}
    assert check_pieces(queries.op5_packing(spark, SF).collect(), ids_of) < 0.03


def test_packing_of_odd_rows_in_small_stretches(spark):
    from pyspark.sql import functions as F

    lib = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    rows = odd_frame(spark).filter("doc_id is not null")
    ids_of = {k: lib.encode(t or "", add_special_tokens=False).ids + [2] for k, t in enumerate(ODD) if k != 3}
    costs = packing.Costs(size=128, least_power=8, stretch=600)
    out = packing.pack_documents(rows, queries.tokenizer_path("word_bpe_49k.json"), costs=costs).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(out, ids_of, 128)
    every = packing.pack_documents(odd_frame(spark), queries.tokenizer_path("word_bpe_49k.json")).collect()
    assert sum(r["doc_id"] is None for r in every) == 1
    assert packing.pack_documents(nothing(rows), queries.tokenizer_path("word_bpe_49k.json")).count() == 0


def test_a_task_that_runs_again_packs_the_same(spark):
    path = queries.tokenizer_path("word_bpe_49k.json")
    rows = [(k % 7, f"text {k}. " * (k % 11 + 1)) for k in range(90)] + [(3, "same")] * 4 + [(None, "no key"), (None, None)]
    packed = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        packed.append([tuple(r) for r in packing.pack_documents(df, path, costs=packing.Costs(size=64, stretch=300)).orderBy("sequence_id", "offset").collect()])
    assert packed[0] == packed[1]


def test_the_last_windows_are_powers_of_two(spark):
    path = queries.tokenizer_path("word_bpe_49k.json")
    for words in (3, 40, 700):
        df = spark.createDataFrame([(1, "word " * words)], "doc_id long, text string")
        rows = packing.pack_documents(df, path).collect()
        assert sum(r["length"] for r in rows) == words + 1 and all(r["length"] & (r["length"] - 1) == 0 for r in rows)


def test_records_come_back(spark):
    lib = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    at, want = 0, {}
    for k, t in sorted(texts_of(spark).items()):
        ids = np.array(lib.encode(t, add_special_tokens=False).ids + [2], "<u4")
        want[k] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert {r["doc_id"]: tuple(r)[1:] for r in queries.op6_token_records(spark, SF).collect()} == want


def test_record_files(spark, tmp_path):
    folder = f"file://{tmp_path}/r"
    path = queries.tokenizer_path("byte_bpe_50k.json")
    twice = odd_frame(spark).union(odd_frame(spark))
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "part-00000-lost.rec").write_bytes(b"an attempt that did not count")
    files = records.write_records(twice, folder, path, file_bytes=2000)
    assert len(files) > 1 and sum(f.records for f in files) == 2 * len(ODD)
    assert sorted(p.name for p in (tmp_path / "r").iterdir() if p.suffix != ".crc") == sorted(f"{f.name}.{e}" for f in files for e in ("idx", "rec"))
    rows = records.read_records(spark, folder, files, chunk=3).collect()
    keys = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert keys[:2] == [None, None] and keys[2:] == sorted(keys[2:]) and len(keys) == 2 * len(ODD)
    _, name, n, _ = max(files, key=lambda f: f.records)
    every = list(records.iter_file(folder, name))
    assert [(k, i.tolist()) for k, i in records.read_at(folder, name, [n - 1, 0])] == [(k, i.tolist()) for k, i in (every[n - 1], every[0])]
    p = tmp_path / "r" / f"{name}.rec"
    raw = bytearray(p.read_bytes())
    raw[20] ^= 1
    p.write_bytes(raw)
    with pytest.raises(ValueError):
        list(records.iter_file(folder, name))
    none = records.write_records(nothing(odd_frame(spark)), f"file://{tmp_path}/e", path)
    assert records.read_records(spark, f"file://{tmp_path}/e", none).count() == 0


def test_prefix_table_is_the_library_s(spark):
    path = queries.tokenizer_path("piece_bpe_32k.model")
    lib, enc = sentencepiece.SentencePieceProcessor(model_file=path), sp_prefix.PrefixEncoder(path, most=100)
    assert enc.plain
    rng = random.Random(4)
    alphabet = " ▁▁  aabeTh.,!?…\n\t0123é​漢字😀Ω<0x>\x00\x85　tion"
    samples = [t or "" for t in ODD] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    for t in samples:
        ids = lib.encode(t, add_bos=True, add_eos=True)
        assert np.frombuffer(enc.raw(t), "<u4").tolist() == ids, repr(t)
        assert enc.decode(ids) == lib.decode(ids), repr(t)
    for _ in range(2000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(300) for _ in range(rng.randint(0, 12))]
        assert enc.decode(ids) == lib.decode(ids), ids


def test_prefix_table_alone_equals_merging():
    enc = sp_prefix.PrefixEncoder(queries.tokenizer_path("piece_bpe_32k.model"))
    rng = random.Random(5)
    for _ in range(500):
        word = "▁" + "".join(rng.choice("etaoinshrd.,") for _ in range(rng.randint(0, 18)))
        merged = enc.merge(word)
        table, at, back = enc.last_tokens(word), len(word), []
        while at:
            back.append(table[at - 1])
            at -= len(table[at - 1])
        assert back[::-1] == merged


def test_sentencepiece_query(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for k, t in texts_of(spark).items():
        ids = lib.encode(t, add_bos=True, add_eos=True)
        want[k] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(lib.decode(ids).encode()))
    assert {r["doc_id"]: tuple(r)[1:] for r in queries.op9_sentencepiece(spark, SF).collect()} == want
    out = sp_prefix.encode_documents(odd_frame(spark), queries.tokenizer_path("piece_bpe_32k.model"), ids=True).collect()
    assert sorted(r["decoded"] for r in out) == sorted((t or "").replace("▁", " ") for t in ODD)
    assert sp_prefix.encode_documents(nothing(odd_frame(spark)), queries.tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_documents_are_packed_in_order(spark, tmp_path):
    import corpus_pipeline
    from quipu.llm.queries import op5_packing

    docs = spark.createDataFrame([(k, f"text number {k}. " * (1 + k % 9), "en") for k in range(400)], "doc_id long, text string, lang string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert spark.read.parquet(f"{tmp_path}/documents.parquet").rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
    for rows in (op5_packing(spark, str(tmp_path)), corpus_pipeline.packing_stage(spark, docs.repartition(5), "")):
        laid = [r["doc_id"] for r in rows.orderBy("sequence_id", "offset").collect()]
        assert laid == sorted(laid) and set(laid) == set(range(400))
