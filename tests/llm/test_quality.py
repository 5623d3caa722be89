import base64
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quipu.llm import quality
from quipu.llm.queries import op7_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    t = text or ""
    words = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marked), n < 50 or 100 * len(marked) > 50 * n


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab c\n\t\x0b\x1c\x85é#|", max_size=200))
def test_counts_equal_plain_ones(text):
    assert quality.base_counts(text) == plain_counts(text)


def test_counts_of_nothing():
    assert quality.base_counts(None) == quality.base_counts("") == (0, 0, 0, 0, 0, True)


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_bands_keep_prose_and_reject_both_ends():
    squeeze, bands, rng = zstandard.ZstdCompressor(level=3).compress, quality.Bands(), random.Random(4)
    kept = lambda t: quality.judge(t, bands, squeeze)[-1]
    for n in (60, 200, 1000, 8000):
        assert kept(prose(rng, n))
    assert not kept(" ".join(f"{k % 7} row" + "a" * 40 for k in range(400)))
    for n in (1100, 6000, 40_000):
        blob = base64.b64encode(rng.randbytes(n)).decode()
        assert not kept(" ".join(blob[i : i + 60] for i in range(0, len(blob), 60)))
    part = prose(rng, 3000) + " " + "".join(f"z{k % 10}y " for k in range(4000)) + prose(rng, 3000)
    assert not kept(part)


def test_bad_tails_of_long_texts_are_seen():
    squeeze, bands, rng = zstandard.ZstdCompressor(level=3).compress, quality.Bands(), random.Random(5)
    kept = lambda t: quality.judge(t, bands, squeeze)[-1]
    for whole in (4096, 8192):
        for size in (64, 500, 1000, 2000, 2047, 2100):
            start = prose(rng, whole)[:whole]
            assert kept(start + prose(rng, size)[:size])
            assert not kept(start + base64.b64encode(rng.randbytes(size))[:size].decode())
            assert not kept(start + ("same row " * size)[:size])


def test_rows_through_spark(spark):
    rng = random.Random(1)
    texts = [None, "", "   \n ", prose(rng, 90), prose(rng, 90), prose(rng, 30000)]
    df = spark.createDataFrame([(k, t, True, "x") for k, t in enumerate(texts)], "doc_id long, text string, quality_verdict boolean, n_words string")
    rows = {r["doc_id"]: r for r in quality.score_quality(df).collect()}
    for k, t in enumerate(texts):
        assert tuple(rows[k][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == plain_counts(t)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {3, 4, 5}
    assert quality.score_quality(df.filter("spark_partition_id() < 0")).count() == 0


def plain_verdict(text, bands):
    """Brute force: limits interpolated by numpy, every chunk cut and compressed anew."""
    raw = (text or "").encode()
    if plain_counts(text)[-1]:
        return False
    squeezed = lambda b: len(zstandard.ZstdCompressor(level=3).compress(b))

    def limits(size):
        at = np.log2(max(size, 1)), np.arange(len(bands.centre)) + bands.first
        centre, spread = np.interp(*at, bands.centre), np.interp(*at, bands.spread)
        return min(0.70 * centre, 1.45), centre * (1 + 3 * spread), centre

    low, high, _ = limits(len(raw))
    if not low <= len(raw) / squeezed(raw) <= high:
        return False
    if len(raw) <= 4096:
        return True
    chunks, rest = [raw[i : i + 4096] for i in range(0, len(raw), 4096)], b""
    if len(chunks[-1]) < 4096:
        rest = chunks.pop()
        chunks.append(raw[-4096:])
    if not all(bands.chunk_low <= 4096 / squeezed(c) <= bands.chunk_high for c in chunks):
        return False
    if len(rest) < 64:
        return True
    before = chunks[-2]
    return len(rest) >= bands.tail_low * (squeezed(before + rest) - squeezed(before)) and len(rest) / squeezed(rest) <= 1.3 * limits(len(rest))[2]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_plain_verdicts(spark, sf):
    """The bands are fitted anew from the labels by plain means, and every verdict is made again."""
    path = f"/root/testdata/{sf}"
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{path}/documents.parquet'").fetchall())
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{path}/labels.parquet'").fetchall())
    good = [docs[k] for k, q in labels.items() if q and k in docs and zlib.crc32(str(k).encode()) % 5 and not plain_counts(docs[k])[-1]]
    squeeze = zstandard.ZstdCompressor(level=3).compress
    seen = np.array([(len(t.encode()), *quality.ratios(t.encode(), quality.Bands(), squeeze)) for t in good])
    bands = quality.fitted(*seen.T, quality.FitParams(), quality.Bands())
    got = op7_quality_rules(spark, path).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_counts(docs[r["doc_id"]])
        assert r["kept"] == plain_verdict(docs[r["doc_id"]], bands), r["doc_id"]


def test_held_out_labels():
    """Of good texts that pass the base rules nearly all stay, of bad ones (stuffed with symbols, which repeat) most go."""
    path = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"SELECT doc_id, text, quality FROM '{path}/documents.parquet' JOIN '{path}/labels.parquet' USING (doc_id)").fetchall()
    squeeze, sizes, stays = zstandard.ZstdCompressor(level=3).compress, [], {0: [], 1: []}
    train = [quality.judge(t, quality.Bands(), squeeze) + (len(t.encode()),) for k, t, q in rows if q and zlib.crc32(str(k).encode()) % 5]
    sizes = np.array([(x[10], *x[6:9]) for x in train if not x[5]])
    bands = quality.fitted(*sizes.T, quality.FitParams(), quality.Bands())
    for k, t, q in rows:
        if zlib.crc32(str(k).encode()) % 5 == 0:
            x = quality.judge(t, bands, squeeze)
            if not x[5]:
                stays[q].append(x[-1])
    assert np.mean(stays[1]) > 0.98 and np.mean(stays[0]) < 0.4


def test_fit_of_few_labels_and_of_repeated_keys(spark):
    docs = spark.createDataFrame([(1, "a b " * 100), (1, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, labels) == quality.fit(docs.filter("spark_partition_id() < 0"), labels.filter("spark_partition_id() < 0")) == quality.Bands()


def test_repeated_words_with_many_distinct_ones():
    rng = random.Random(2)
    for n in (3, 4, 50, 3000):
        words = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(n)]
        assert quality.repeated_words(words) == plain_counts(" ".join(words))[4]
    far = [str(k) for k in range(1_100_000)]
    assert quality.repeated_words(far + far[:3]) == 6


def test_fit_sees_every_label(spark, tmp_path):
    """30,000 labelled texts, more than any sample of the fit ever was: the bands are those of all of them."""
    words = "some plain words of a text that is as good as any other one here and there".split()
    rng = random.Random(11)
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(200)]
    pick = F.array(*[F.lit(t) for t in texts])
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.element_at(pick, (F.pmod(F.xxhash64("id"), F.lit(200)) + 1).cast("int")), F.lit(" "), F.md5(F.col("id").cast("string"))).alias("text"))
    docs.repartition(4).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    squeeze = zstandard.ZstdCompressor(level=quality.Bands().level).compress
    seen = [(len(t.encode()), *quality.ratios(t.encode(), quality.Bands(), squeeze)) for k, t in docs.collect() if zlib.crc32(str(k).encode()) % 5 and not quality.base_counts(t)[-1]]
    plain = quality.fitted(*np.array(seen).T, quality.FitParams(), quality.Bands())
    got = quality.fit(docs, labels)
    assert np.allclose(got.centre, plain.centre, rtol=0, atol=1e-9) and np.allclose(got.spread, plain.spread, rtol=0, atol=1e-9)
