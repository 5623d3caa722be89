import random
import re
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from quipu.llm import simhash
from quipu.llm.components import connected_components
from quipu.llm.queries import op2_simhash_near_dedup


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    votes = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def plain_components(prints, ids, radius=3):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            root[find(i)] = find(j)
    least = {}
    for k in range(len(ids)):
        least[find(k)] = min(least.get(find(k), ids[k]), ids[k])
    return [least[find(k)] for k in range(len(ids))]


def test_fingerprint_equals_the_plain_one(spark):
    texts = ["", "One", "one two", "A b\x0bc D é", "x " * 50, "the cat sat on the mat and the cat sat on the mat"]
    assert [simhash.fingerprint(t) for t in texts] == [plain_print(t) for t in texts] and simhash.fingerprint(None) == 0
    assert spark.range(1).select(F.hex(F.xxhash64(F.lit("a b c")))).first()[0].lower() == f"{xxhash.xxh64_intdigest(b'a b c', 42):016x}"


def test_masks_cover_every_difference_within_the_radius():
    masks = simhash.covering_masks(3)
    assert len(masks) == 15 and all(m for m in masks)
    rng = random.Random(2)
    for bits in [*combinations(range(64), 2), *(rng.sample(range(64), 3) for _ in range(3000)), *((k,) for k in range(64))]:
        difference = sum(1 << b for b in bits)
        assert any(not difference & m for m in masks)


def test_forest_connects_what_pairs_connect():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(4)]
    values = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(30)]
    links = simhash.forest(np.array(values, "u8").view("i8"), 3)
    distinct = sorted({simhash.signed(v) for v in values})
    assert len(links) < len(distinct)
    want = plain_components([v & (2**64 - 1) for v in distinct], distinct)
    root = {v: v for v in distinct}
    for a, b in links:
        root[a] = b
    groups = lambda roots: {frozenset(v for v, r in zip(distinct, roots) if r == x) for x in set(roots)}
    assert groups([root[v] for v in distinct]) == groups(want)


def test_components_of_long_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (-5, 3)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: -5 for k in range(41)}, -5: -5, **{100 + k: 100 for k in range(60)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_with_hot_buckets_nulls_and_copies(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(3)]
    prints = [base[0]] * 20 + [b ^ sum(1 << k for k in rng.sample(range(20), rng.randint(0, 5))) for b in base for _ in range(60)] + [0, 0, 7] + [rng.getrandbits(64) for _ in range(50)]
    ids = rng.sample(range(10_000), len(prints))
    df = spark.createDataFrame([(i, simhash.signed(p)) for i, p in zip(ids, prints)], "doc_id long, fp long").repartition(3)
    for block in (8, 1024):
        got = {r["doc_id"]: r["component_id"] for r in simhash.components_of(df, block=block).collect()}
        assert got == dict(zip(ids, plain_components(prints, ids)))


def test_query_equals_all_pairs(spark):
    rows = op2_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    ids = sorted(docs)
    prints = [plain_print(docs[k]) for k in ids]
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == dict(zip(ids, zip((f"{p:016x}" for p in prints), plain_components(prints, ids))))


def test_edge_rows(spark):
    df = spark.createDataFrame([(5, None, "a"), (3, "", "b"), (None, " \t", "c"), (9, "solo text of words here", "d"), (9, "solo text of words here", "d"), (8, "long " * 5000, "e")], "doc_id long, text string, fp string")
    rows = sorted((r["doc_id"] or -1, r["component_id"]) for r in simhash.near_duplicates(df).collect())
    assert rows == [(-1, 3), (3, 3), (5, 3), (8, 8), (9, 9), (9, 9)]
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] or -1 for r in kept.collect()) == [3, 8, 9]
    assert simhash.keep_first(df.filter("spark_partition_id() < 0")).count() == 0
    assert simhash.near_duplicates(df.filter("spark_partition_id() < 0")).count() == 0


def plain_kept(docs, radius=3):
    """Brute force: (key, text) of the one row of each component; rows of one component are ordered by key, those without a key last."""
    prints = [plain_print(t) for _, t in docs]
    groups = {}
    for k, least in enumerate(plain_components(prints, list(range(len(docs))), radius)):
        groups.setdefault(least, []).append(docs[k])
    return [{(k, t or "") for k, t in rows if k == min((k for k, _ in rows if k is not None), default=None)} for rows in groups.values()]


def test_one_row_of_each_component_stays_whatever_the_keys(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(30, 60))) for _ in range(40)]
    docs = [(rng.choice([*range(12), None]), rng.choice(base) + rng.choice(["", "", " tail", " other tail words"])) for _ in range(220)] + [(None, None), (3, ""), (None, " \n")]
    docs += [(1, "one two three four"), (5, "one two three four"), (5, "five six seven eight"), (7, "nine ten eleven twelve"), (None, "lone text without any key")] + [(2, "said twice over")] * 2
    rows = simhash.keep_first(spark.createDataFrame([(k, t, "en", "x") for k, t in docs], "doc_id long, text string, near_k string, fp string").repartition(5))
    assert rows.columns == ["doc_id", "text", "near_k", "fp"]
    got = [(r["doc_id"], r["text"] or "") for r in rows.collect()]
    groups = plain_kept(docs)
    assert len(got) == len(groups) and all(any(g in choices for choices in groups) for g in got)
    assert all(sum(g in choices for g in got) >= 1 for choices in groups)


def test_second_masks_cover_every_difference_within_the_first():
    for m in simhash.covering_masks(3):
        rest = [i for i in range(64) if not m >> i & 1]
        finer = simhash.covering_masks(3, m)
        assert all(x & m == m for x in finer) and min(x.bit_count() for x in finer) >= 45
        for bits in combinations(rest, 3):
            assert any(not sum(1 << b for b in bits) & x for x in finer)


def test_a_crowded_bucket_is_parted_without_losing_a_link(spark):
    rng = random.Random(11)
    base = rng.getrandbits(64)
    prints = list({base ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 9))) for _ in range(500)})
    df = spark.createDataFrame([(k, simhash.signed(p)) for k, p in enumerate(prints)], "doc_id long, fp long").repartition(3)
    want = dict(enumerate(plain_components(prints, list(range(len(prints))))))
    for block in (6, 40):
        assert {r["doc_id"]: r["component_id"] for r in simhash.components_of(df, block=block).collect()} == want
