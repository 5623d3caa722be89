import math
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quipu.llm import toxicity
from quipu.llm.queries import op1_toxicity


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


words = st.text(alphabet="abc", max_size=7)


@settings(max_examples=400, deadline=None)
@given(st.lists(words.filter(bool), min_size=1, max_size=12), words)
def test_automaton_in_the_trie_finds_exactly_one_edit(terms, word):
    assert toxicity.Trie(terms).within_one(word) == {t for t in terms if edit(t, word) <= 1}


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="abc", min_size=5, max_size=7), min_size=1, max_size=8), st.text(alphabet="abc", min_size=4, max_size=8))
def test_the_probe_of_a_prefix_loses_no_hit(terms, word):
    matcher = toxicity.Matcher(toxicity.Model(terms=terms))
    assert (matcher.kind(word) is not None) == any(edit(t, word) <= 1 for t in terms)


def test_context_separates_quotation_from_abuse():
    m = toxicity.Matcher(toxicity.Model(terms=["scoundrel"]))
    abuse = toxicity.features("you scoundrel go away".split(), m, 8)
    quoted = toxicity.features('the paper printed the words "you scoundrel" in full'.split(), m, 8)
    near = toxicity.features("you scoundrell go away".split(), m, 8)
    assert abuse[1] == 1 and quoted[1] == 0 and quoted[4] == 1 and near[2] == 1
    w = toxicity.PRIOR
    assert toxicity.score_of(abuse, w) > toxicity.score_of(near, w) > toxicity.score_of(quoted, w) > toxicity.score_of(toxicity.features(["fine"], m, 8), w)


def corpus(spark):
    rng = random.Random(11)
    clean = ["".join(rng.choice("etaoinsh") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    bad = ["blockhead", "nincompoop", "rascal", "swine"]
    docs, labels = [], []
    for k in range(600):
        text = [rng.choice(clean) for _ in range(40)]
        toxic = k % 6 == 0
        if toxic:
            for b in rng.sample(bad, 2):
                text.insert(rng.randrange(40), b)
        docs.append((k, " ".join(text), "en"))
        labels.append((k, 1, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs, labels


def test_learns_and_holds_out(spark):
    docs, labels, raw, truth = corpus(spark)
    extra = spark.createDataFrame([(1000, "oh you blockheadd and nincompop", "en"), (1001, None, None), (1002, "", None), (None, "calm", None), (1003, "calm words only", "en")], docs.schema)
    model = toxicity.fit(docs, labels)
    assert {"blockhead", "nincompoop", "rascal", "swine"} <= set(model.terms) | {t for t in ("blockhead", "nincompoop", "rascal", "swine") if any(t.startswith(s) for s in model.stems)}
    rows = {r["doc_id"]: r for r in toxicity.score_toxicity(docs.union(extra), model).collect()}
    for (k, _, toxic) in truth:
        assert rows[k]["predicted"] == toxic
        assert rows[k]["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0)
    assert rows[1001]["score"] == rows[1002]["score"] == rows[1003]["score"] < 0.5 and rows[None]["held_out"] is False
    assert rows[1000]["score"] > rows[1003]["score"]
    kept = toxicity.keep_clean(docs.union(extra), model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()}.isdisjoint({k for k, _, t in truth if t})


def test_misspelt_starts_are_hits_though_stems_displace_terms(spark):
    rng = random.Random(12)
    clean = ["".join(rng.choice("etaoinsh") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    bad = ["clown", "disgusting", "worthless", "pathetic"]
    docs, labels = [], []
    for k in range(600):
        text = [rng.choice(clean) for _ in range(40)]
        if k % 4 == 0:
            for b in rng.sample(bad, 3):
                text.insert(rng.randrange(40), b + rng.choice(["", "", "###", "ly", "x#"]))
        docs.append((k, " ".join(text), "en"))
        labels.append((k, 1, int(k % 4 == 0)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert model.stems
    matcher = toxicity.Matcher(model)
    for b in bad:
        assert matcher.kind(b) == "exact"
        for i in range(4):
            for misspelt in (b[:i] + b[i + 1 :], b[:i] + "q" + b[i + 1 :], b[:i] + "q" + b[i:]):
                assert matcher.kind(misspelt) is not None, (b, misspelt)


def test_held_out_labels_are_never_read(spark):
    docs, labels, _, truth = corpus(spark)
    flipped = spark.createDataFrame([(k, q, 1 - t if zlib.crc32(str(k).encode()) % 5 == 0 else t) for k, q, t in truth], labels.schema)
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert a == b


def test_without_toxic_labels(spark):
    docs, labels, _, _ = corpus(spark)
    for some in (labels.filter("toxic = 0"), labels.filter("spark_partition_id() < 0")):
        model = toxicity.fit(docs, some)
        assert not model.terms and {r["predicted"] for r in toxicity.score_toxicity(docs, model).collect()} == {0}


def test_held_out_accuracy_on_the_tables(spark):
    sf = "/root/testdata/sf0.1"
    rows = op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").select("toxic", "predicted", "score").collect()
    hits = sum(r["toxic"] and r["predicted"] for r in rows)
    assert hits / sum(r["toxic"] for r in rows) > 0.8 and hits / max(1, sum(r["predicted"] for r in rows)) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def plain_score(text, model):
    """Brute force: every word against every term by edit distance, and the context by hand."""
    words = (text or "").lower().split()
    trim = ".,;:!?()[]{}<>*_~-|" + "\"“”„«»‘’'`"
    core = [w.strip(trim) for w in words]

    def kind(w):
        if w in model.terms or any(w.startswith(s) and w != s for s in model.stems):
            return "exact"
        near = len(w) >= 4 and w not in model.benign and any(len(t) >= 4 and abs(len(t) - len(w)) <= 1 and edit(t, w) <= 1 for t in model.terms)
        return "near" if near else None

    seen = {w: kind(w) for w in set(core)}
    at = [i for i, w in enumerate(core) if seen[w]]
    counts = dict.fromkeys(("exact", "near", "beside", "quoted"), 0)
    for i in at:
        low, high = max(0, i - model.window), min(len(words), i + model.window + 1)
        opened = any(w[0] in "\"“”„«»‘’'`" for w in words[low : i + 1])
        ends = [w.rstrip(".,;:!?") for w in words[i:high]]
        closed = any(w and w[-1] in "\"“”„«»‘’'`" for w in ends)
        told = any(w in toxicity.REPORTING for w in core[low:high])
        counts["quoted" if opened and closed or told else seen[core[i]]] += 1
        counts["beside"] += any(j != i and abs(i - j) <= model.window for j in at)
    z = model.weights[0] + sum(w * math.log2(1 + n) for w, n in zip(model.weights[1:], counts.values()))
    return 1 / (1 + math.exp(-z))


def test_every_score_equals_the_plain_one(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{path}/labels.parquet"))
    rng = random.Random(3)
    odd = [" ".join(rng.choice([*model.terms, *model.stems, "the", "said", "“oh", "well”", "'x", "y'."]) + rng.choice(["", "", "s", "x", "!", "."]) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    texts = [r["text"] for r in docs.collect()] + odd + ["calm words " * 60_000 + model.terms[0], None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(df, model).collect()}
    for k, t in enumerate(texts):
        assert got[k] == pytest.approx(plain_score(t, model), rel=1e-9), k


def test_columns_of_clashing_names(spark):
    docs, labels, _, _ = corpus(spark)
    more = docs.selectExpr("doc_id", "text", "lang as score", "lang as predicted", "doc_id as labelled_id", "lang as toxicity_score", "1 as toxic", "2 as held_out")
    model = toxicity.fit(more, labels)
    assert model == toxicity.fit(docs, labels)
    kept = toxicity.keep_clean(more, model)
    assert kept.columns == more.columns and kept.count() == toxicity.keep_clean(docs, model).count()
    assert toxicity.score_toxicity(more, model).columns == ["doc_id", "held_out", "score", "predicted"]
    assert toxicity.score_toxicity(more.filter("spark_partition_id() < 0"), model).count() == 0


def test_a_misspelt_term_of_four_letters_is_near():
    matcher = toxicity.Matcher(toxicity.Model(terms=["scum", "sun"], benign=["slum"]))
    assert [matcher.kind(w) for w in ("scum", "scumm", "scun", "slum", "scm", "sum", "suns")] == ["exact", "near", "near", None, None, None, None]


def test_a_matcher_holds_a_bounded_number_of_starts():
    """Words of every start, as junk has them: what a worker remembers doesn't grow with them, and their kinds stay the same."""
    rng = random.Random(4)
    model = toxicity.Model(terms=["idiot", "moron"], stems=["fool"])
    small, whole = toxicity.Matcher(model, most=500), toxicity.Matcher(model)
    for _ in range(20):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=6)) for _ in range(200)] + ["idiott", "morn", "fooled", "idiot"]
        assert small.hits(words) == whole.hits(words) and len(small.hits(words)) >= 4
        assert max(len(small.alive), len(small.seen), len(small.kinds)) <= 500
    assert len(whole.alive) > 500
