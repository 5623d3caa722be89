import numpy as np
import pytest

from quipu.llm import ann
from quipu.llm.queries import op8_nearest_neighbours


def exact(ids, vectors, query, k):
    a = np.asarray(vectors, float)
    n = a / np.sqrt((a * a).sum(axis=1, keepdims=True))
    at = ids.index(query)
    scores = n @ n[at]
    order = sorted((i for i in range(len(ids)) if ids[i] != query), key=lambda i: (-round(scores[i], 12), ids[i]))[:k]
    return [(ids[i], scores[i]) for i in order]


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_against_brute_force(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    ids, vectors = [r["vec_id"] for r in rows], [r["embedding"] for r in rows]
    got = found(op8_nearest_neighbours(spark, path))
    assert set(got) == {i for i in ids if i % 50 == 0}
    hits = total = 0
    for q, mine in got.items():
        want = exact(ids, vectors, q, 5)
        hits += len({v for v, _ in mine} & {v for v, _ in want})
        total += 5
        scores = dict(exact(ids, vectors, q, len(ids)))
        assert len(mine) == 5 and all(abs(scores[v] - s) < 1e-12 for v, s in mine)
    assert hits / total >= 0.9


def test_bad_rows_copies_ties_and_few_candidates(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=8).tolist()
    nan, inf = float("nan"), float("inf")
    rows = [(0, base), (50, base), (7, base), (3, base), (3, base), (9, [-x for x in base]), (11, None), (12, []), (13, [0.0] * 8), (14, [nan] * 8), (15, [inf] + [1.0] * 7), (16, [None] + [1.0] * 7), (17, [1.0] * 3), (None, base), (100, [2 * x for x in base])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    got = found(ann.nearest(df, lambda v: v % 50 == 0))
    assert [v for v, _ in got[0]] == [3, 7, 50, 100, 9] and [v for v, _ in got[50]] == [0, 3, 7, 100, 9] and set(got) == {0, 50, 100}
    assert got[0][0][1] == pytest.approx(1.0) and got[0][-1][1] == pytest.approx(-1.0)
    assert ann.nearest(df.filter("vec_id < 0"), lambda v: v % 50 == 0).count() == 0
    assert ann.nearest(df.filter("vec_id = 0"), lambda v: v % 50 == 0).count() == 0


def test_every_length_is_searched_and_copies_count_once(spark):
    rng = np.random.default_rng(3)
    short, long = {k: rng.normal(size=2).tolist() for k in (100, 150, 151)}, {k: rng.normal(size=3).tolist() for k in range(1, 20)}
    rows = [*short.items(), *long.items()] + [(5, long[5])] * 200 + [(200, [1.0]), (250, long[5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = found(ann.nearest(df, lambda v: v % 50 == 0))
    for q in (100, 150):
        assert got[q] == [(v, pytest.approx(s)) for v, s in exact(list(short), list(short.values()), q, 5)]
    assert got[250][0] == (5, pytest.approx(1.0)) and len({v for v, _ in got[250]}) == len(got[250]) == 5 and set(got) == {100, 150, 250}


def test_a_hot_cell_is_parted_without_loss(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16)
    vectors = [(centre + 0.01 * rng.normal(size=16)).tolist() for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(4)
    got = found(ann.nearest(df, lambda v: v % 50 == 0, ann.Params(block=16)))
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in exact(list(range(300)), vectors, q, 5)}) for q in got)
    assert hits / (5 * len(got)) >= 0.9


def layout(vectors, queries, params=ann.Params()):
    """The fitted layout, as the query fits it, with the neighbours found by brute force."""
    unit = ann.units(vectors)
    rng = np.random.default_rng(7)
    asked = queries[: params.sample_queries]
    pairs = []
    for place, q in enumerate(asked):
        scores = unit @ unit[q]
        scores[q] = -2
        pairs.append((place, vectors[np.argsort(-scores)[: params.k]]))
    return ann.fit_tables(vectors[asked], pairs, vectors[rng.permutation(len(vectors))[: params.sample_rows]], len(vectors), params)


def work(vectors, tables, queries, params=ann.Params()):
    """(rows compared, probes sent) for all queries."""
    unit, compared, probes = ann.units(vectors), 0, 0
    for t in range(params.tables):
        cells, sizes = np.unique(tables.number(tables.digits(t, unit)), return_counts=True)
        held = dict(zip(cells.tolist(), sizes.tolist()))
        successes, own = tables.successes(t, unit[queries]), tables.digits(t, unit[queries])
        for q in range(len(queries)):
            met = [held[c] for c in set(tables.number(tables.visits(successes[q], own[q])).tolist()) if c in held]
            compared += sum(met)
            probes += sum(-(-m // params.block) for m in met)
    return compared, probes


def test_visits_are_the_cells_above_the_level_best_first():
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(500, 16))
    tables = layout(vectors, np.arange(0, 500, 50))
    unit = ann.units(vectors)
    successes, own = tables.successes(0, unit[:20]), tables.digits(0, unit[:20])
    every = np.stack(np.meshgrid(*[np.arange(tables.span)] * tables.m, indexing="ij"), -1).reshape(-1, tables.m) if tables.span**tables.m < 200_000 else tables.digits(0, unit)
    scores = tables.score(successes, every)
    for q in range(20):
        visits = tables.visits(successes[q], own[q])
        assert (visits[0] == own[q]).all()
        seen = {tuple(v) for v in visits}
        assert len(seen) == len(visits)
        assert all((tuple(c) in seen) == (s >= tables.level or (c == own[q]).all()) for c, s in zip(every, scores[q]) if abs(s - tables.level) > 1e-9)
        order = tables.score(successes[q : q + 1], visits[1:])[0]
        assert (np.diff(order) <= 1e-9).all()


def test_work_follows_the_rows_where_vectors_are_clustered():
    """Rows compared and probes of all queries (a fiftieth of the rows) grow not much faster than the rows, far from their square; a query is compared with hardly any row."""
    rng = np.random.default_rng(5)
    seen = {}
    for n in (2000, 8000, 32_000):
        centres = rng.normal(size=(n // 20, 32))
        vectors = np.repeat(centres, 20, axis=0) + 0.15 * rng.normal(size=(n, 32))
        queries = np.arange(0, n, 50)
        seen[n] = work(vectors, layout(vectors, queries), queries)
    growth = [np.log(seen[32_000][i] / seen[2000][i]) / np.log(16) for i in (0, 1)]
    assert max(growth) < 1.5 and seen[32_000][0] < 0.01 * 640 * 32_000, (seen, growth)


def test_thousands_of_copies_are_one_class(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(40, 8))
    vectors = [base[0] if k % 3 == 0 else base[k % 40] + 0.01 * rng.normal(size=8) for k in range(1500)]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(4)
    got = found(ann.nearest(df, lambda v: v % 50 == 0))
    assert set(got) == set(range(0, 1500, 50))
    ids = list(range(1500))
    for q in range(0, 1500, 150):  # among the copies: their least ids, all at 1
        assert [v for v, _ in got[q]] == [i for i in range(0, 30, 3) if i != q][:5]
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in exact(ids, vectors, q, 5)}) for q in got)
    assert hits / (5 * len(got)) >= 0.9


def test_queries_apart_from_all_rows_still_find_k(spark):
    rng = np.random.default_rng(4)
    vectors = [(np.eye(24)[k % 3] + 0.001 * rng.normal(size=24)).tolist() for k in range(300)]
    vectors[50] = (-np.eye(24)[7] + 0.001).tolist()
    got = found(ann.nearest(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>"), lambda v: v % 50 == 0))
    assert all(len(v) == 5 for v in got.values()) and [v for v, _ in got[50]] == [v for v, _ in exact(list(range(300)), vectors, 50, 5)]
