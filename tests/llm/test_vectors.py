"""Vector codes and centroids, held against plain loops over Python's integers."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from quipu.llm import centroids, exact, vector_codes
from quipu.llm.queries import ORACLE_SQL, op12_vector_codes, op13_centroid_clustering
from tests.helpers import duck, sparked

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("name,query", [("op12_vector_codes", op12_vector_codes), ("op13_centroid_clustering", op13_centroid_clustering)])
@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_equals_its_sql(spark, name, query, sf):
    assert sparked(query(spark, f"/root/testdata/{sf}")) == duck(sf, ORACLE_SQL[name])


def down(x, scale):
    return math.floor(Fraction(x) * scale)


def kept(rows, scale):
    return [(r, [down(x, scale) for x in r[1]]) for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def apart(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def nearest(p, points):
    return min((apart(p, c), i) for i, c in enumerate(points))


def last_first(key):
    return (key is None, key or 0)


def lloyd(points, vectors, rounds):
    for _ in range(rounds):
        held = {}
        for v in vectors:
            held.setdefault(nearest(v, points)[1], []).append(v)
        points = [[sum(c) // len(held[i]) for c in zip(*held[i])] if i in held and p else p for i, p in enumerate(points)]
    return points


def coded(rows, scale=4096):
    """{(vec_id, label, code, error, label_error, sha)} as sorted text."""
    out = []
    mine = kept(rows, scale)
    for dim in {len(y) for _, y in mine}:
        alike = [(r, y) for r, y in mine if len(y) == dim]
        if dim % 8:
            out += [(r[0], r[2], None, None, None) for r, _ in alike]
            continue
        first = [y for _, y in sorted(alike, key=lambda x: (last_first(x[0][0]), x[1]))[:16]]
        w, books = dim // 8, []
        for k in range(8):
            books.append(lloyd([y[k * w : k * w + w] for y in first], [y[k * w : k * w + w] for _, y in alike], 6))
        sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for r, y in alike:
            best = [nearest(y[k * w : k * w + w], books[k]) for k in range(8)]
            error = sum(d for d, _ in best)
            out.append((r[0], r[2], "".join(f"{i:02x}" for _, i in best), error if error < 1 << 63 else None, sha))
    totals = {}
    for r in out:
        totals[r[1]] = totals.get(r[1], 0) + (r[3] or 0)
    return sorted(((*r[:4], totals[r[1]] if totals[r[1]] < 1 << 63 else None, r[4]) for r in out), key=str)


def clustered(rows, scale=1024):
    mine = [(r, y) for r, y in kept(rows, scale) if len(y) == 64]
    order = lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "~"
    points = lloyd([y for _, y in sorted(mine, key=lambda x: (order(x[0]), x[1]))[:8]], [y for _, y in mine], 10)
    fits = lambda n: n if n < 1 << 63 else None
    found = [(r[0], *nearest(y, points)) for r, y in mine]
    total = lambda c=None: fits(sum(d for _, d, i in found if fits(d) is not None and c in (None, i)))
    return sorted(((key, i, fits(d), total(i), total(), hashlib.sha256(",".join(map(str, points[i])).encode()).hexdigest()) for key, d, i in found), key=str)


def odd_vectors(dim, seed, n=60):
    rng = random.Random(seed)
    point = lambda: [rng.choice([rng.gauss(0, 1), 0.0, -0.0, 0.25, -1 / 4096, rng.gauss(0, 1e-3)]) for _ in range(dim)]
    rows = [(rng.randrange(-50, 200), point(), rng.choice([1, 2, None])) for _ in range(n)]
    copy = point()
    rows += [(1000 + k, copy, 7) for k in range(40)] + [rows[0]] * 3 + [(None, point(), 1), (None, copy, None)]
    broken = [None, [None] * dim, [NAN] + [0.0] * (dim - 1), [0.0] * (dim - 1) + [-INF]]
    return rows + [(-100 - k, v, 1) for k, v in enumerate(broken)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, code string").repartition(5)


def results(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_codes_of_odd_vectors(spark):
    rows = odd_vectors(16, 1) + odd_vectors(8, 2, 5) + [(1, [0.5] * 9, 3), (2, [1.0], None), (3, [], 3)]
    got, books = vector_codes.compress(frame(spark, rows))
    assert results(got) == coded(rows) and sorted(books) == [0, 8, 16]
    one = got.filter("vec_id = 1000").first()
    lossy = vector_codes.decode(one["code"], books[16])
    own = next(r[1] for r in rows if r[0] == 1000)
    assert sum((down(x, 4096) - y * 4096) ** 2 for x, y in zip(own, lossy)) == one["error"]


def test_clusters_of_odd_vectors(spark):
    rows = odd_vectors(64, 3) + [(1, [0.5] * 63, 3), (3, [], 3)]
    got, points = centroids.cluster_vectors(frame(spark, rows))
    assert results(got) == clustered(rows) and len(points) == 8


def test_huge_numbers_stay_exact(spark):
    rng = random.Random(4)
    rows = [(k, [rng.choice([1.0, 1e18, -1e30, 3.4e38, rng.gauss(0, 1)]) for _ in range(64)], k % 2) for k in range(30)]
    rows += [(100 + k, [rng.gauss(0, 1e-2) for _ in range(64)], 5) for k in range(10)]
    assert results(vector_codes.compress(frame(spark, rows))[0]) == coded(rows)
    assert results(centroids.cluster_vectors(frame(spark, rows))[0]) == clustered(rows)


def test_no_rows(spark):
    for rows in (frame(spark, odd_vectors(64, 5)).filter("spark_partition_id() < 0"), frame(spark, [(1, None, 1), (2, [NAN] * 64, 1)])):
        assert vector_codes.compress(rows)[0].count() == 0
        assert centroids.cluster_vectors(rows)[0].count() == 0


def test_equal_parts_are_one_row(spark):
    rows = [(k, [float(k % 3)] * 8 + [0.0] * 8, 1) for k in range(90)]
    kept_rows = exact.kept_vectors(frame(spark, rows), 4096, "embedding", "vec_id").selectExpr("size(y) AS dim", "y")
    parts = vector_codes.distinct_parts(kept_rows, 8).collect()
    assert sorted((r["part"], r["weight"]) for r in parts) == sorted([(k, 30) for k in range(4) for _ in range(3)] + [(k, 90) for k in range(4, 8)])


def test_bounds_skip_most_distances_and_change_nothing():
    rng = np.random.default_rng(6)
    seeds = rng.integers(-3000, 3000, (8, 64))
    y = (seeds[rng.integers(0, 8, 2000)] + rng.integers(-60, 60, (2000, 64))).astype(float)
    y[:40] = (seeds[0] + seeds[1]) // 2  # ties, or nearly
    points, taken, plain = [[int(x) for x in row] for row in y[:8]], [], 8 * len(y)
    cluster, upper, lower, _ = centroids.first_step(y, centroids.Centres(points))
    for _ in range(6):
        new = [[int(x) for x in y[cluster == c].sum(axis=0).astype(np.int64) // (cluster == c).sum()] if (cluster == c).any() else points[c] for c in range(8)]
        centres = centroids.Centres(new, points)
        cluster, upper, lower, n = centroids.elkan_step(y, cluster, upper, lower, centres)
        taken.append(n)
        d = centres.exact.distances(y)
        assert (cluster == np.argmin(d, axis=1)).all()
        assert (upper >= np.sqrt(d[np.arange(len(d)), cluster].astype(float)) * (1 - 1e-12)).all() and (lower <= np.sqrt(d.astype(float)) * (1 + 1e-12)).all()
        points = new
    assert taken[-1] < plain // 20


def test_exact_ties_go_to_the_smaller_number():
    points = [[10, 0], [0, 0], [10, 0], [-10, 0]]
    y = np.array([[5.0, 0.0], [5.0, 7.0], [-5.0, 1.0], [10.0, 3.0]])
    cluster, upper, lower, _ = centroids.first_step(y, centroids.Centres([[9, 9], [0, 1], [8, 8], [-9, 0]]))
    cluster, *_ = centroids.elkan_step(y, cluster, upper, lower, centroids.Centres(points, [[9, 9], [0, 1], [8, 8], [-9, 0]]))
    assert cluster.tolist() == [0, 0, 1, 0]


def test_sums_keep_every_digit(spark):
    rng, sums, want = random.Random(7), exact.Sums(), {}
    for _ in range(50):
        y = [float(rng.choice([-1, 1]) * rng.choice([0, 3, 2**29, 2**30, 2**52, 10**25, 10**300])) for _ in range(4)]
        w, e = rng.randint(1, 1 << 40), rng.randrange(3)
        sums.add(0, np.array([e]), np.array([y]), np.array([w]))
        want[e] = [a + b for a, b in zip(want.get(e, [0] * 5), [w, *[w * int(x) for x in y]])]
    rows = spark.createDataFrame(list(sums.digits()), exact.DIGITS).repartition(3)
    got = exact.collected(rows)
    assert {e: [got[0, e].get(p, 0) for p in range(5)] for e in want} == want
