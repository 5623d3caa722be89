"""Centroid clustering by Lloyd's rounds with Elkan's bounds.

Each vector carries an upper bound of the distance to its centroid and a lower
bound of that to every centroid.  When centroids move, bounds move with them,
and by the triangle inequality

    upper < half the gap to the nearest other centroid       no distance at all,
    upper < lower[c]  or  upper < half the gap to c          none to c.

Bounds are doubles, rounded outwards at every step, and all comparisons are
strict, so a centroid that ties with the nearest one is never skipped;
what isn't skipped is compared by exact whole-number distances, ties to the
smaller number.  Bounds save work only: results are those of plain rounds.

Scale.  A round is one map over the table of vectors and bounds, written to the
shared folder, from which a lost task is done again; the folder before the last
is removed.  Centroids are updated by what vectors that changed their cluster
add and take away, so later rounds send few vectors to the sums; the driver
gets one number per centroid, component and digit.  A hot cluster is no hot
task, since nothing is dealt by cluster.

Defined results
    Vectors without exactly ``length`` components, or with a null or non-finite
    one, are left out.  First centroids: those with the least sha256 of
    ``3:<vec_id>``; of equal ids the lesser vector first, each row by itself, rows
    without an id last.  Fewer vectors than clusters: as many clusters as
    vectors.  An empty cluster keeps its centroid.  Repeated rows are clustered
    one by one.  A distance or sum beyond 64 bits is null.  Extra columns,
    whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, materialize, prepare
from .exact import DIGITS, Points, Sums, collected, kept_vectors, long_or_none, root_down, root_up

BOUNDED = "keyed boolean, k long, y array<double>, cluster int, before int, upper double, lower array<double>"


@dataclass(frozen=True)
class Params:
    scale: int = 1024
    length: int = 64
    clusters: int = 8
    rounds: int = 10
    salt: str = "3:"


class Centres:
    """Centroids of one round, and how far each may have moved since the bounds were taken."""

    def __init__(self, points: list[list[int]], before: list[list[int]] | None = None):
        self.exact, k = Points(points), len(points)
        square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
        #: Not above the true gaps.
        self.gap = np.array([[root_down(square(a, b)) for b in points] for a in points])
        other = self.gap + np.where(np.eye(k, dtype=bool), np.inf, 0.0)
        self.half_nearest = other.min(axis=1) / 2
        self.moved = np.array([root_up(square(a, b)) for a, b in zip(points, before or points)])


def outwards(x: np.ndarray, way: float) -> np.ndarray:
    return np.nextafter(x, way)


def roots(d: np.ndarray, down: bool) -> np.ndarray:
    """Bounds of the roots of exact squares."""
    if d.dtype != object and (not d.size or d.max() < 1 << 53):
        r = np.sqrt(d.astype(np.float64))  # rounded once, by half a step at most
        return np.where(d > 0, outwards(r, 0.0 if down else np.inf), 0.0)
    one = root_down if down else root_up
    return np.array([one(int(x)) for x in d.ravel()]).reshape(d.shape)


def first_step(y: np.ndarray, centres: Centres) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Clusters, upper and lower bounds of vectors that have none yet; and the distances taken."""
    d = centres.exact.distances(y)
    cluster = np.argmin(d, axis=1)
    return cluster, roots(d[np.arange(len(d)), cluster], False), roots(d, True), d.size


def elkan_step(y: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centres: Centres) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same after the centroids have moved."""
    k = len(centres.moved)
    # A bound that didn't move stays as it is: rounding it again would wear it away.
    moved = centres.moved[cluster]
    upper = np.where(moved > 0, outwards(upper + moved, np.inf), upper)
    lower = np.where(centres.moved > 0, np.maximum(outwards(lower - centres.moved, -np.inf), 0.0), lower)
    cluster, taken = cluster.copy(), 0
    open_ = np.flatnonzero(~(upper < centres.half_nearest[cluster]))
    if not len(open_):
        return cluster, upper, lower, taken
    old = cluster[open_]
    skip = lambda: (upper[open_][:, None] < lower[open_]) | (upper[open_][:, None] < centres.gap[old] / 2) | (np.arange(k) == old[:, None])
    close = ~skip().all(axis=1)
    open_, old = open_[close], old[close]
    if not len(open_):
        return cluster, upper, lower, taken
    best = np.zeros(len(open_), dtype=object)
    for c in np.unique(old).tolist():  # the own distance first: it may settle the rest
        mine = np.flatnonzero(old == c)
        d = centres.exact.distances(y[open_[mine]], [c])[:, 0]
        best[mine] = d
        upper[open_[mine]], lower[open_[mine], c] = roots(d, False), roots(d, True)
        taken += len(mine)
    skipped, now = skip(), old.copy()
    for c in range(k):
        mine = np.flatnonzero(~skipped[:, c])
        if len(mine):
            d = centres.exact.distances(y[open_[mine]], [c])[:, 0]
            lower[open_[mine], c] = roots(d, True)
            taken += len(mine)
            better = ((d < best[mine]) | ((d == best[mine]) & (c < now[mine]))).astype(bool)
            best[mine[better]], now[mine[better]] = d[better], c
    changed = now != old
    cluster[open_] = now
    for i in np.flatnonzero(changed).tolist():
        upper[open_[i]] = root_up(int(best[i]))
    return cluster, upper, lower, taken


def _stacked(pdf: pd.DataFrame, column: str) -> np.ndarray:
    return np.stack(pdf[column].to_numpy()).astype(np.float64)


def _round(state: DataFrame, centres: Centres, first: bool) -> DataFrame:
    """Rows of ``BOUNDED`` after one assignment."""

    def assign(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            y = _stacked(pdf, "y")
            if first:
                before = np.full(len(pdf), -1, np.int32)
                cluster, upper, lower, _ = first_step(y, centres)
            else:
                before = pdf["cluster"].to_numpy()
                cluster, upper, lower, _ = elkan_step(y, before, pdf["upper"].to_numpy().copy(), _stacked(pdf, "lower"), centres)
            yield pd.DataFrame({"keyed": pdf["keyed"], "k": pdf["k"], "y": pdf["y"], "cluster": cluster.astype(np.int32), "before": before.astype(np.int32), "upper": upper, "lower": list(lower)})

    return state.mapInPandas(assign, BOUNDED)


def _moves(state: DataFrame, clusters: int) -> dict[tuple, dict[int, int]]:
    """What the vectors that changed add to their new cluster and take from their old one, summed."""

    def add(batches):
        sums = Sums()
        for pdf in batches:
            if len(pdf):
                y, cluster, before = _stacked(pdf, "y"), pdf["cluster"].to_numpy(), pdf["before"].to_numpy()
                sums.add(0, cluster, y, np.ones(len(pdf), np.int64))
                left = before >= 0
                sums.add(0, before[left], y[left], -np.ones(int(left.sum()), np.int64))
        if found := list(sums.digits()):
            yield pd.DataFrame(found, columns=[c.split()[0] for c in DIGITS.split(", ")])

    return collected(state.filter("cluster <> before").select("y", "cluster", "before").mapInPandas(add, DIGITS))


def _final(state: DataFrame, centres: Centres) -> DataFrame:
    """(vec_id, cluster, distance) with exact distances to the clusters of the last assignment."""

    def measure(batches):
        for pdf in batches:
            if len(pdf):
                y, cluster, out = _stacked(pdf, "y"), pdf["cluster"].to_numpy(), [None] * len(pdf)
                for c in np.unique(cluster).tolist():
                    mine = np.flatnonzero(cluster == c)
                    for i, d in zip(mine.tolist(), centres.exact.distances(y[mine], [c])[:, 0].tolist()):
                        out[i] = long_or_none(d)
                yield pd.DataFrame({"keyed": pdf["keyed"], "k": pdf["k"], "cluster": pdf["cluster"], "distance": pd.Series(out, dtype="Int64", index=pdf.index)})

    found = state.select("keyed", "k", "y", "cluster").mapInPandas(measure, "keyed boolean, k long, cluster int, distance long")
    return found.select(F.when(F.col("keyed"), F.col("k")).alias("vec_id"), "cluster", "distance")


def digest(point: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, point)).encode()).hexdigest()


def cluster_vectors(rows: DataFrame, params: Params = Params(), vector: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of the vectors that take part; and the final centroids."""
    spark = rows.sparkSession
    prepare(spark)
    with Scratch(spark) as scratch:
        kept = kept_vectors(rows, params.scale, vector, key).filter(F.size("y") == params.length)
        number = F.col("vec_id").cast("long")
        vectors = scratch.put(kept.select(number.isNotNull().alias("keyed"), F.coalesce(number, F.lit(0)).cast("long").alias("k"), "y"), "vectors")
        order = F.sha2(F.concat(F.lit(params.salt), F.when(F.col("keyed"), F.col("k").cast("string"))), 256)
        points = [[int(x) for x in r["y"]] for r in vectors.orderBy(order.asc_nulls_last(), "y").limit(params.clusters).select("y").collect()]
        if not points:
            return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"), []
        sums = {c: [0] * (params.length + 1) for c in range(len(points))}
        with _Rounds(spark) as rounds:
            state, centres = rounds.put(_round(vectors, Centres(points), True)), Centres(points)
            for _ in range(params.rounds):
                for (_, c), places in _moves(state, len(points)).items():
                    for place, x in places.items():
                        sums[c][place] += x
                new = [[x // sums[c][0] for x in sums[c][1:]] if sums[c][0] else old for c, old in enumerate(points)]
                if new == points:
                    break  # every further round gives the same
                centres, points = Centres(new, points), new
                state = rounds.put(_round(state, centres, False))
            measured = scratch.put(_final(state, centres), "measured")
        totals = {r["cluster"]: r["total"] for r in measured.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()}
        fits = lambda x: F.lit(long_or_none(x)).cast("long")
        of = lambda value: F.coalesce(*[F.when(F.col("cluster") == c, value(c)) for c in sorted(totals)])
        out = measured.select(
            "vec_id", "cluster", "distance",
            of(lambda c: fits(totals[c] or 0)).alias("cluster_inertia"), fits(sum(t or 0 for t in totals.values())).alias("inertia"), of(lambda c: F.lit(digest(points[c]))).alias("centroid_sha256"),
        )
        return materialize(out, "clustered"), points


class _Rounds:
    """Tables of rounds, of which only the last is kept."""

    def __init__(self, spark: SparkSession):
        self.spark, self.last = spark, None

    def put(self, df: DataFrame) -> DataFrame:
        scratch = Scratch(self.spark)
        out = scratch.put(df, "round")
        if self.last:
            self.last.__exit__()
        self.last = scratch
        return out

    def __enter__(self) -> _Rounds:
        return self

    def __exit__(self, *_) -> None:
        if self.last:
            self.last.__exit__()


def sql(params: Params = Params()) -> str:
    """DuckDB form of what op13 returns: plain rounds; a nearest centroid is the least of distance * clusters + number."""
    n = params.clusters
    near = lambda k: f"""d{k} AS MATERIALIZED (
  SELECT vec_id, CAST(min(d * {n} + c) AS BIGINT) AS best FROM (
    SELECT v.vec_id, e.c, sum((v.x - e.x) * (v.x - e.x)) AS d FROM cells v JOIN c{k} e ON v.place = e.place GROUP BY ALL
  ) GROUP BY vec_id)"""  # noqa: E731
    steps = []
    for k in range(params.rounds):
        steps += [near(k), f"""c{k + 1} AS MATERIALIZED (
  SELECT o.c, o.place, CAST(coalesce((s.total - ((s.total % s.n) + s.n) % s.n) // s.n, o.x) AS BIGINT) AS x
  FROM c{k} o LEFT JOIN (
    SELECT d.best % {n} AS c, v.place, sum(v.x) AS total, count(*) AS n FROM cells v JOIN d{k} d ON v.vec_id = d.vec_id GROUP BY ALL
  ) s ON o.c = s.c AND o.place = s.place)"""]
    last = params.rounds
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({params.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS y FROM embeddings
  WHERE len(embedding) = {params.length} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (
  SELECT vec_id, i AS place, y[i] AS x FROM (SELECT vec_id, y, unnest(range(1, {params.length} + 1)) AS i FROM kept)
), c0 AS MATERIALIZED (
  SELECT f.c, v.place, v.x FROM cells v JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('{params.salt}' || vec_id)) - 1 AS c FROM kept ORDER BY c LIMIT {n}
  ) f ON v.vec_id = f.vec_id
), {", ".join(steps)}, {near(last)}, found AS MATERIALIZED (
  SELECT vec_id, CAST(best % {n} AS INTEGER) AS cluster, best // {n} AS distance FROM d{last}
), digests AS (
  SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256 FROM c{last} GROUP BY c
)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM found JOIN digests ON cluster = c
"""
