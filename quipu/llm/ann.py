"""Approximate nearest neighbours by multiprobe p-stable hashing.

Index.  A table projects unit vectors on orthonormal random directions
(Gaussian, so 2-stable), shifts by a random offset and cuts into cells of one
width: h(x) = floor((a.x + b) / width) per direction.  Every row is indexed in
every table.

Probes.  A neighbour at cosine c has the projection c*(a.q) plus a normal
deviation of sqrt((1-c^2)/dim); the estimated success of a cell is the product
over the directions of the mass that falls into it, averaged over the design
cosines.  A query visits its own cell and perturbed ones in the order of this
estimate, down to a level.

Fit.  On a bounded sample of the queries, whose true neighbours a scan finds,
the layout is chosen: the number of directions and the width, and for each the
level that lets the tables together reach ``recall`` of the true neighbours; of
all layouts the one with the least work for a query, in rows compared and cells
visited as seen on a bounded sample of rows.  So finer cells are taken as rows
grow and neighbours draw near, and coarse ones where the vectors have no
structure.  The rule is the same at every size.

Rerank.  Candidates of all tables are scored by the exact cosine of the
original vectors in double precision, merged, and the k best kept; ties go to
the smaller id.  A query that finds fewer than k is held against all rows, in
blocks.

Scale.  Equal vectors are one class, known by its k+1 smallest ids, since no
other of its ids can be among the k nearest of anything; the cut is made
map-side first, so thousands of copies are one row.  Probes move as cell
numbers; only those that meet a cell with rows get their query's vector.  Cells
are parted into blocks of ``block`` rows, dealt by a hash, so a hot cell spreads
over many tasks; a task keeps no more than the k best of each query.

Defined results
    vectors that are null, empty, zero, of another length than most, or with a
    null or non-finite component take no part, as queries or candidates; rows
    with a null id take none either.  Repeated rows (same id and vector) are
    one.  Fewer than k candidates: all of them.  Extra columns, whatever their
    names, are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialize, prepare

FOUND = "query long, cid long, first long, score double"
RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass(frozen=True)
class Params:
    tables: int = 2
    k: int = 5
    #: Share of the sample's true neighbours that the probes have to reach.
    recall: float = 0.96
    #: Bounds of the samples that the fit looks at.
    sample_queries: int = 256
    sample_rows: int = 4096
    #: Layouts tried: directions, and widths in standard deviations of a projection.
    projections: tuple[int, ...] = (1, 2, 3, 4, 6, 8, 10, 12)
    widths: tuple[float, ...] = (0.8, 1.6, 3.2)
    #: Cells that a query may visit in a layout; others are left out.
    most_probes: int = 20_000
    #: Work of a visited cell or block, in rows compared.
    probe_cost: float = 30.0
    block: int = 4096
    seed: int = 20240607


class Tables:
    """Hash functions of one layout, and the order in which a query visits cells."""

    def __init__(self, dim: int, m: int, width: float, cosines, params: Params):
        rng = np.random.default_rng(params.seed)
        self.dim, self.m, self.width, self.cosines = dim, m, width, tuple(cosines)
        self.directions = [np.linalg.qr(rng.normal(size=(dim, m)))[0] for _ in range(params.tables)]
        self.offsets = [rng.uniform(0, width, m) for _ in range(params.tables)]
        #: Cells per direction: a projection of a unit vector lies in [-1, 1].
        self.span = math.ceil(2 / width) + 2
        self.level = -math.inf

    def digits(self, table: int, unit: np.ndarray) -> np.ndarray:
        at = np.floor((unit @ self.directions[table] + self.offsets[table] + 1.0) / self.width).astype(np.int64)
        return np.clip(at, 0, self.span - 1)

    def number(self, digits: np.ndarray) -> np.ndarray:
        """One 64-bit number for the digits of a cell, mixed where they don't fit side by side."""
        out = np.zeros(len(digits), np.uint64)
        for d in range(self.m):
            out = (out * np.uint64(0x9E3779B97F4A7C15) if self.m * math.log2(self.span) > 62 else out * np.uint64(self.span)) + digits[:, d].astype(np.uint64)
        return out.view(np.int64)

    def successes(self, table: int, unit: np.ndarray) -> np.ndarray:
        """(query, direction, digit): logarithm of the mass expected there."""
        centre = unit @ self.directions[table]
        edges = np.arange(self.span + 1) * self.width
        edges[0], edges[-1] = -9.0, self.span * self.width + 9.0  # the end cells hold all beyond
        mass = 0.0
        for c in self.cosines:
            spread = math.sqrt(max(1 - c * c, 1e-6) / self.dim)
            bounds = (edges[None, None, :] - self.offsets[table][None, :, None] - 1.0 - c * centre[:, :, None]) / spread
            mass = mass + np.diff(normal_cdf(bounds), axis=2)
        return np.log(np.maximum(mass / len(self.cosines), 1e-12))

    def score(self, successes: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """(query, row): estimated success of the rows' cells."""
        return sum(successes[:, d, :][:, digits[:, d]] for d in range(self.m))

    def visits(self, successes: np.ndarray, own: np.ndarray, most: int | None = None) -> np.ndarray | None:
        """Digits of the cells of one query (direction, digit) from the likeliest to the level, its own first; None if over ``most``."""
        best = successes.max(axis=1)
        rest = np.concatenate([np.cumsum(best[::-1])[::-1][1:], [0.0]])
        digits, scores = np.zeros((1, 0), np.int64), np.zeros(1)
        for d in range(self.m):
            new = scores[:, None] + successes[d][None, :]
            at, digit = np.nonzero(new + rest[d] >= self.level)
            if most is not None and len(at) > most:
                return None
            digits, scores = np.column_stack([digits[at], digit]), new[at, digit]
        order = np.argsort(-scores, kind="stable")
        found = digits[order]
        return np.concatenate([own[None, :], found[(found != own).any(axis=1)]])


def normal_cdf(x: np.ndarray) -> np.ndarray:
    """Normal distribution function, to about 1e-7; it only orders probes."""
    x = np.clip(x, -30, 30)
    t = 1 / (1 + 0.2316419 * np.abs(x))
    tail = np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(x >= 0, 1 - tail, tail)


def fit_tables(queries: np.ndarray, pairs: list[tuple[int, np.ndarray]], rows: np.ndarray, n: int, params: Params) -> Tables:
    """The layout with the least work; ``pairs`` are sampled queries (places in ``queries``) with the vectors of their true neighbours."""
    dim = queries.shape[1]
    unit, sample = units(queries), units(rows)
    if not pairs:
        return Tables(dim, 1, 2.0, (0.5,), params)
    who = np.concatenate([np.full(len(v), q) for q, v in pairs])
    near = units(np.concatenate([v for _, v in pairs]))
    cosines = np.clip(np.quantile((unit[who] * near).sum(axis=1), (0.05, 0.25, 0.5, 0.75, 0.95)), -0.99, 0.99999)
    deviation = max(float(np.std(sample @ np.linalg.qr(np.random.default_rng(params.seed).normal(size=(dim, min(4, dim))))[0])), 1e-3)
    best, least = None, math.inf
    for m in params.projections:
        for width in params.widths:
            if m > dim:
                continue
            tables = Tables(dim, m, min(2.0, width * deviation), cosines, params)
            successes = [tables.successes(t, unit) for t in range(params.tables)]
            reached = np.full(len(who), -math.inf)
            for t, s in enumerate(successes):
                digits, own = tables.digits(t, near), tables.digits(t, unit)[who]
                score = sum(s[who, d, digits[:, d]] for d in range(m))
                reached = np.maximum(reached, np.where((digits == own).all(axis=1), math.inf, score))
            tables.level = float(np.quantile(reached, 1 - params.recall, method="lower")) - 1e-9
            share = 0.0
            for t, s in enumerate(successes):
                cells = tables.digits(t, sample)
                same = (tables.digits(t, unit)[:, None, :] == cells[None, :, :]).all(axis=2)
                share += float(((tables.score(s, cells) >= tables.level) | same).mean()) / params.tables
            compared = share * n * params.tables
            if compared >= least:
                continue
            own = tables.digits(0, unit)
            seen = [tables.visits(successes[0][q], own[q], params.most_probes) for q in range(min(len(unit), 16))]
            if any(v is None for v in seen):
                continue
            # A block is visited for every ``block`` rows compared at least.
            work = compared + params.probe_cost * (params.tables * np.mean([len(v) for v in seen]) + compared / params.block)
            if work < least:
                best, least = tables, work
    return best or Tables(dim, 1, 2.0, cosines, params)


def valid_vectors(rows: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, v) of the rows that take part, v as doubles."""
    v = F.col(f"`{vector}`").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        rows.select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v"))
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
        .filter(fine & F.exists("v", lambda x: x != 0.0))
    )


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows of ``a`` with the same rows of ``b``, each summed in the same order."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def best_of_block(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, first: np.ndarray, v: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest classes of a block for each query, its own left out, by exact cosine, then least id."""
    out = []
    u = units(v).T
    for lo in range(0, len(qid), 512):
        a, b = qid[lo : lo + 512], q[lo : lo + 512]
        rough = units(b) @ u
        rough[a[:, None] == vid[None, :]] = -np.inf
        floor = np.partition(rough, len(vid) - k, axis=1)[:, len(vid) - k] if len(vid) > k else np.full(len(a), -2.0)
        r, c = np.nonzero(rough >= np.maximum(floor, -2.0)[:, None] - 1e-9)
        out.append(pd.DataFrame({"query": a[r], "cid": vid[c], "first": first[c], "score": cosine(b[r], v[c])}))
    return merged(out, k)


def merged(found: list[pd.DataFrame], k: int) -> pd.DataFrame:
    """k best per query of several blocks' results; a pair found twice counts once."""
    out = pd.concat(found).drop_duplicates(["query", "cid"]).sort_values(["query", "score", "first"], ascending=[True, False, True])
    return out[out.groupby("query").cumcount() < k]


def _search_blocks(k: int, held: int = 200_000):
    """Map over rows sorted by (t, cell, block, kind): rows of a block first, then the probes of it."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[pd.DataFrame] = []
        count = 0
        key, vid, first, v = None, None, None, None

        for pdf in batches:
            if not len(pdf):
                continue
            keys = pdf[["t", "cell", "block"]].to_numpy()
            kinds, ids, firsts = pdf["kind"].to_numpy(), pdf["id"].to_numpy(), pdf["first"].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1) | (kinds[1:] != kinds[:-1])])
            for a, b in zip(starts, [*starts[1:], len(keys)]):
                now, vectors = tuple(keys[a]), np.stack(pdf["v"].to_numpy()[a:b])
                if kinds[a] == 0:
                    if now == key:
                        vid, first, v = np.concatenate([vid, ids[a:b]]), np.concatenate([first, firsts[a:b]]), np.concatenate([v, vectors])
                    else:
                        key, vid, first, v = now, ids[a:b], firsts[a:b], vectors
                elif now == key:
                    found.append(best_of_block(ids[a:b], vectors, vid, first, v, k))
                    count += len(found[-1])
            if count > held:
                found = [merged(found, k)]
                count = len(found[0])
                if count > held // 2:
                    yield found[0]
                    found, count = [], 0
        if found:
            yield merged(found, k)

    return search


FILED = "t int, cell long, block long, kind int, id long, first long, v array<double>"


def _met(filed: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """Rows of ``FOUND``: what the probes find in the blocks that they visit."""
    key = ["t", "cell", "block"]
    return filed.unionByName(probes).repartition(*key).sortWithinPartitions(*key, "kind", "id").mapInPandas(_search_blocks(k), FOUND)


def _sampled(classes: DataFrame, asked: DataFrame, n: int, params: Params) -> tuple[np.ndarray, list, np.ndarray]:
    """Vectors of sampled queries, their true neighbours by a scan, and vectors of sampled rows."""
    vectors = lambda rows: np.stack([np.array(r["v"]) for r in rows])
    some = asked.orderBy("c1", "cid").limit(params.sample_queries).select("cid", "v").collect()
    ids, q = np.array([r["cid"] for r in some]), vectors(some)
    sent, k = classes.sparkSession.sparkContext.broadcast((ids, q)), params.k

    def scan(batches):
        qid, vs = sent.value
        found = []
        for pdf in batches:
            if len(pdf):
                found = [merged([*found, best_of_block(qid, vs, pdf["cid"].to_numpy(), pdf["first"].to_numpy(), np.stack(pdf["v"].to_numpy()), k)], k)]
        yield from found

    order = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    near = classes.select("cid", "first", "v").mapInPandas(scan, FOUND).withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)
    pairs = near.select("query", "cid").toPandas()  # at most k for each sampled query
    wanted = F.broadcast(classes.sparkSession.createDataFrame([(int(c),) for c in set(pairs["cid"])], "near long"))
    of = {r["cid"]: np.array(r["v"]) for r in classes.join(wanted, F.col("cid") == F.col("near")).select("cid", "v").collect()}
    place = {c: i for i, c in enumerate(ids.tolist())}
    true = [(place[c], np.stack([of[x] for x in mine["cid"]])) for c, mine in pairs.groupby("query")]
    step = max(1, n // params.sample_rows)
    rows = classes.filter(F.pmod("c2", F.lit(step)) == 0).select("v").limit(2 * params.sample_rows).collect()
    return q, true, vectors(rows or some)


def nearest(rows: DataFrame, is_query, params: Params = Params(), vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id, score: for each row with ``is_query`` (a condition on vec_id) its k nearest other rows found.

    A cosine needs vectors of one length, so each length that a query has is a
    search of its own, with a layout of its own; a table has few lengths.
    """
    spark = rows.sparkSession
    prepare(spark)
    every = valid_vectors(rows, vector, key).withColumn("dim", F.size("v"))
    asked = sorted(r["dim"] for r in every.filter(is_query(F.col("vec_id"))).select("dim").distinct().collect())
    found = [_nearest_of(every.filter(F.col("dim") == dim).drop("dim"), is_query, params) for dim in asked]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], RESULT)


def _nearest_of(every: DataFrame, is_query, params: Params) -> DataFrame:
    """:func:`nearest` for vectors of one length."""
    spark, k = every.sparkSession, params.k
    every = every.withColumns({"c1": F.xxhash64("v"), "c2": F.xxhash64(F.lit(1), "v")})
    # Repeated rows are one before ids are ranked, and ids move without their vectors.
    least = F.row_number().over(Window.partitionBy("c1", "c2").orderBy("vec_id"))
    kept = every.select("c1", "c2", "vec_id").distinct().withColumn("r", least).filter(F.col("r") <= k + 1)
    ids = kept.groupBy("c1", "c2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    grouped = ids.join(every.groupBy("c1", "c2").agg(F.first("v").alias("v")), ["c1", "c2"])
    classes = materialize(grouped.select(F.monotonically_increasing_id().alias("cid"), "c1", "c2", "ids", F.col("ids")[0].alias("first"), "v"), "classes")
    named = every.filter(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "c1", "c2").distinct()
    named = materialize(named.join(classes.select("c1", "c2", "cid"), ["c1", "c2"]).select("query_id", "cid"), "query_ids")
    asked = materialize(classes.join(named.select("cid").distinct(), "cid", "left_semi"), "asked")
    n = classes.count()
    tables = spark.sparkContext.broadcast(fit_tables(*_sampled(classes, asked, n, params), n, params))

    def hashed(batches):
        for pdf in batches:
            if len(pdf):
                unit = units(np.stack(pdf["v"].to_numpy()))
                for t in range(params.tables):
                    cells = tables.value.number(tables.value.digits(t, unit))
                    yield pd.DataFrame({"t": t, "cell": cells, "id": pdf["cid"], "first": pdf["first"], "v": pdf["v"]})

    def probing(batches):
        held = tables.value
        for pdf in batches:
            for lo in range(0, len(pdf), 256):
                part = pdf.iloc[lo : lo + 256]
                unit, ids = units(np.stack(part["v"].to_numpy())), part["cid"].to_numpy()
                for t in range(params.tables):
                    successes, own = held.successes(t, unit), held.digits(t, unit)
                    for q in range(len(part)):
                        cells = np.unique(held.number(held.visits(successes[q], own[q])))
                        yield pd.DataFrame({"t": t, "cell": cells, "query": ids[q]})

    def own_scores(batches):
        for pdf in batches:
            if len(pdf):
                v = np.stack(pdf["v"].to_numpy())
                yield pd.DataFrame({"query": pdf["cid"], "cid": pdf["cid"], "first": pdf["first"], "score": cosine(v, v)})

    vectors = classes.select("cid", "first", "v")
    filed = vectors.mapInPandas(hashed, "t int, cell long, id long, first long, v array<double>")
    blocks = F.ceil(F.col("n") / params.block).cast("long").alias("blocks")
    sizes = materialize(filed.groupBy("t", "cell").agg(F.count("*").alias("n")).select("t", "cell", blocks), "cells")
    crowded = sizes.filter("blocks > 1")
    block = F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1)))
    placed = filed.join(crowded, ["t", "cell"], "left").select("t", "cell", block.alias("block"), F.lit(0).alias("kind"), "id", "first", "v")
    probes = asked.select("cid", "v").mapInPandas(probing, "t int, cell long, query long").join(sizes, ["t", "cell"])
    probes = probes.select("t", "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "query")
    told = asked.select(F.col("cid").alias("query"), "first", "v")
    met = probes.join(told, "query").select("t", "cell", "block", F.lit(1).alias("kind"), F.col("query").alias("id"), "first", "v")
    known = classes.select("cid", "ids")
    best = lambda found: found.groupBy("query", "cid", "first").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "first"))).filter(F.col("r") <= k).drop("r")
    others = materialize(best(_met(placed, met, k)), "others")

    # Queries that found too few are held against all rows, in blocks.
    enough = others.join(known, "cid").groupBy("query").agg(F.sum(F.size("ids")).alias("held"))
    short = asked.join(enough, F.col("cid") == F.col("query"), "left").filter(F.coalesce("held", F.lit(0)) + F.size("ids") < k + 1).select("cid", "first", "v")
    short = materialize(short, "short")
    if not short.isEmpty():
        parts = max(1, -(-n // params.block))
        one = lambda kind, number: [F.lit(0).alias("t"), F.lit(0).cast("long").alias("cell"), number.cast("long").alias("block"), F.lit(kind).alias("kind"), F.col("cid").alias("id"), "first", "v"]
        whole = vectors.select(*one(0, F.pmod(F.xxhash64("cid"), F.lit(parts))))
        asking = short.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(*one(1, F.col("b")))
        others = best(others.unionByName(_met(whole, asking, k)))

    found = others.unionByName(asked.select("cid", "first", "v").mapInPandas(own_scores, FOUND)).join(known, "cid").select("query", F.explode("ids").alias("vec_id"), "score")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    first = found.groupBy("query", "vec_id").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
    lists = first.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("best"))
    answered = named.join(lists, F.col("cid") == F.col("query")).select("query_id", F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("best"))
    return answered.select("query_id", F.posexplode("best")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "col.vec_id", "col.score")
