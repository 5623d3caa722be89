"""Vector code compression: a codebook per part of the vectors, learned on distinct parts.

Vectors become whole numbers, floor(scale * x), and are cut into equal parts.
Equal parts at one position are one row with a weight, counted map-side; Lloyd's
rounds run over these distinct rows, each weighted, so a vector that occurs a
million times is a single row of every round.  Codes and errors of the distinct
parts are joined back to the vectors at the end.

A codebook starts as the parts of the vectors with the smallest ids.  A round
assigns every distinct part to its nearest entry (squared Euclidean distance,
ties to the lower number) and replaces each entry by the floor of its parts'
mean; unused entries stay.  All of it is exact: see :mod:`.exact`.

Scale.  Distinct parts are written to the shared folder once; a round reads
them in one map and adds up sums, of which the driver gets one number per
entry, component and digit.  The codebooks are that small too; each task has
them in its closure.  A part that a third of all vectors share is one
row before the join, and the join's hot key is on the side that AQE splits.

Defined results
    Vectors that are null or hold a null or non-finite component are left out.
    Vectors of different lengths are compressed apart, each length with
    codebooks of its own (a table has few lengths).  A length that the parts don't divide
    can't be cut: code, error and codebooks_sha256 are null, and the error
    counts as nothing for label_error.  Fewer vectors than entries: fewer
    entries.  Ties in vec_id are ordered by the vector; rows without one come last, and keep
    a null id.  Repeated rows are coded one by one.  An error or sum beyond 64
    bits is null.  Empty vectors have code zeros and error 0.
    Extra columns, whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Scratch, materialize, prepare
from .exact import DIGITS, Points, Sums, collected, kept_vectors, long_or_none, means

#: dim -> for each part its entries.
Codebooks = dict[int, list[list[list[int]]]]


@dataclass(frozen=True)
class Params:
    scale: int = 4096
    parts: int = 8
    entries: int = 16
    rounds: int = 6


def distinct_parts(vectors: DataFrame, parts: int) -> DataFrame:
    """(dim, part, p, weight): the distinct parts at each position of ``vectors(dim, y)``."""
    return _cut(vectors.select("dim", "y"), parts, "dim").groupBy("dim", "part", "p").agg(F.count("*").alias("weight"))


def _cut(vectors: DataFrame, parts: int, *kept: str) -> DataFrame:
    width = F.expr(f"size(y) div {parts}").cast("int")
    pieces = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: F.slice("y", k.cast("int") * width + 1, width))
    return vectors.select(*kept, F.posexplode(pieces).alias("part", "p"))


def first_codebooks(vectors: DataFrame, params: Params) -> Codebooks:
    """The parts of the vectors with the smallest ids, for each length; the driver gets ``entries`` rows a length."""
    out = {}
    for dim in sorted(r["dim"] for r in vectors.select("dim").distinct().collect()):
        first = vectors.filter(F.col("dim") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "y").limit(params.entries).select("y").collect()
        rows, width = [[int(x) for x in r["y"]] for r in first], dim // params.parts
        out[dim] = [[y[k * width : (k + 1) * width] for y in rows] for k in range(params.parts)]
    return out


def _nearest(batch: pd.DataFrame, points: dict[tuple[int, int], Points]) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each (dim, part) of a batch: its rows, their parts, nearest entries and distances."""
    for key, rows in batch.groupby(["dim", "part"], sort=False).indices.items():
        y = np.stack(batch["p"].to_numpy()[rows]).astype(np.float64)
        d = points[key].distances(y)
        entry = np.argmin(d, axis=1)  # the first of equals
        yield key, rows, y, entry, d[np.arange(len(d)), entry]


def _points(books: Codebooks) -> dict[tuple[int, int], Points]:
    return {(dim, k): Points(book) for dim, held in books.items() for k, book in enumerate(held)}


def lloyd_round(distinct: DataFrame, books: Codebooks) -> Codebooks:
    """One weighted round: entries become the floored means of their parts."""

    def add(batches):
        points, sums = _points(books), {}
        for pdf in batches:
            for (dim, part), rows, y, entry, _ in _nearest(pdf, points):
                sums.setdefault(dim, Sums()).add(part, entry, y, pdf["weight"].to_numpy()[rows])
        found = [(dim, *row) for dim, s in sums.items() for row in s.digits()]
        if found:
            yield pd.DataFrame(found, columns=["dim", *[c.split()[0] for c in DIGITS.split(", ")]])

    sums = collected(distinct.select("dim", "part", "p", "weight").mapInPandas(add, "dim int, " + DIGITS), ("dim", "part", "entry"))
    return {
        dim: [[means(sums[dim, k, e], len(old)) if (dim, k, e) in sums else old for e, old in enumerate(book)] for k, book in enumerate(held)]
        for dim, held in books.items()
    }


def coded_parts(distinct: DataFrame, books: Codebooks) -> DataFrame:
    """(dim, part, p, entry, error) of the distinct parts."""

    def code(batches):
        points = _points(books)
        for pdf in batches:
            entries, errors = np.zeros(len(pdf), np.int32), [None] * len(pdf)
            for _, rows, _, entry, d in _nearest(pdf, points):
                entries[rows] = entry
                for i, x in zip(rows.tolist(), d.tolist()):
                    errors[i] = long_or_none(x)
            yield pd.DataFrame({"dim": pdf["dim"], "part": pdf["part"], "p": pdf["p"], "entry": entries, "error": pd.Series(errors, dtype="Int64", index=pdf.index)})

    return distinct.select("dim", "part", "p").mapInPandas(code, "dim int, part int, p array<double>, entry int, error long")


def digest(book: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for part in book for entry in part for x in entry).encode()).hexdigest()


def compress(rows: DataFrame, params: Params = Params(), vector: str = "embedding", key: str = "vec_id", label: str = "label") -> tuple[DataFrame, Codebooks]:
    """vec_id, label, code, error, label_error and codebooks_sha256 of the vectors that take part; and the final codebooks of each length."""
    spark = rows.sparkSession
    prepare(spark)
    with Scratch(spark) as scratch:
        kept = kept_vectors(rows, params.scale, vector, key, F.col(f"`{label}`").alias("label"))
        vectors = scratch.put(kept.withColumns({"dim": F.size("y"), "row_id": F.monotonically_increasing_id()}), "vectors")
        fitting = vectors.filter(F.col("dim") % params.parts == 0)
        distinct = scratch.put(distinct_parts(fitting, params.parts), "parts")
        books = first_codebooks(fitting, params)
        for _ in range(params.rounds):
            after = lloyd_round(distinct, books)
            if after == books:
                break  # every further round gives the same
            books = after
        coded = scratch.put(coded_parts(distinct, books), "coded")
        pieces = _cut(fitting, params.parts, "row_id", "vec_id", "label", "dim")
        met = pieces.join(coded, ["dim", "part", "p"]).select("row_id", "vec_id", "label", "dim", "part", "entry", "error")
        hexed = F.transform(F.array_sort(F.collect_list(F.struct("part", "entry"))), lambda x: F.lower(F.lpad(F.hex(x["entry"]), 2, "0")))
        summed = F.when(F.count("error") == params.parts, F.sum(F.col("error").cast("decimal(20,0)")))
        codes = met.groupBy("row_id").agg(
            F.first("vec_id").alias("vec_id"), F.first("label").alias("label"), F.first("dim").alias("dim"), F.array_join(hexed, "").alias("code"), summed.try_cast("long").alias("error")
        ).drop("row_id")
        other = vectors.filter(F.col("dim") % params.parts != 0).select("vec_id", "label", "dim", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        every = scratch.put(codes.unionByName(other), "codes")
        by_label = every.groupBy(F.col("label").alias("label_")).agg(F.coalesce(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(0)).try_cast("long").alias("label_error"))
        sha = F.coalesce(F.lit(None).cast("string"), *[F.when(F.col("dim") == dim, digest(book)) for dim, book in books.items()])
        out = every.join(by_label, F.col("label").eqNullSafe(F.col("label_")), "left")
        return materialize(out.select("vec_id", "label", "code", "error", "label_error", sha.alias("codebooks_sha256")), "compressed"), books


def decode(code: str, book: list[list[list[int]]], scale: int = Params.scale) -> list[float]:
    """The vector that a code stands for: its entries, one after the other, at their cells' lower corners."""
    return [x / scale for k, part in enumerate(book) for x in part[int(code[2 * k : 2 * k + 2], 16)]]


def sql(params: Params = Params()) -> str:
    """DuckDB form of what op12 returns, for vectors of one length; a nearest entry is the least of distance * entries + number."""
    n = params.entries
    near = lambda k: f"""d{k} AS MATERIALIZED (
  SELECT vec_id, part, CAST(min(d * {n} + entry) AS BIGINT) AS best FROM (
    SELECT c.vec_id, c.part, e.entry, sum((c.x - e.x) * (c.x - e.x)) AS d FROM cells c JOIN e{k} e ON c.part = e.part AND c.place = e.place GROUP BY ALL
  ) GROUP BY vec_id, part)"""  # noqa: E731
    steps = []
    for k in range(params.rounds):
        steps += [near(k), f"""e{k + 1} AS MATERIALIZED (
  SELECT o.part, o.entry, o.place, CAST(coalesce((s.total - ((s.total % s.n) + s.n) % s.n) // s.n, o.x) AS BIGINT) AS x
  FROM e{k} o LEFT JOIN (
    SELECT c.part, d.best % {n} AS entry, c.place, sum(c.x) AS total, count(*) AS n FROM cells c JOIN d{k} d ON c.vec_id = d.vec_id AND c.part = d.part GROUP BY ALL
  ) s ON o.part = s.part AND o.entry = s.entry AND o.place = s.place)"""]
    last = params.rounds
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({params.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS y FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (
  SELECT vec_id, (i - 1) // (len(y) // {params.parts}) AS part, (i - 1) % (len(y) // {params.parts}) AS place, y[i] AS x
  FROM (SELECT vec_id, y, unnest(range(1, len(y) + 1)) AS i FROM kept)
), e0 AS MATERIALIZED (
  SELECT c.part, f.entry, c.place, c.x FROM cells c JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {n}) f ON c.vec_id = f.vec_id
), {", ".join(steps)}, {near(last)}, coded AS MATERIALIZED (
  SELECT k.vec_id, any_value(k.label) AS label, string_agg(lpad(lower(to_hex(best % {n})), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best // {n}) AS BIGINT) AS error
  FROM d{last} d JOIN kept k ON d.vec_id = k.vec_id GROUP BY k.vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) FROM e{last}) AS codebooks_sha256
FROM coded
"""
