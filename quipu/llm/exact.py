"""Whole-number vectors and distances that no rounding touches.

Components are floored on the JVM and held as doubles, which hold them exactly
whatever their size.  Distances are taken with the machine's floating-point
products where these are proven exact, and with Python's integers elsewhere;
sums leave a task as digits of base 2**30, which Spark adds up as longs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGIT = 30
DIGITS = "part int, entry int, place int, digit int, value long"
LONGEST = (1 << 63) - 1


def floored(v: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as doubles; ``scale`` is a power of two, so the product is exact."""

    def down(x: Column) -> Column:
        near = F.rint(x * float(scale))
        return F.when(near > x * float(scale), near - 1.0).otherwise(near) + 0.0

    return F.transform(v, down)


def kept_vectors(rows: DataFrame, scale: int, vector: str, key: str, *more: Column) -> DataFrame:
    """(vec_id, ..., y) of the rows whose vector is not null and holds no null and no non-finite number; y are the floored components.

    A double so large that ``scale`` times it is no finite double counts as non-finite.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    fine = F.forall("v_", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * float(scale)) < F.lit(float("inf"))))
    return rows.select(F.col(f"`{key}`").alias("vec_id"), *more, v.alias("v_")).filter(F.col("v_").isNotNull() & fine).withColumn("y", floored(F.col("v_"), scale)).drop("v_")


def whole(y: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers."""
    return np.array([int(x) for x in y.ravel()], dtype=object).reshape(y.shape)


def plain(largest: float, components: int) -> bool:
    """Whether sums of ``components`` squares of differences of numbers up to ``largest`` are exact in doubles, whatever the order."""
    return 4 * max(components, 1) * int(largest) ** 2 < 1 << 53


class Points:
    """Few whole-number points of one length, against which many vectors are held."""

    def __init__(self, points: list[list[int]]):
        self.points = points
        self.largest = max((abs(x) for p in points for x in p), default=0)
        self.small = np.array(points, dtype=np.float64) if self.largest < 1 << 53 else None

    def distances(self, y: np.ndarray, of: Iterable[int] | None = None) -> np.ndarray:
        """(vector, point) squared distances, as int64, or as Python integers where they may not fit."""
        of = list(range(len(self.points)) if of is None else of)
        if self.small is not None and plain(max(self.largest, float(np.abs(y).max(initial=0.0))), y.shape[1]):
            c = self.small[of]
            return ((y * y).sum(axis=1)[:, None] - 2.0 * (y @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)
        ints, out = whole(y), np.zeros((len(y), len(of)), dtype=object)
        for j, p in enumerate(of):
            diff = ints - np.array(self.points[p], dtype=object)[None, :]
            out[:, j] = (diff * diff).sum(axis=1) if y.shape[1] else 0
        return out


class Sums:
    """Counts and component sums per (part, entry), as exact integers."""

    def __init__(self):
        self.held: dict[tuple[int, int], list[int]] = {}

    def add(self, part: int, entries: np.ndarray, y: np.ndarray, weights: np.ndarray) -> None:
        """Add ``weights`` times the rows of ``y`` to their entries."""
        if not len(y):
            return
        largest = int(np.abs(y).max(initial=0.0))
        exact = max(largest, 1) * sum(map(abs, weights.tolist())) < 1 << 62
        values = y.astype(np.int64) if exact else whole(y)
        w = weights.astype(np.int64) if exact else np.array(weights.tolist(), dtype=object)
        for e in np.unique(entries).tolist():
            mine = entries == e
            sums = [int(w[mine].sum()), *map(int, (values[mine] * w[mine][:, None]).sum(axis=0))]
            old = self.held.get((part, e))
            self.held[part, e] = sums if old is None else [a + b for a, b in zip(old, sums)]

    def digits(self) -> Iterator[tuple[int, int, int, int, int]]:
        """Rows of ``DIGITS``; place 0 is the count, the others are components."""
        for (part, entry), sums in self.held.items():
            for place, s in enumerate(sums):
                digit = 0
                while s:
                    low = s & ((1 << DIGIT) - 1)
                    if -(1 << DIGIT) < s < 1 << DIGIT:
                        low = s  # the last digit keeps the sign
                    yield part, entry, place, digit, low
                    s, digit = (s - low) >> DIGIT, digit + 1


def collected(digits: DataFrame, keys: tuple[str, ...] = ("part", "entry")) -> dict[tuple, dict[int, int]]:
    """Sums per key and place; the driver gets as many rows as there are entries, components and digits, whatever the table's size."""
    out: dict[tuple, dict[int, int]] = {}
    for r in digits.groupBy(*keys, "place", "digit").agg(F.sum("value").alias("value")).collect():
        sums = out.setdefault(tuple(r[k] for k in keys), {})
        sums[r["place"]] = sums.get(r["place"], 0) + (r["value"] << (DIGIT * r["digit"]))
    return out


def means(sums: dict[int, int], length: int) -> list[int]:
    return [sums.get(i + 1, 0) // sums[0] for i in range(length)]


def root_up(d: int) -> float:
    """A double not below the square root of ``d``."""
    try:
        return math.nextafter(math.sqrt(math.nextafter(float(d), math.inf)), math.inf) if d else 0.0
    except OverflowError:
        return math.inf


def root_down(d: int) -> float:
    """A double not above the square root of ``d``."""
    try:
        return max(0.0, math.nextafter(math.sqrt(math.nextafter(float(d), 0.0)), 0.0)) if d else 0.0
    except OverflowError:
        return 1.3e154


def long_or_none(d) -> int | None:
    return int(d) if d <= LONGEST else None
