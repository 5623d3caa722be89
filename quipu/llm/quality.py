"""Quality rules: compression bands.

A document's bytes are compressed with zstandard, once as a whole and once per
fixed chunk.  The ratio raw/compressed must stay inside a band whose limits
depend on the length, since a longer text gives the compressor more history:
above the band the text is repetitive, below it the text is incompressible
(encoded blobs, random symbols).

The limits follow texts that are labelled good.  Over the logarithm of the
length their ratios have a centre and a spread, both piecewise linear between
powers of two.  The upper limit is the centre plus ``above`` times the spread,
since repetitive texts lie just above prose; the lower one is a share of the
centre, since blobs lie far below prose of any style.  The fit uses all labelled
rows outside the held-out fold: tasks hand on sums, so the driver holds about a
hundred numbers a task.

Texts over one chunk end with a chunk of full size, which overlaps the one
before, so every byte lies in a chunk that is judged.  What the rest after the
last whole chunk adds is judged by itself too, since the full-size chunk may be
half prose: its ratio is taken with the chunk before as history, so that no
frame and no cold start blur it.  Gap: a rest under ``tail_least`` bytes is
judged within the full-size chunk only, and so is junk inside a chunk that is
prose for the rest.

Defined results
    null or empty text: no words, all counts 0, ``base_failed`` true, not kept.
    A very long text is judged whole; a worker holds its words and a few
    numbers for each.  Repeated rows are judged one by one; extra columns,
    whatever their names, are ignored by :func:`score_quality` and passed
    through by :func:`keep_good`.  An empty table gives no rows; without enough
    labels the limits are the prior ones.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import Scratch, cache_of, fresh, held_out, labelled, prepare

SYMBOLS = "#*$%&|<>"
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "ratio double, chunk_low double, chunk_high double, kept boolean"
)


@dataclass(frozen=True)
class Bands:
    """Limits of raw/compressed bytes.

    ``centre`` and ``spread`` (a share of the centre) lie at the lengths 2 **
    ``first``, 2 ** (``first`` + 1) ...; shorter and longer texts take the
    values at the ends.  The values given here are prior ones, fitted on good
    prose in four languages.
    """

    first: int = 8
    centre: tuple[float, ...] = (1.51, 1.61, 1.87, 2.03, 2.16, 2.26, 2.35, 2.45, 2.55)
    spread: tuple[float, ...] = (0.08, 0.07, 0.04, 0.025, 0.018, 0.018, 0.018, 0.018, 0.018)
    above: float = 3.0
    #: The lower limit, as a share of the centre, and its highest value: base64 reaches 1.34, at any length, prose of random letters 0.72 of the centre.
    below: float = 0.70
    most_low: float = 1.45
    chunk: int = 4096
    chunk_low: float = 1.45
    chunk_high: float = 2.30
    level: int = 3
    #: Bytes of a rest over the bytes it adds to its preceding chunk: prose reaches 1.48 at least, base64 1.20 at most.
    tail_low: float = 1.30
    #: How far above the centre a rest by itself may lie, as a share.
    tail_high: float = 1.30
    #: Below this, prose and blobs aren't apart.
    tail_least: int = 64

    def at(self, size: int) -> tuple[float, float]:
        """Centre and spread at a length."""
        x = min(max(math.log2(max(size, 1)) - self.first, 0.0), len(self.centre) - 1.0)
        k = min(int(x), len(self.centre) - 2)
        between = lambda v: v[k] + (v[k + 1] - v[k]) * (x - k)
        return between(self.centre), between(self.spread)

    def of(self, size: int) -> tuple[float, float]:
        """Lower and upper limit at a length."""
        centre, spread = self.at(size)
        return min(self.below * centre, self.most_low), centre * (1 + self.above * spread)


@dataclass(frozen=True)
class FitParams:
    #: 1 - this share of the labelled rows is set aside: crc32 of the key modulo ``folds`` is 0.
    folds: int = 5
    #: Good texts that are needed to leave the prior, and what the prior weighs at each length, in texts.
    least_good: int = 100
    ridge: float = 8.0


def repeated_words(words: list) -> int:
    """Words in 3-word windows that are found twice or more."""
    if len(words) < 4:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1 << 20:  # else three numbers fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    if len(times) == len(windows):
        return 0
    twice, inside = times[which] > 1, np.zeros(len(words), bool)
    for k in range(3):
        inside[k : k + len(windows)] |= twice
    return int(inside.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """Words, their code points, symbols, repeated lines, words of repeated windows, and whether the base rules fail."""
    if not text:
        return 0, 0, 0, 0, 0, True
    words = text.encode("utf-8", "surrogatepass").split()  # bytes.split parts at ASCII white space only
    n = len(words)
    blanks = sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = Counter(text.split("\n"))
    dup = sum(c - 1 for line, c in lines.items() if c > 1 and line.strip(" \t\v\f\r"))
    repeat = repeated_words(words)
    return n, len(text) - blanks, symbols, dup, repeat, n < 50 or 100 * repeat > 50 * n


def ratios(raw: bytes, bands: Bands, squeeze) -> tuple[float, float, float]:
    """Ratio of the whole, and the lowest and highest ratio of its fixed chunks and of its last ``chunk`` bytes."""
    whole = len(raw) / len(squeeze(raw)) if raw else 0.0
    if len(raw) <= bands.chunk:
        return whole, whole, whole
    starts = [*range(0, len(raw) - bands.chunk, bands.chunk), len(raw) - bands.chunk]
    each = [bands.chunk / len(squeeze(raw[i : i + bands.chunk])) for i in starts]
    return whole, min(each), max(each)


def tail_passes(raw: bytes, bands: Bands, squeeze) -> bool:
    """Whether what follows the last whole chunk is neither incompressible nor repetitive."""
    size = len(raw) % bands.chunk
    if len(raw) <= bands.chunk or size < bands.tail_least:
        return True
    before, tail = raw[-size - bands.chunk : -size], raw[-size:]
    added = len(squeeze(before + tail)) - len(squeeze(before))
    return size >= bands.tail_low * added and size <= bands.tail_high * bands.at(size)[0] * len(squeeze(tail))


def judge(text: str | None, bands: Bands, squeeze) -> tuple:
    counts = base_counts(text)
    raw = (text or "").encode("utf-8", "surrogatepass")
    whole, least, most = ratios(raw, bands, squeeze)
    low, high = bands.of(len(raw))
    good = low <= whole <= high and (len(raw) <= bands.chunk or (least >= bands.chunk_low and most <= bands.chunk_high and tail_passes(raw, bands, squeeze)))
    return (*counts, whole, least, most, good and not counts[-1])


def fit(docs: DataFrame, labels: DataFrame, params: FitParams = FitParams(), bands: Bands = Bands()) -> Bands:
    """Bands that follow all good ones of the labelled rows of ``docs``; numbers are moved for the join with labels, never texts."""
    spark = docs.sparkSession
    prepare(spark)
    good = labelled(labels, F.min("quality"), params.folds).filter("value > 0").select("labelled_id")
    own = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), params.folds))
    seen = own.select("doc_id", F.octet_length("text").alias("size"), quality_columns(F.col("text"), bands).alias("q")).filter("not q.base_failed")
    # One row for each labelled key, however often docs hold it.
    least = F.min(F.struct(F.col("size").cast("double"), "q.ratio", "q.chunk_low", "q.chunk_high")).alias("x")
    found = seen.join(good, F.col("doc_id") == F.col("labelled_id")).groupBy("labelled_id").agg(least)
    with Scratch(spark) as scratch:
        rows = scratch.put(found.select("x.*").toDF("size", "ratio", "low", "high"), "labelled")

        def sums(part):
            def each(batches):
                out = [part(*(pdf[c].to_numpy(float) for c in ("size", "ratio", "low", "high"))) for pdf in batches]
                if out:
                    yield pd.DataFrame({"sums": [np.sum(out, axis=0).tolist()]})

            return np.sum([r["sums"] for r in rows.mapInPandas(each, "sums array<double>").collect()] or [part(*np.zeros((4, 0)))], axis=0)

        return fitted_by(sums, params, bands)


def fitted(size: np.ndarray, ratio: np.ndarray, lows: np.ndarray, highs: np.ndarray, params: FitParams, bands: Bands) -> Bands:
    """:func:`fitted_by` over arrays."""
    return fitted_by(lambda part: part(size, ratio, lows, highs), params, bands)


def fitted_by(sums, params: FitParams, bands: Bands) -> Bands:
    """Centre and spread by least squares over hat functions, held near ``bands``; texts far from the first centre count for the spread no more.

    ``sums(part)`` gives the sum of the arrays ``part(size, ratio, lows, highs)`` over blocks of all rows.
    """
    if sums(lambda size, *_: np.array([len(size)], float))[0] < params.least_good:
        return bands
    knots = len(bands.centre)

    def hats_of(size):
        x = np.clip(np.log2(np.maximum(size, 1)) - bands.first, 0, knots - 1)
        return np.maximum(0, 1 - np.abs(x[:, None] - np.arange(knots)))

    def held(values, prior, limits):
        def part(size, ratio, *_):
            hats = hats_of(size)
            used = used_of(hats, ratio, limits)
            h = hats[used]
            return np.concatenate([(h.T @ h).ravel(), h.T @ values(hats, ratio)[used]])

        found = sums(part)
        solved = np.linalg.solve(found[: knots * knots].reshape(knots, knots) + params.ridge * np.eye(knots), found[knots * knots :] + params.ridge * np.array(prior))
        return np.round(solved, 12)  # the order of rows changes last bits, not verdicts

    def used_of(hats, ratio, limits):
        return np.ones(len(ratio), bool) if limits is None else np.abs(ratio / (hats @ limits[0]) - 1) <= 5 * (hats @ limits[1])

    limits = None
    for _ in range(3):
        centre = held(lambda hats, ratio: ratio, bands.centre, limits)
        spread = np.sqrt(np.maximum(held(lambda hats, ratio, centre=centre: (ratio / (hats @ centre) - 1) ** 2, np.square(bands.spread), limits), 1e-6))
        limits = centre, spread

    def of_chunks(size, ratio, low, high):
        long = used_of(hats_of(size), ratio, limits) & (size > bands.chunk)
        return np.array([long.sum(), low[long].sum(), high[long].sum(), ((high[long] - bands.chunk_high) ** 2).sum()], float)

    out = replace(bands, centre=tuple(map(float, centre)), spread=tuple(map(float, spread)))
    n, low, high, squares = sums(of_chunks)
    if n < params.least_good:
        return out
    low, high = round(low / n, 12), round(high / n, 12)
    apart = max(round(math.sqrt(max(squares / n - (high - bands.chunk_high) ** 2, 0.0)), 9), 0.01 * high)
    return replace(out, chunk_low=min(bands.below * low, bands.most_low), chunk_high=high + bands.above * apart)


def quality_columns(text: Column, bands: Bands = Bands()) -> Column:
    """A struct column of ``SCHEMA`` for a text column."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    @F.pandas_udf(SCHEMA)
    def quality_of(texts: pd.Series) -> pd.DataFrame:
        cache_of("none")
        squeeze = zstandard.ZstdCompressor(level=bands.level).compress
        return pd.DataFrame([judge(t, bands, squeeze) for t in texts], columns=names)

    return quality_of(text)


def score_quality(docs: DataFrame, bands: Bands = Bands(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts, ratios and verdict per row of ``docs``; a map without any shuffle."""
    prepare(docs.sparkSession)
    return docs.select(F.col(f"`{key}`").alias("doc_id"), quality_columns(F.col(f"`{text}`"), bands).alias("q")).select("doc_id", "q.*")


def keep_good(docs: DataFrame, bands: Bands = Bands(), text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns they came with."""
    prepare(docs.sparkSession)
    own = fresh(docs, "quality_verdict")
    return docs.withColumn(own, quality_columns(F.col(f"`{text}`"), bands)["kept"]).filter(F.col(own)).select(*[F.col(f"`{c}`") for c in docs.columns])
