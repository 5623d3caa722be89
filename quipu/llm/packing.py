"""Order-preserving packing by dynamic programming.

Documents are packed in ascending order of key, then of text, within their
partition: which rows a task reads decides what it packs, never the order in
which they reach it, so a task that runs again after an executor is lost gives
the same pieces.  The token stream of a partition is cut into windows of at most ``size`` ids; the cuts lie
at document ends, at sentence ends, or, where neither will do, anywhere.  The
plan minimises

    sum of padding + penalty of each cut + a cost per window

where a window of L ids is padded by ``size - L``, or not at all if L is a
power of two.  With positions p and f(j) the least cost of the stream up to
p_j,

    f(j) = penalty(j) + per_window + min( size - p_j + min{f(i) + p_i : p_i >= p_j - size},
                                          min{f(i) : p_j - p_i a power of two} )

The inner minimum over the sliding range is kept in a monotone queue, so each
position is pushed and popped once.

A partition is planned in stretches of ``stretch`` ids; the last window of a
stretch is reopened in the next one, so memory is bounded and stretches leave
no seams.  There is no shuffle: a task packs what it reads, and the only
padding per task is in its last windows, which are parted into powers of two.  Sequence ids are made of the
partition's number and a counter, as ``monotonically_increasing_id`` does.

Defined results
    null or empty text: the end id alone, one piece of length 1.  A document
    longer than a window, however long, spans several.  Repeated rows are
    packed one by one; rows without a key come first and keep a null key; extra
    columns, whatever their names, are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import key_columns, keys_of, prepare, whole_numbers
from .bpe_cache import encoder

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Costs:
    size: int = 4096
    sentence: float = 4.0
    hard: float = 64.0
    per_window: float = 16.0
    #: Powers of two below this are looked for in the last windows of a partition only: elsewhere they would make tiny windows.
    least_power: int = 64
    stretch: int = 1 << 18


def plan_cuts(at: list[int], penalty: list[float], costs: Costs) -> list[int]:
    """The positions of ``at`` (ascending, first 0) at which to cut, the last included.

    Neighbours in ``at`` are at most ``costs.size`` apart.
    """
    size, extra = costs.size, costs.per_window
    powers = [1 << k for k in range(costs.least_power.bit_length() - 1, size.bit_length() - 1)]
    best, back = [0.0] * len(at), [0] * len(at)
    where = {at[0]: 0}
    queue: deque[int] = deque([0])
    key = [at[0] + 0.0] + [0.0] * (len(at) - 1)
    for j in range(1, len(at)):
        p = at[j]
        while at[queue[0]] < p - size:
            queue.popleft()
        i = queue[0]
        cost = size - p + key[i]
        for power in powers:
            k = where.get(p - power)
            if k is not None and best[k] < cost:
                cost, i = best[k], k
        best[j], back[j] = (total := cost + penalty[j] + extra), i
        key[j] = total = total + p
        while queue and key[queue[-1]] >= total:
            queue.pop()
        queue.append(j)
        where[p] = j
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1]


def candidates(ends: np.ndarray, stops: np.ndarray, total: int, last: bool, costs: Costs) -> tuple[list[int], list[float]]:
    """Positions where a cut may lie and what each costs: document ends, sentence ends, hard cuts in long stretches without either."""
    at = np.unique(np.concatenate([[0], ends, stops, [total]]))
    hard: list[int] = []
    for k in np.flatnonzero(np.diff(at) > costs.size):
        hard += range(int(at[k]) + costs.size // 8, int(at[k + 1]), costs.size // 8)
    if last:  # let the rest of the partition be parted into powers of two
        first, tail = int(at[max(0, np.searchsorted(at, total - 2 * costs.size))]), []
        for base in (first, max(0, total - costs.size), *(int(x) for x in at[np.searchsorted(at, total - costs.size) :][:64])):
            rest, p = total - base, base
            for power in (1 << k for k in range(costs.size.bit_length() - 1, -1, -1)):
                if rest >= power:
                    rest, p = rest - power, p + power
                    tail.append(p)
        hard += [p for p in tail if 0 < p < total]
    if hard:
        at = np.unique(np.concatenate([at, hard]))
    cost = np.full(len(at), costs.hard)
    cost[np.isin(at, stops)] = costs.sentence
    cost[np.isin(at, ends)] = 0.0
    cost[0] = cost[-1] = 0.0
    return at.tolist(), cost.tolist()


class Packer:
    """Packs a stream of (key, ids) pairs; ``add`` and ``close`` give finished pieces."""

    def __init__(self, costs: Costs, is_stop: np.ndarray, first_sequence: int = 0):
        self.costs, self.is_stop, self.sequence = costs, is_stop, first_sequence
        self.docs: deque[tuple[object, np.ndarray, int]] = deque()  # key, ids, how many of them are packed already
        self.held = 0

    def add(self, key, ids: np.ndarray) -> list[tuple]:
        self.docs.append((key, ids, 0))
        self.held += len(ids)
        return self.flush(False) if self.held >= self.costs.stretch else []

    def close(self) -> list[tuple]:
        return self.flush(True) if self.held else []

    def flush(self, last: bool) -> list[tuple]:
        open_ids = [ids[used:] for _, ids, used in self.docs]
        ends = np.cumsum([len(x) for x in open_ids])
        stops = np.flatnonzero(self.is_stop[np.concatenate(open_ids)]) + 1
        costs = replace(self.costs, least_power=1) if last else self.costs
        cuts = plan_cuts(*candidates(ends, stops, int(ends[-1]), last, costs), costs)
        if not last:
            cuts.pop()  # the last window stays open
        out, a = [], 0
        for b in cuts:
            offset = 0
            while a < b:
                key, ids, used = self.docs[0]
                n = min(b - a, len(ids) - used)
                out.append((key, used, n, ids[used : used + n].astype("<u4").tobytes(), len(ids), self.sequence, offset))
                offset, a = offset + n, a + n
                self.held -= n
                if used + n == len(ids):
                    self.docs.popleft()
                else:
                    self.docs[0] = (key, ids, used + n)
            self.sequence += 1
        return out


def sentence_stops(tokenizer) -> np.ndarray:
    """True for ids whose piece ends a sentence."""
    ends = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
    for piece, k in tokenizer.get_vocab(with_added_tokens=True).items():
        ends[k] = piece[:1] in (".", "!", "?")
    return ends


def pack_documents(docs: DataFrame, path: str, end_id: int = 2, costs: Costs = Costs(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces of ``SCHEMA``: which ids of a document (as little-endian unsigned 32-bit integers) lie where in which sequence."""
    prepare(docs.sparkSession)
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def pack(batches):
        enc = encoder(path)
        packer = Packer(costs, sentence_stops(enc.tokenizer), TaskContext.get().partitionId() << 33)
        end = np.array([end_id], enc.dtype)

        def frame(pieces):
            columns = dict(zip(names, zip(*pieces)))
            return pd.DataFrame(columns | {"doc_id": whole_numbers(columns["doc_id"])})

        for pdf in batches:
            pieces = []
            for k, t in zip(keys_of(pdf), pdf["t"]):
                pieces += packer.add(k, np.concatenate([enc.ids(t or ""), end]))
            if pieces:
                yield frame(pieces)
        if pieces := packer.close():
            yield frame(pieces)

    rows = docs.select(*key_columns(key), F.col(f"`{text}`").alias("t"))
    return rows.sortWithinPartitions("keyed", "k", F.xxhash64("t"), "t").mapInPandas(pack, SCHEMA)
