"""Toxicity: a learned lexicon, Levenshtein automata, and context windows.

Lexicon.  Terms and stems are learned from labelled texts: those that mark
toxic texts and hardly occur in others, picked greedily until each toxic text
is covered ``cover`` times over.  The whole marking terms that a picked stem
stands for join the terms: a stem is matched as an exact prefix and sees no
misspelling of its own letters.  The terms form a trie.

Matching.  For a word, the automaton that accepts everything within one edit is
run through the trie; both are walked together, so only the trie's paths that
the automaton can still accept are visited.  Terms of 4 letters or more match
within one edit, shorter ones and stems exactly.  Near misses that clean
labelled texts use are no hits.

Context.  A hit is weighed by a window of words around it: inside quotation
marks or beside words of reporting it counts as quoted; other hits in the
window make it abuse.  A logistic model over these counts gives the score; its
weights are fitted on the labelled rows and held near prior weights, so that a
few labels do not bend it.

The fit uses about ``max_labelled`` labelled rows, a documented bound; the
texts scored are always all rows, whole.

Defined results
    null or empty text: no hit, the score of a text without hits.  A very long
    text is scored whole; a worker holds its words.  An empty table gives no
    rows.  Words under 4 letters are no near hits.  Without any
    toxic label the lexicon is empty and every score is the prior's.  Repeated
    labels of a row count once, toxic if any is.  Repeated rows are scored one
    by one; extra columns, whatever their names, are ignored or, in
    :func:`keep_clean`, kept.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cache_of, fresh, held_out, labelled_sample, materialize, prepare

# Marks and words around a quoted term.
QUOTES = "\"“”„«»‘’'`"
REPORTING = frozenset("said says say word words term called quote quoted writes wrote meaning means dit dijo dice sagte sagt wort mot palabra".split())
TRIM = ".,;:!?()[]{}<>*_~-|" + QUOTES

#: Letters of the shortest term that matches within one edit.
LEAST_NEAR = 4

#: Features of a text and the prior weights: bias, exact hits, near hits, hits beside other hits, quoted hits.
PRIOR = (-2.5, 1.6, 1.0, 0.4, 0.2)


@dataclass(frozen=True)
class FitParams:
    max_labelled: int = 20_000
    #: A term marks a text as toxic with at least these odds against clean texts.
    least_log_odds: float = 2.5
    cover: int = 3
    #: A term of so many toxic texts is always looked at, however many labels there are; with few labels two will do.
    rare: int = 5
    window: int = 8
    stem_lengths: tuple[int, ...] = (4, 5, 6, 7)
    ridge: float = 4.0
    steps: int = 300
    #: 1 - this share of the labelled rows is set aside: crc32 of the key modulo ``folds`` is 0.
    folds: int = 5


@dataclass
class Model:
    terms: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    benign: list[str] = field(default_factory=list)
    weights: tuple[float, ...] = PRIOR
    window: int = 8


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def core(word: str) -> str:
    return word.strip(TRIM)


# --- automaton and trie -------------------------------------------------------------------------------------------


class Trie:
    """Nodes are dicts of letters; the entry '' holds the term that ends there."""

    def __init__(self, terms):
        self.root: dict = {}
        for term in terms:
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term

    def within_one(self, word: str, depth: int | None = None) -> set[str] | bool:
        """Terms within one edit of ``word``.

        The automaton's states are two bit sets: the letters of ``word`` that
        may be used up without, and with, one edit.  With ``depth`` only: can
        any path that long still be accepted?
        """
        masks: dict[str, int] = {}
        for i, letter in enumerate(word):
            masks[letter] = masks.get(letter, 0) | 1 << i
        goal = 1 << len(word)
        found: set[str] = set()
        stack = [(self.root, 1, 3, 0)]
        while stack:
            node, none, one, level = stack.pop()
            if depth is not None and level >= depth:
                return True
            for letter, child in node.items():
                if letter == "":
                    if (none | one) & goal:
                        found.add(child)
                    continue
                mask = masks.get(letter, 0)
                straight = (none & mask) << 1
                edited = (one & mask) << 1 | none | none << 1 | straight << 1
                if straight or edited & (2 * goal - 1):
                    stack.append((child, straight, edited & (2 * goal - 1), level + 1))
        return bool(found) if depth is not None else found


class Matcher:
    """Says of a word whether it is a hit: 'exact', 'near' or None; remembers a bounded number of words and of their starts."""

    #: Letters of a word on which the first ``PROBE`` levels of the walk depend, at one edit.
    PROBE = 3

    def __init__(self, model: Model, most: int = 400_000):
        self.terms, self.stems, self.benign = set(model.terms), set(model.stems), set(model.benign)
        self.stem_lengths = sorted({len(s) for s in model.stems})
        self.trie = Trie(t for t in model.terms if len(t) >= LEAST_NEAR)
        self.alive: dict[str, bool] = {}
        self.kinds: dict[str, str] = {}
        self.seen: set[str] = set()
        self.most = most

    def kind(self, raw: str) -> str | None:
        word = core(raw)
        if word in self.terms or any(word[:n] in self.stems and len(word) > n for n in self.stem_lengths):
            return "exact"
        if len(word) < 4 or word in self.benign:
            return None
        start = word[: self.PROBE + 1]
        if (alive := self.alive.get(start)) is None:
            if len(self.alive) >= self.most:
                self.alive.clear()
            alive = self.alive[start] = bool(self.trie.within_one(start, self.PROBE))
        return "near" if alive and self.trie.within_one(word) else None

    def hits(self, words: list[str]) -> dict[str, str]:
        """The distinct words that are hits, and their kinds."""
        distinct = set(words)
        if new := distinct - self.seen:
            if len(self.seen) + len(new) > self.most:
                self.seen.clear()
                self.kinds.clear()
                new = distinct
            for w in new:
                if k := self.kind(w):
                    self.kinds[w] = k
            self.seen |= new
        return {w: self.kinds[w] for w in distinct & self.kinds.keys()}


def features(words: list[str], matcher: Matcher, window: int) -> tuple[float, ...]:
    """Bias and counts of hits by their context, by their logarithms: the first hit says most."""
    kinds = matcher.hits(words)
    if not kinds:
        return 1.0, 0.0, 0.0, 0.0, 0.0
    at = [i for i, w in enumerate(words) if w in kinds]
    exact = near = beside = quoted = 0
    for k, i in enumerate(at):
        around = words[max(0, i - window) : i + window + 1]
        if is_quoted(words, i, window) or not REPORTING.isdisjoint(map(core, around)):
            quoted += 1
        elif kinds[words[i]] == "exact":
            exact += 1
        else:
            near += 1
        beside += (k > 0 and i - at[k - 1] <= window) or (k + 1 < len(at) and at[k + 1] - i <= window)
    return 1.0, *(math.log2(1 + n) for n in (exact, near, beside, quoted))


def is_quoted(words: list[str], at: int, window: int) -> bool:
    """Quotation marks open at or shortly before the word and close at or shortly after it."""
    left = any(w[0] in QUOTES for w in words[max(0, at - window) : at + 1])
    right = any(w.rstrip(".,;:!?")[-1:] in QUOTES for w in words[at : at + window + 1] if w.rstrip(".,;:!?"))
    return left and right


def score_of(values, weights) -> float:
    z = sum(a * b for a, b in zip(values, weights))
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


# --- fitting --------------------------------------------------------------------------------------------------------


def training_texts(docs: DataFrame, labels: DataFrame, params: FitParams) -> DataFrame:
    """(text, toxic) of about ``max_labelled`` labelled rows outside the held-out fold, each text once."""
    rows = labelled_sample(labels, F.max("toxic"), params.max_labelled, params.folds).select("labelled_id", (F.col("value") > 0).cast("int").alias("toxic"))
    # At most twice max_labelled rows of two numbers: a proven bound for the broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(rows), F.col("doc_id") == F.col("labelled_id")).select("text", "toxic")
    return texts.groupBy(F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def _term_counts(texts: DataFrame, wanted, stem_lengths) -> DataFrame:
    """In how many texts each term and stem occurs; counted per task first.  wanted: a broadcast set, or None for all."""

    def count(batches):
        seen: Counter = Counter()
        pool = wanted.value if wanted is not None else None
        for pdf in batches:
            for text in pdf["text"]:
                plain = {core(w) for w in words_of(text)}
                plain = {w for w in plain if len(w) >= 3}
                grams = {("t", w) for w in plain} | {("s", w[:n]) for w in plain for n in stem_lengths if len(w) > n}
                seen.update(grams if pool is None else grams & pool)
        yield pd.DataFrame([(k, w, n) for (k, w), n in seen.items()], columns=["kind", "term", "n"])

    return texts.mapInPandas(count, "kind string, term string, n long").groupBy("kind", "term").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, params: FitParams = FitParams()) -> Model:
    """Lexicon and weights from the labelled rows of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    texts = materialize(training_texts(docs, labels, params), "labelled")
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic:
        prior = math.log(0.5 / (n_clean + 1.0))
        return Model(weights=(min(PRIOR[0], prior), *PRIOR[1:]), window=params.window)
    toxic, clean = texts.filter("toxic = 1"), texts.filter("toxic = 0")
    least = min(params.rare, max(2, math.ceil(0.004 * n_toxic)))
    in_toxic = {(r["kind"], r["term"]): r["n"] for r in _term_counts(toxic, None, params.stem_lengths).filter(F.col("n") >= least).collect()}
    pool = spark.sparkContext.broadcast(set(in_toxic))
    in_clean = {(r["kind"], r["term"]): r["n"] for r in _term_counts(clean, pool, params.stem_lengths).collect()}
    odds = {g: math.log((n + 0.5) / (n_toxic + 1)) - math.log((in_clean.get(g, 0) + 0.5) / (n_clean + 1)) for g, n in in_toxic.items()}
    marking = {g for g, x in odds.items() if x >= params.least_log_odds and in_clean.get(g, 0) <= 0.1 * in_toxic[g]}
    holding = toxic.mapInPandas(_holding(spark.sparkContext.broadcast(marking), params.stem_lengths), "grams array<string>").collect()
    grams = [{(g[0], g[1:]) for g in r["grams"]} for r in holding]
    # Nested grams counted once bring the words that stems displace; counted each, the stems of rare forms.
    chosen = {g for once in (True, False) for g in cover(grams, in_toxic, in_clean, params, least, once)}
    stems = {w for k, w in chosen if k == "s"}
    terms = {w for k, w in chosen if k == "t"} | whole_terms(marking, stems, params.stem_lengths)
    model = Model(terms=sorted(terms), stems=sorted(stems), window=params.window)
    model.benign = [r["word"] for r in clean.mapInPandas(_near_words(spark.sparkContext.broadcast(model)), "word string").distinct().collect()]
    rows = texts.mapInPandas(_features(spark.sparkContext.broadcast(model)), "toxic int, f array<double>").groupBy("toxic", "f").agg(F.count("*").alias("n")).collect()
    model.weights = regress(np.array([r["f"] for r in rows]), np.array([r["toxic"] for r in rows], float), np.array([r["n"] for r in rows], float), params)
    return model


def _holding(marking, stem_lengths):
    def hold(batches):
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                plain = {w for w in map(core, words_of(text)) if len(w) >= 3}
                grams = {("t", w) for w in plain} | {("s", w[:n]) for w in plain for n in stem_lengths if len(w) > n}
                out.append(["".join(g) for g in grams & marking.value])
            yield pd.DataFrame({"grams": out})

    return hold


def _near_words(model):
    def near(batches):
        matcher = Matcher(model.value)
        for pdf in batches:
            found = {core(w) for text in pdf["text"] for w, kind in matcher.hits(words_of(text)).items() if kind == "near"}
            yield pd.DataFrame({"word": sorted(found)}, dtype="object")

    return near


def _features(model):
    def of(batches):
        matcher = Matcher(model.value)
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"], "f": [[float(x) for x in features(words_of(t), matcher, model.value.window)] for t in pdf["text"]]})

    return of


def cover(holding: list[set], in_toxic: dict, in_clean: dict, params: FitParams, least: int, once: bool) -> list[tuple[str, str]]:
    """Greedy choice of terms until each text holds ``params.cover`` of them, or none would newly serve ``least`` texts.

    Of grams that serve equally many texts the one rarer in clean texts wins,
    then a whole term before a stem, then the longer.  With ``once``,
    grams of which one begins with the other serve a text once: the stems of
    one word don't fill the cover of a text in place of its other words.
    """
    held: list[list[str]] = [[] for _ in holding]

    def serves(i: int, gram: str) -> bool:
        return len(held[i]) < params.cover and not (once and any(gram.startswith(h) or h.startswith(gram) for h in held[i]))

    texts_of: dict[tuple[str, str], list[int]] = {}
    for i, grams in enumerate(holding):
        for g in grams:
            texts_of.setdefault(g, []).append(i)
    value = {g: len(t) for g, t in texts_of.items()}
    rank = {g: (in_clean.get(g, 0), g[0] == "s", -len(g[1]), g[1]) for g in value}
    chosen: list[tuple[str, str]] = []
    heap = [(-v, rank[g], g) for g, v in value.items()]
    heapq.heapify(heap)
    while heap:
        v, order, g = heapq.heappop(heap)
        new = [i for i in texts_of[g] if serves(i, g[1])]
        now = len(new)
        if now < least:
            continue
        if now < -v:
            heapq.heappush(heap, (-now, order, g))
            continue
        chosen.append(g)
        for i in new:
            held[i].append(g[1])
    return chosen


def whole_terms(marking: set, stems: set, stem_lengths) -> set[str]:
    """The marking terms, long enough for the automaton, that one of ``stems`` stands for."""
    return {w for k, w in marking if k == "t" and len(w) >= LEAST_NEAR and any(w[:n] in stems for n in stem_lengths)}


def regress(x: np.ndarray, y: np.ndarray, n: np.ndarray, params: FitParams) -> tuple[float, ...]:
    """Newton steps for a logistic model whose weights are held near ``PRIOR``; hits never count as signs of a clean text."""
    prior = np.array(PRIOR)
    w = prior.copy()
    hold = np.diag([params.ridge * 0.25] + [params.ridge] * (len(prior) - 1))
    for _ in range(params.steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + hold, x.T @ (n * (p - y)) + hold @ (w - prior))
        w = w - np.clip(step, -1, 1)
        w[1:] = np.maximum(w[1:], 0.0)
        if np.abs(step).max() < 1e-9:
            break
    # No hit never reaches 0.5, and a text with several exact hits always does.
    return float(min(w[0], -0.5)), *map(float, w[1:])


# --- scoring --------------------------------------------------------------------------------------------------------

def matcher_of(number: str, model: Model) -> Matcher:
    """A worker's matcher for one model; that of an earlier model is dropped."""
    held = cache_of("toxicity")
    if number not in held:
        held.clear()
        held[number] = Matcher(model)
    return held[number]


def score_column(text: Column, spark: SparkSession, model: Model) -> Column:
    """Scores of a text column; the model (at most ``cover`` terms and stems for each toxic text of the sample, and the marking terms of the stems) is broadcast."""
    sent = spark.sparkContext.broadcast(model)
    number = uuid.uuid4().hex

    @F.pandas_udf("double")
    def toxicity_of(texts: pd.Series) -> pd.Series:
        model = sent.value
        matcher = matcher_of(number, model)
        return pd.Series([score_of(features(words_of(t), matcher, model.window), model.weights) for t in texts], dtype="float64")

    return toxicity_of(text)


def score_toxicity(docs: DataFrame, model: Model, folds: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score and predicted for every row; a map without any shuffle."""
    prepare(docs.sparkSession)
    scored = docs.select(F.col(f"`{key}`").alias("doc_id"), score_column(F.col(f"`{text}`"), docs.sparkSession, model).alias("score"))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id"), folds), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with the columns they came with."""
    prepare(docs.sparkSession)
    own = fresh(docs, "toxicity_score")
    return docs.withColumn(own, score_column(F.col(f"`{text}`"), docs.sparkSession, model)).filter(F.col(own) < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])
