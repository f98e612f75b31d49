"""Toxic passages as maximum-scoring segments of token log-odds.

Fitting counts tokens in labelled documents and gives every token the log-odds of toxic
against other text. Priors are Dirichlet, chained: a word's counts are smoothed by its
five-letter beginning, that by its four-letter beginning, that by the share of all tokens, so
words never seen lean on what they begin like. Scoring scans a text once for all its maximal
scoring segments. How high a segment of clean text gets by chance follows an extreme-value
law, whose two parameters are fitted on other labelled documents; segments beyond it are the
toxic passages, and their joint evidence becomes a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.llm.common import WORD, text_batches, whole_text
from tslines.session import staged

#: The size of the model: counts of so many words and beginnings, at most. Labelled documents
#: that hold more are too many to fit on: half of them are, or a quarter, and so on. What is
#: fitted on is counted in full.
MAX_KEYS = 1 << 22
#: Words whose counts a task gathers before it passes them on.
GATHERED = 200_000
#: Whole words, then beginnings of so many letters.
LENGTHS = (0, 5, 4)
#: Labelled documents used for fitting, at most; the rest of them would add little.
MAX_FIT_DOCS = 40_000
#: Strength of each prior in tokens, and what every token costs a segment.
CONCENTRATION, DRIFT = 4.0, 2.0
#: Shares are kept this far from none and all, so that scores stay finite.
LEAST_SHARE = 1e-6
#: Of five documents to fit on, one is for the extreme-value law and the curve.
FIFTHS_HELD = 1
#: A passage is significant if chance gives fewer than so many as good in a text.
E_VALUE = 0.05

WORDS = re.compile(WORD)
EDGES = ".,;:!?\"'()[]{}*#$%&|<>-_"


def keys(word: str) -> tuple[int, ...]:
    """A word's 64-bit key for each length of beginning."""
    word = word.strip(EDGES) or word
    return tuple(xxhash.xxh64_intdigest(f"{n}:{word[:n] if n else word}") - (1 << 63) for n in LENGTHS)


def tokens(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score), in order, in linear time.

    Only positive scores start or extend a segment. Each keeps the sums before and after it
    and a link to the nearest earlier one that starts lower, so none is looked at twice.
    """
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    sums = np.cumsum(scores)
    after = sums[up]
    before = after - scores[up]
    stack: list[list] = []  # first, end, sum before, sum after, link
    for at, low, high in zip(up.tolist(), before.tolist(), after.tolist(), strict=True):
        first, j = at, len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                break
            first, low = stack[j][0], stack[j][2]
            link = stack[j][4]
            del stack[j:]
            j = link
        stack.append([first, at + 1, low, high, j])
    return [(first, end, high - low) for first, end, low, high, _ in stack]


@dataclass(frozen=True)
class Model:
    """Counts by sorted key, the extreme-value law of clean text, and the final logistic curve."""

    share: float
    keys: np.ndarray
    toxic: np.ndarray
    all: np.ndarray
    decay: float
    rate: float
    slope: float
    offset: float

    def scores(self, words: list[str]) -> np.ndarray:
        """Log-odds of each word: from the share of all tokens over short beginnings to the
        word itself, each smoothed by the one before."""
        own = np.array([keys(word) for word in words], np.int64).reshape(-1, len(LENGTHS))
        share = np.full(len(words), self.share)
        for key in own.T[::-1] if len(self.keys) else ():
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            smoothed = (self.toxic[at].astype(float) + CONCENTRATION * share) / (self.all[at].astype(float) + CONCENTRATION)
            share = np.where(self.keys[at] == key, smoothed, share)
        share = np.clip(share, LEAST_SHARE, 1 - LEAST_SHARE)
        return np.log(share / (1 - share)) - math.log(self.share / (1 - self.share)) - DRIFT

    def score(self, word: str) -> float:
        return float(self.scores([word])[0])

    def evidence(self, score: float, size: int) -> float:
        """A segment's surprise: minus the logarithm of how many as good chance gives."""
        return self.decay * score - math.log(self.rate * max(size, 1))

    def passages(self, scores: np.ndarray) -> list[tuple[int, int, float, float]]:
        """Significant segments: first and end word, score, evidence."""
        least = -math.log(E_VALUE)
        found = ((a, b, s, self.evidence(s, len(scores))) for a, b, s in segments(scores))
        return [f for f in found if f[3] >= least]

    def probability(self, passages: list[tuple[int, int, float, float]]) -> float:
        x = self.offset + self.slope * math.log1p(sum(p[3] for p in passages))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


class Scorer:
    """Scores of the words of texts; words met lately are remembered in two generations, so
    that what is in use survives when the older one goes."""

    def __init__(self, model: Model, limit: int = 200_000):
        self.model, self.limit = model, limit
        self.young: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        found = [tokens(text) for text in texts]
        new = set().union(*found) - self.young.keys()
        if len(self.young) + len(new) > self.limit:
            self.old, self.young = self.young, {}
            new = set().union(*found)
        unknown = [word for word in new if word not in self.old]
        self.young.update((word, self.old[word]) for word in new if word in self.old)
        self.young.update(zip(unknown, self.model.scores(unknown).tolist(), strict=True))
        known = self.young.__getitem__
        return [np.fromiter(map(known, words), float, len(words)) for words in found]


def fitting_rows(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text: str, label: str, most: int) -> DataFrame:
    """(text, label, part) of at most `most` labelled documents, chosen by a hash of the id.

    Labels are bounded first, so that they are broadcast and no text is shuffled. A document
    with several labels counts as toxic if one of them says so. Part 0 is for counts, part 1
    for the extreme-value law and the curve.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
    chosen = known.groupBy("id").agg(F.max("label").alias("label")).where(usable).orderBy(F.xxhash64("id"), "id").limit(most)
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    picked = rows.join(F.broadcast(chosen), "id")
    part = (F.pmod(F.xxhash64(F.col("id"), F.lit("part")), F.lit(5)) < FIFTHS_HELD).cast("int")
    return staged(picked.select("text", "label", part.alias("part")), "labelled")


def count_keys(rows: DataFrame, most: int = MAX_KEYS) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int] | None:
    """Keys in order, their tokens in toxic documents and in all; both sums over all words.
    Counted exactly; None if there are more than `most` keys, so that the driver gets no more."""

    def passed_on(counts: dict) -> pa.RecordBatch:
        found = [(k, n == 0, toxic, clean + toxic) for word, (clean, toxic) in counts.items() for n, k in zip(LENGTHS, keys(word), strict=True)]
        columns = list(zip(*found, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "whole", "toxic", "every"])

    def run(batches: Iterator) -> Iterator:
        counts: dict[str, list[int]] = {}
        for batch, texts in text_batches(batches):
            for text, label in zip(texts, batch.column("label").to_pylist(), strict=True):
                for word, n in Counter(tokens(text)).items():
                    counts.setdefault(word, [0, 0])[label] += n
                if len(counts) >= GATHERED:
                    yield passed_on(counts)
                    counts = {}
        yield passed_on(counts)

    found = rows.select("text", "label").mapInArrow(run, "key long, whole boolean, toxic long, every long")
    found = staged(found.groupBy("key", "whole").agg(F.sum("toxic").alias("toxic"), F.sum("every").alias("every")), "counts")
    sums = found.where("whole").agg(F.sum("toxic"), F.sum("every")).first()
    if found.count() > most:
        return None
    table = found.select("key", "toxic", "every").toArrow()
    order = np.argsort(key := table["key"].to_numpy())
    toxic, every = (table[c].to_numpy()[order].astype(np.float32) for c in ("toxic", "every"))
    return key[order], toxic, every, sums[0] or 0, sums[1] or 0


def extreme_value_law(model: Model, rows: DataFrame) -> Model:
    """Decay and rate of the best segment's law in clean documents: the decay at which a
    token's mean exponential score is one, then the rate by maximum likelihood."""

    def run(batches: Iterator) -> Iterator:
        scorer = Scorer(model)
        for batch, texts in text_batches(batches):
            found = scorer(texts)
            best = [max((s for _, _, s in segments(f)), default=0.0) for f in found]
            bins = [np.unique(np.round(f * 20).astype(np.int64), return_counts=True) for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(f) for f in found], pa.int64()), pa.array(best, pa.float64()), pa.array([b[0].tolist() for b in bins], pa.list_(pa.int64())), pa.array([b[1].tolist() for b in bins], pa.list_(pa.int64()))],
                ["size", "best", "bin", "n"],
            )

    clean = rows.where("label = 0").select("text", "label")
    seen = staged(clean.mapInArrow(run, "size long, best double, bin array<long>, n array<long>"), "clean")
    bins = seen.select(F.explode(F.arrays_zip("bin", "n")).alias("b")).groupBy("b.bin").agg(F.sum("b.n").alias("n")).toArrow()
    value, weight = bins["bin"].to_numpy() / 20, bins["n"].to_numpy() / max(1, sum(bins["n"].to_pylist()))
    low, high = 0.0, 4.0
    if len(value) and value.max() > 0 and (value * weight).sum() < 0:
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if (weight * np.exp(middle * value)).sum() < 1 else (low, middle)
    decay = max(high if high < 4.0 else 1.0, 0.05)
    whole = seen.where("size > 0").agg(F.count("*").alias("docs"), F.sum(F.col("size") * F.exp(-F.lit(decay) * F.col("best"))).alias("mass")).first()
    rate = whole["docs"] / whole["mass"] if whole["docs"] else 1.0
    return Model(model.share, model.keys, model.toxic, model.all, decay, rate, 0.0, 0.0)


def curve(model: Model, rows: DataFrame) -> Model:
    """The logistic curve from joint evidence to probability, by Newton steps on a histogram."""

    def run(batches: Iterator) -> Iterator:
        scorer = Scorer(model)
        for batch, texts in text_batches(batches):
            x = [math.log1p(sum(p[3] for p in model.passages(found))) for found in scorer(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(np.round(x, 2))], ["label", "x"])

    table = rows.select("text", "label").mapInArrow(run, "label int, x double").groupBy("label", "x").count().toArrow()
    x, y, n = (table[c].to_numpy().astype(float) for c in ("x", "label", "count"))
    if not len(x):
        return model
    design, theta = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        # a weak prior keeps the curve finite where classes part without a rest
        slope = design.T @ (n * (p - y)) + 0.1 * theta
        theta = theta - np.linalg.solve((design.T * (n * p * (1 - p))) @ design + 0.1 * np.eye(2), slope)
    return Model(model.share, model.keys, model.toxic, model.all, model.decay, model.rate, float(max(theta[1], 0.0)), float(theta[0]))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MAX_FIT_DOCS, most_keys: int = MAX_KEYS) -> Model:
    """Fit on labelled documents for which `usable`, a condition on `id`, holds; at most
    `most` of them, halved until they hold at most `most_keys` words and beginnings. Without labels of both kinds every text gets the same score."""
    rows = fitting_rows(docs, labels, usable, id_col, text, label, most)
    counts = count_keys(rows.where("part = 0"), most_keys)
    while counts is None:
        # documents are taken in the order of their ids' hashes, so reruns agree
        most = (most + 1) // 2 if most > 1 else 0
        rows = fitting_rows(docs, labels, usable, id_col, text, label, most)
        counts = count_keys(rows.where("part = 0"), most_keys)
    known, toxic, every, n_toxic, n_all = counts
    share = min(max(n_toxic / max(n_all, 1), 1e-4), 1 - 1e-4)
    model = Model(share, known, toxic, every, 1.0, 1.0, 0.0, 0.0)
    held = rows.where("part = 1")
    return curve(extreme_value_law(model, held), held)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, `score` (0 to 1) and `passages` of every row: first and end word, score and
    evidence of each significant passage.

    No shuffle; the model, whose size is bounded, is broadcast. Null counts as empty, and an
    empty text gets the score of a text without passages. Every row counts for itself;
    other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        model = held.value
        scorer = Scorer(model)
        for batch, texts in text_batches(batches):
            found = [model.passages(scores) for scores in scorer(texts)]
            fields = ("first", "end", "score", "evidence")
            spans = pa.array([[dict(zip(fields, p, strict=True)) for p in f] for f in found], PASSAGES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.probability(f) for f in found], pa.float64()), spans], ["id", "score", "passages"])

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, score double, passages array<struct<first:long,end:long,score:double,evidence:double>>"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


PASSAGES = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("evidence", pa.float64())]))
