"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its character n-grams (``ORDERS``, lower case, a space put at both ends), each known by 64 bits. The log-count ratio of an n-gram is the
logarithm of its smoothed share of the toxic texts over that of the others. N-grams in at least ``LEAST_TEXTS`` texts whose ratio is at least
``LEAST_RATIO`` either way are features, at most ``FEATURES`` of them, those of the highest ratio times root of the texts first. A feature that is
present has its ratio as value, and a logistic model with a penalty on its weights is fitted over them; one weight a feature, product of both, and a bias are the model.

The fit takes ``SAMPLE_TEXTS`` distinct labelled texts of each class at most, those of the smallest hash, so copies do not count twice. Their n-grams are counted
in tasks and summed by Spark; only counts of candidates and the features of the sample reach the driver. Every text is scored whole, in pieces that
overlap by the longest n-gram, so that no piece is larger than ``PIECE``.

Defined results: a NULL or blank text has the score of the bias alone; a NULL id is held as an empty one; repeated rows score alike; an empty table
gives an empty one; with labels of one class only, or none, every score is the smoothed share of toxic labels; contradicting labels of one text count in both classes.
Columns named like an added one are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfscout.llm.common import named, others, shared
from shelfscout.session import configure, spill

ORDERS = (3, 4, 5, 6)
SAMPLE_TEXTS = 3000
FEATURES = 1 << 16
LEAST_TEXTS, LEAST_RATIO, SMOOTHING = 5, 1.5, 1.0
# Weight of a toxic text in the fit beyond that of another one, the penalty, and the passes of the descent.
TOXIC_WEIGHT, PENALTY, PASSES = 3.0, 1e-3, 300
PIECE = 1 << 18
# Documents whose CRC-32 of the decimal id leaves no remainder by FOLDS are never learnt from.
FOLDS = 5
ADDED = ("held_out", "score", "predicted")

_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3)
_FILTER_BITS = 22


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def gram_codes(text: str) -> Iterator[np.ndarray]:
    """64-bit codes of the n-grams of a text, piece by piece."""
    whole = f" {text.lower()} "
    reach = max(ORDERS) - 1
    for start in range(0, len(whole), PIECE):
        # A piece reads on by the longest n-gram but takes only those that begin in it.
        points = np.frombuffer(whole[start : start + PIECE + reach].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        single = points * _MIX
        single ^= single >> np.uint64(29)
        run, begins = single, min(PIECE, len(whole) - start)
        for n in range(2, max(ORDERS) + 1):
            if len(points) < n:
                break
            run = run[:-1] * _STEP + single[n - 1 :]
            if n in ORDERS:
                code = run[:begins] * _MIX
                yield (code ^ (code >> np.uint64(32))) + np.uint64(n)


@dataclass
class Model:
    """Sorted codes with one weight each; a table of bits tells most other codes apart at once."""

    codes: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.known = np.zeros(1 << _FILTER_BITS, bool)
        self.known[self._short(self.codes)] = True

    @staticmethod
    def _short(codes: np.ndarray) -> np.ndarray:
        return (codes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def features(self, text: str | None) -> np.ndarray:
        """Places of the features that the text holds, ascending."""
        found = []
        for codes in gram_codes(text or ""):
            maybe = codes[self.known[self._short(codes)]]
            if len(maybe) and len(self.codes):
                at = np.minimum(np.searchsorted(self.codes, maybe), len(self.codes) - 1)
                found.append(np.unique(at[self.codes[at] == maybe]))
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)

    def score(self, text: str | None) -> float:
        margin = self.bias + math.fsum(self.weights[self.features(text)])
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, margin))))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, size: int) -> DataFrame:
    """``(text, toxic)``: at most ``size`` distinct texts of each class, those of the smallest hash, none of them held out."""
    told = labels.where(named(label).isin(0, 1)).select(named(key).alias("key"), named(label).cast("int").alias("toxic")).distinct()
    rows = docs.where(~held_out(named(key))).select(named(key).alias("key"), F.coalesce(named(text), F.lit("")).alias("text"))
    hashed = rows.select("key", F.xxhash64("text").alias("code"), F.length("text").alias("n"))
    distinct = spill(hashed.join(told, "key").groupBy("code", "n", "toxic").agg(F.min("key").alias("key")), "labelled")
    by_class = [distinct.where(F.col("toxic") == c).orderBy(F.hash("code"), "code", "n").limit(size) for c in (0, 1)]
    picked = spill(by_class[0].unionAll(by_class[1]), "picked")
    # At most two times ``size`` narrow rows.
    code = F.xxhash64("text")
    matched = rows.withColumn("code", code).join(F.broadcast(picked), ["key", "code"])
    one = matched.groupBy("key", "code", "toxic").agg(F.first("text").alias("text"))
    return spill(one.select("text", "toxic"), "sample", spread_by="text")


def log_count_ratios(sample: DataFrame, classes: tuple[int, int]) -> DataFrame:
    """``(code, texts, ratio)`` of every n-gram of the sample."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, int]] = []
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                held.append((np.unique(np.concatenate([*gram_codes(text), np.empty(0, np.uint64)])), toxic))
                if sum(len(c) for c, _ in held) > 4_000_000:
                    yield _summed(held)
                    held = []
        if held:
            yield _summed(held)

    counts = sample.mapInPandas(counted, "code long, clean long, toxic long").groupBy("code").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = lambda c, n: F.log((F.col(c) + SMOOTHING) / F.lit(n + 2 * SMOOTHING))
    return counts.select("code", (F.col("clean") + F.col("toxic")).alias("texts"), (share("toxic", classes[1]) - share("clean", classes[0])).alias("ratio"))


def _summed(held: list[tuple[np.ndarray, int]]) -> pd.DataFrame:
    codes, place = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
    toxic = np.repeat([float(t) for _, t in held], [len(c) for c, _ in held])
    of_toxic = np.bincount(place, weights=toxic, minlength=len(codes)).astype(np.int64)
    every = np.bincount(place, minlength=len(codes))
    return pd.DataFrame({"code": codes.view(np.int64), "clean": every - of_toxic, "toxic": of_toxic})


def _logistic(rows: list[np.ndarray], toxic: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights over present features of value ``ratios``, by accelerated descent on the penalised loss."""
    n, m = len(rows), len(ratios)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    column = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    value = ratios[column]
    size = math.sqrt(max(np.bincount(owner, weights=value * value, minlength=n).mean(), 1e-12))
    value = value / size
    share = np.where(toxic == 1, TOXIC_WEIGHT, 1.0)
    share /= share.sum()
    weights, bias, ahead, ahead_bias, pace, step = np.zeros(m), 0.0, np.zeros(m), 0.0, 1.0, 2.0

    def loss(w: np.ndarray, b: float) -> tuple[float, np.ndarray]:
        margin = np.bincount(owner, weights=value * w[column], minlength=n) + b
        return float(share @ (np.logaddexp(0.0, margin) - toxic * margin) + PENALTY / n * (w @ w)), margin

    for _ in range(PASSES):
        now, margin = loss(ahead, ahead_bias)
        error = share * (1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))) - toxic)
        slope = np.bincount(column, weights=value * error[owner], minlength=m) + 2 * PENALTY / n * ahead
        slope_bias = error.sum()
        while True:  # the step is halved until it cannot overshoot
            new, new_bias = ahead - step * slope, ahead_bias - step * slope_bias
            if loss(new, new_bias)[0] <= now - step / 2 * (slope @ slope + slope_bias**2) + 1e-12 or step < 1e-6:
                break
            step /= 2
        next_pace = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead, ahead_bias = new + (pace - 1) / next_pace * (new - weights), new_bias + (pace - 1) / next_pace * (new_bias - bias)
        weights, bias, pace = new, new_bias, next_pace
    return weights / size * ratios, float(bias)


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", size: int = SAMPLE_TEXTS, features: int = FEATURES
) -> Model:
    """The model learnt from labelled rows that are not held out."""
    spark = configure(docs.sparkSession)
    sample = labelled_sample(docs, labels, key, text, label, size)
    found = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    classes = (found.get(0, 0), found.get(1, 0))
    if not all(classes):
        return Model(np.empty(0, np.uint64), np.empty(0), math.log((classes[1] + 1) / (classes[0] + 1)))
    strength = F.abs("ratio") * F.sqrt("texts")
    wanted = log_count_ratios(sample, classes).where((F.col("texts") >= LEAST_TEXTS) & (F.abs("ratio") >= LEAST_RATIO))
    # Bounded by ``features``.
    table = wanted.orderBy(strength.desc(), "code").limit(features).select("code", "ratio").toPandas()
    codes = table["code"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(codes)
    codes, ratios = codes[order], table["ratio"].to_numpy(float)[order]
    bare = shared(spark, Model(codes, np.zeros(len(codes)), 0.0))

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [bare().features(t).astype(np.int32).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "places": packed})

    # Bounded by the rows of the sample and by ``features``; sorted, so that the sums do not depend on the order of tasks.
    rows = sorted((r["toxic"], bytes(r["places"])) for r in sample.mapInPandas(seen, "toxic int, places binary").toLocalIterator())
    weights, bias = _logistic([np.frombuffer(p, np.int32) for _, p in rows], np.array([t for t, _ in rows], float), ratios)
    return Model(codes, weights, bias)


def score_texts(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``held_out``, ``score`` and ``predicted`` to every row."""
    sent = shared(configure(docs.sparkSession), model)
    judge = F.pandas_udf(lambda texts: pd.Series([sent().score(t) for t in texts], dtype=float), T.DoubleType())
    scored = docs.select(*others(docs, ADDED), held_out(named(key)).alias("held_out"), judge(named(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def judge_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_texts(docs, fit(docs, labels))
