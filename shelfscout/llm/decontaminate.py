"""Benchmark decontamination: BM25 with block-max WAND, then overlap of question and answer.

The test items are the indexed side; every passage of every text is a query. An item is retrieved when its score
reaches what a passage must reach if ``CONTAINMENT`` of the item's word shingles are to be found in it: the item's own
score less its heaviest terms, one per shingle that may be missing. So retrieval loses nothing that the check would
accept. Scores are divided by that threshold, which makes it 1 for all items; a passage whose summed term maxima stay below 1
is left at once, then each block of items by its own maxima, and only items of open blocks are scored.

A hit holds ``CONTAINMENT`` of the item's shingles of five words, half of the question's and half of the answer's words.
The answer of an item is its last sentence, or the last third of its words when it has one sentence only.

Items fall into classes by their number of words, up to 16, 64, 256 and so on. Passages are windows of three times the bound of the
class, half of it apart, so any run of one and a half item lengths lies in one passage whole, and whether a text holds an item depends
on these two alone. Items come in slices of up to ``SLICE_ITEMS`` and about ``SLICE_CHARS``, each indexed and broadcast by itself; only
the reported score depends on the other items of the slice, by its word weights.

Defined results: NULL or blank texts and items match nothing; items shorter than a shingle must occur whole;
repeated items and rows are reported each; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfscout.llm.common import named, shared

SHINGLE = 5
CONTAINMENT = 0.8
PART_OVERLAP = 0.5
K1, B = 1.2, 0.75
BLOCK_ITEMS = 4
SLICE_ITEMS = 2000
SLICE_CHARS = 4 << 20
# The least class of items ends at so many words, each further one at so many times the one before.
CLASS_WORDS, CLASS_GROWTH = 16, 4

HIT = T.ArrayType(
    T.StructType(
        [
            T.StructField("item", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("overlap", T.DoubleType()),
            T.StructField("question_overlap", T.DoubleType()),
            T.StructField("answer_overlap", T.DoubleType()),
        ]
    )
)

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[.!?\n]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles(words: Sequence[str]) -> list[tuple[str, ...]]:
    """All runs of five words, repeats included; the whole sequence when it is shorter."""
    return [tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))] if words else []


def split_item(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer."""
    parts = [w for w in map(words_of, _SENTENCE.split(text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = max(1, len(words) * 2 // 3)
    return words[:cut], words[cut:]


def overlaps(item: Index.Item, words: Sequence[str]) -> tuple[float, float, float]:
    """Share of the item's shingles, of the question's shingles and of the answer's words found in a passage."""
    there = set(shingles(words))
    if len(item.words) < SHINGLE or len(item.question) < SHINGLE:
        for n in {len(item.words), len(item.question)}:
            there |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    single = set(words)
    share = lambda parts, pool: sum(p in pool for p in parts) / len(parts) if parts else 1.0
    return share(item.shingles, there), share(shingles(item.question), there), share(item.answer, single)


def class_bound(words: int) -> int:
    """The greatest number of words in the class of an item."""
    bound = CLASS_WORDS
    while bound < words:
        bound *= CLASS_GROWTH
    return bound


class Group:
    """The postings of the items of one class; terms are numbered by the index."""

    def __init__(self, items: list[tuple[int, Index.Item, dict[int, float]]], bound: int, terms: int):
        self.items = [(n, item) for n, item, _ in items]
        # Half a window.
        self.step = -(-3 * bound // 2)
        rows = sorted((term, place, value) for place, (_, _, weight) in enumerate(items) for term, value in weight.items())
        held = np.array([r[0] for r in rows], np.int64)
        self.places = np.array([r[1] for r in rows], np.int64)
        self.weights = np.array([r[2] for r in rows])
        # Terms of the class, in order, and where the postings of each start.
        self.own, self.starts = np.unique(held, return_index=True)
        self.starts = np.append(self.starts, len(rows))
        self.place_of = np.full(terms, -1, np.int64)
        self.place_of[self.own] = np.arange(len(self.own))
        self.block_max = np.zeros((len(self.own), -(-len(items) // BLOCK_ITEMS)))
        np.maximum.at(self.block_max, (self.place_of[held], self.places // BLOCK_ITEMS), self.weights)
        self.term_max = self.block_max.max(axis=1, initial=0)

    def score(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items with a score of 1 or more, for the distinct terms of one passage."""
        open_ = self.block_max[terms].sum(axis=0) >= 1
        if not open_.any():
            return np.empty(0, np.int64), np.empty(0)
        sizes = self.starts[terms + 1] - self.starts[terms]
        ends = np.cumsum(sizes)
        rows = np.arange(ends[-1]) + np.repeat(self.starts[terms] - ends + sizes, sizes)
        rows = rows[open_[self.places[rows] // BLOCK_ITEMS]]
        scores = np.bincount(self.places[rows], self.weights[rows], len(self.items))
        found = np.flatnonzero(scores >= 1)
        return found, scores[found]

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Passages by their first word, with the items retrieved for each, for the terms of a text (-1: none)."""
        terms = np.where(ids >= 0, self.place_of[ids], -1)
        at = np.flatnonzero(terms >= 0)
        if not len(at):
            return
        # A passage is two neighbouring half windows: its bound is at most the sum of theirs.
        size = len(self.own)
        half = np.unique((at // self.step) * size + terms[at])
        owner, term = half // size, half % size
        halves = -(-len(ids) // self.step)
        bound = np.bincount(owner, self.term_max[term], halves)
        passages = max(1, halves - 1)
        either = bound + np.append(bound[1:], 0.0)
        edges = np.searchsorted(owner, np.arange(halves + 1))
        for p in np.flatnonzero(either[:passages] >= 1):
            distinct = np.unique(term[edges[p] : edges[min(p + 2, halves)]])
            if self.term_max[distinct].sum() < 1:
                continue
            places, scores = self.score(distinct)
            if len(places):
                yield int(p) * self.step, places, scores


class Index:
    """Inverted index of a slice of items with block maxima; weights are divided by each item's threshold."""

    class Item:
        def __init__(self, text: str):
            self.words, self.shingles = words_of(text), shingles(words_of(text))
            self.question, self.answer = split_item(text)

    def __init__(self, texts: Sequence[str]):
        items = [(n, item) for n, item in enumerate(map(Index.Item, texts)) if item.words]
        # Items of like length share a block, so that its maxima are close to each of them.
        items.sort(key=lambda x: len(x[1].words))
        self.vocabulary: dict[str, int] = {}
        held: dict[str, int] = {}
        for _, item in items:
            for word in set(item.words):
                self.vocabulary.setdefault(word, len(self.vocabulary))
                held[word] = held.get(word, 0) + 1
        mean = sum(len(i.words) for _, i in items) / max(1, len(items))
        by_class: dict[int, list] = {}
        for n, item in items:
            norm = K1 * (1 - B + B * len(item.words) / mean)
            weight = {
                w: np.log1p((len(items) - held[w] + 0.5) / (held[w] + 0.5)) * tf * (K1 + 1) / (tf + norm)
                for w, tf in Counter(item.words).items()
            }
            heavy = sorted(weight.values(), reverse=True)
            missing = int((1 - CONTAINMENT) * len(item.shingles) + 1e-9)
            # A word that is gone takes a shingle with it at least, so so many of the heaviest may be gone.
            need = max(sum(heavy[missing:]), heavy[-1]) * (1 - 1e-9)
            scaled = {self.vocabulary[w]: value / need for w, value in weight.items()}
            by_class.setdefault(class_bound(len(item.words)), []).append((n, item, scaled))
        self.groups = [Group(of, bound, len(self.vocabulary)) for bound, of in by_class.items()]

    def hits(self, text: str | None) -> list[dict]:
        """Verified items of a text, each with its best passage."""
        words = words_of(text)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        best: dict[int, tuple] = {}
        for group in self.groups if (ids >= 0).any() else ():
            for first, places, scores in group.candidates(ids):
                part = words[first : first + 2 * group.step]
                for place, score in zip(places, scores):
                    n, item = group.items[place]
                    whole, question, answer = overlaps(item, part)
                    if whole >= CONTAINMENT - 1e-9 and question >= PART_OVERLAP and answer >= PART_OVERLAP:
                        best[n] = max(best.get(n, ()), (whole, question, answer, float(score)))
        return [
            {"item": n, "score": s, "overlap": w, "question_overlap": q, "answer_overlap": a} for n, (w, q, a, s) in sorted(best.items())
        ]


def slices(items: DataFrame, id_: str = "item_id", text: str = "text", rows: int = SLICE_ITEMS, chars: int = SLICE_CHARS) -> list[tuple[list, list[str]]]:
    """The test items in bounded slices of (ids, texts); a benchmark is a file people wrote, but its size is not trusted."""
    kept = items.select(named(id_).alias("id"), named(text).alias("text")).where("text IS NOT NULL")
    out: list[tuple[list, list[str]]] = []
    size = 0
    for row in kept.toLocalIterator():
        if not out or len(out[-1][0]) == rows or size >= chars:
            out.append(([], []))
            size = 0
        size += len(row["text"])
        out[-1][0].append(row["id"])
        out[-1][1].append(row["text"])
    return out


def matches(docs: DataFrame, texts: Sequence[str], text: str = "text") -> Column:
    """Hits of every text against one slice of items; ``item`` is the place in ``texts``."""
    index = shared(docs.sparkSession, Index(texts))
    find = F.pandas_udf(lambda column: pd.Series([index().hits(t) for t in column], dtype=object), HIT)
    return find(named(text))


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, item_id, score, overlap, question_overlap, answer_overlap)``: a row per text and test item found in it."""
    spark = docs.sparkSession
    schema = "k long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"
    found = spark.createDataFrame([], schema)
    for ids, texts in slices(items):
        hit = docs.select(named(key).alias("k"), F.explode(matches(docs, texts, text)).alias("hit"))
        named_ids = F.element_at(F.lit([i if i is not None else -1 for i in ids]).cast("array<long>"), (F.col("hit.item") + 1).cast("int"))
        void = F.array_contains(F.array(*[F.lit(n) for n, i in enumerate(ids) if i is None] or [F.lit(-1)]), F.col("hit.item").cast("int"))
        found = found.unionAll(
            hit.select(
                "k", F.when(~void, named_ids).alias("item_id"),
                "hit.score", "hit.overlap", "hit.question_overlap", "hit.answer_overlap",
            )
        )
    return found.withColumnRenamed("k", key)


def clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no test item."""
    kept = docs
    for _, texts in slices(items):
        kept = kept.where(F.size(matches(docs, texts, text)) == 0)
    return kept
