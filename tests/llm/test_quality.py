"""The quality model against counts made by hand in plain Python, and the bound of its sample."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from shelfscout.llm import quality


def _discounts(counts):
    n = Counter(counts)
    if not n[1] or not n[2]:
        return [0.5, 0.75, 0.9]
    y = n[1] / (n[1] + 2 * n[2])
    third = 3 - 4 * y * n[4] / n[3] if n[3] else 1.5
    return [min(max(d, 0.05), top) for d, top in ((1 - 2 * y * n[2] / n[1], 0.95), (2 - 3 * y * n[3] / n[2], 1.95), (third, 2.95))]


class BruteForce:
    """Interpolated modified Kneser-Ney over dictionaries, one probability at a time."""

    def __init__(self, texts, known, shapes):
        self.known, self.shapes = known, shapes
        self.size = quality.FIRST + len(known) + len(shapes)
        tri = Counter()
        for text in texts:
            tri.update(self.grams(text))
        bi = Counter(g[1:] for g in tri)
        uni = Counter(g[1:] for g in bi)
        self.orders = [(t, _discounts(t.values()), self.totals(t)) for t in (uni, bi, tri)]

    @staticmethod
    def totals(counts):
        found = defaultdict(list)
        for gram, n in counts.items():
            found[gram[:-1]].append(n)
        return found

    def token(self, word):
        if word in self.known:
            return word
        s = quality.shape(word)
        return s if s in self.shapes else "<odd>"

    def grams(self, text):
        tokens = ["<s>", "<s>", *map(self.token, text.split()), "</s>"]
        return list(zip(tokens, tokens[1:], tokens[2:]))

    def p(self, gram):
        if not gram:
            return 1 / self.size
        counts, discounts, totals = self.orders[len(gram) - 1]
        seen = totals.get(gram[:-1])
        if not seen:
            return self.p(gram[1:])
        off = lambda n: discounts[min(n, 3) - 1]
        c = counts.get(gram, 0)
        own = (c - off(c)) / sum(seen) if c else 0.0
        return own + sum(map(off, seen)) / sum(seen) * self.p(gram[1:])

    def perplexity(self, text):
        return float(10 ** -np.mean([np.log10(self.p(g)) for g in self.grams(text)]))


def test_perplexity_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i)}" for i in range(25)]
    text = lambda: " ".join(words[int(i)] for i in np.minimum(rng.geometric(0.2, rng.integers(1, 60)), 25) - 1)
    # A run of one character collapses in the shape; single words stay out of the vocabulary.
    train = [text() for _ in range(60)] + ["Once 12 twice-3x", "Onze 77"]
    model = quality.fit(spark.createDataFrame([(t,) for t in train], "text string"))
    often = Counter(w for t in train for w in t.split())
    known = {w for w, n in often.items() if n > 1}
    shapes = {quality.shape(w) for w, n in often.items() if n == 1}
    brute = BruteForce(train, known, shapes)
    assert brute.size == model.words.size
    for t in [*train[:10], *train[-2:], *(text() for _ in range(10)), "never Seen 9 !? wa wb", ""]:
        assert model.perplexity(t) == pytest.approx(brute.perplexity(t), rel=1e-9), t


def test_lookup_finds_each_key_and_no_other():
    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(0, 1 << 45, n))
        asked = np.concatenate([keys, keys + 1, rng.integers(0, 1 << 45, 50)])
        held = dict(zip(keys.tolist(), range(len(keys))))
        got = quality.Lookup(keys, np.arange(len(keys), dtype=float)).find(asked, -1.0)
        assert got.tolist() == [held.get(k, -1) for k in asked.tolist()]


def test_words_outside_the_vocabulary_are_forgotten_and_found_again(monkeypatch):
    monkeypatch.setattr(quality, "SEEN_WORDS", 3)
    words = quality.Words(["the", "caf\u00e9", quality.shape("cat"), quality.shape("12")])
    text = "the cat\u00a0x caf\u00e9 12\x0b345 ?? \x1c Dog sat\ton the mat 12"
    plain = [words.ids.get(w) or words.ids.get(quality.shape(w), quality.ODD) for w in quality._BLANK.split(text) if w]
    for _ in range(2):
        assert words.encode(text).tolist() == [quality.START, quality.START, *plain, quality.END]
    assert words.encode(None).tolist() == words.encode(" \n").tolist() == [quality.START, quality.START, quality.END]
    assert len(words._codes) <= 4 + 3


def test_the_sample_is_bounded_in_words(spark):
    texts = [(i, "a b c d") for i in range(400)] + [(1000, "x " * 5000), (1001, None), (1001, "y")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    trusted = docs.select(quality.named("doc_id").alias("trusted_id")).distinct()
    ids = lambda **bounds: {r[0] for r in quality.sample_ids(docs, trusted, **bounds).collect()}
    half = ids()
    assert 100 < len(half) < 300
    # Five tokens a text, the end counted; what alone is too long leaves room for others.
    few = ids(train_words=100)
    assert few - {1001} < half and 19 <= len(few) <= 20 and 1000 not in few
    assert few <= ids(train_words=200) and ids(train_words=4) <= {1001}
    assert ids(train_docs=40) < half
    assert quality.sample_ids(docs, trusted.limit(0)).count() == 0


def test_documents_left_out_by_the_bound_are_held_out(spark):
    texts = [(i, f"the cat {'sat ' * (1 + i % 3)}down", "en") for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    got = quality.judge(docs, labels, train_words=300).collect()
    assert len(got) == 200 and sum(r["keep"] for r in got) >= 190
    assert len({r["threshold"] for r in got}) == 1 and got[0]["threshold"] is not None
    # No text fits: nothing is learnt, all with content stay.
    none = quality.judge(docs, labels, train_words=1).collect()
    assert all(r["keep"] and r["perplexity"] is None for r in none)


def test_all_trusted_documents_are_fitted_on_or_held_out(spark):
    """Nothing bounds the fit: about half of the ids, whatever their number and length."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    trusted = docs.select(F.col("doc_id").alias("trusted_id"))
    assert quality.sample_ids(docs, trusted).count() > 9_000
    long = spark.createDataFrame([(i, "x " * 200_000) for i in range(40)], "doc_id long, text string")
    assert 10 < quality.sample_ids(long, long.select(F.col("doc_id").alias("trusted_id"))).count() < 30


def test_sharded_scores_equal_the_gathered_model(spark, monkeypatch):
    """Texts met in shards, in groups of a few tokens, with hot and rare middle words."""
    rng = np.random.default_rng(9)
    text = lambda: " ".join(f"w{i}" for i in rng.geometric(0.05, rng.integers(0, 80)))
    train = spark.createDataFrame([(text(),) for _ in range(80)], "text string")
    rows = [(i, text()) for i in range(60)] + [(100, None), (101, "never seen 12"), (102, "w1 " * 300)]
    docs = spark.createDataFrame(rows, "place long, text string").repartition(3)
    monkeypatch.setattr(quality, "TOKENS_AT_ONCE", 200)
    fitted, model = quality.fit_tables(train), quality.fit(train)
    for least, rows_of in ((24, 10**6), (8, 20)):
        monkeypatch.setattr(quality, "LEAST_SHARDS", least)
        monkeypatch.setattr(quality, "SHARD_ROWS", rows_of)
        sharded = quality.sharded(fitted)
        codes = docs.select("place", quality.coded(F.col("text"), sharded).alias("c")).select("place", "c.n", "c.ids")
        got = {r["place"]: r["s"] for r in quality.log_sums(codes, sharded).collect()}
        assert len(got) == len(rows)
        for place, told in rows:
            assert got[place] == pytest.approx(model.logs(told).sum(), rel=1e-9), place
