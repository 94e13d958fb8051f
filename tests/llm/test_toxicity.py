"""The toxicity classifier: features and scores against brute force, held-out rows, odd tables."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from shelfscout.llm import toxicity
from shelfscout.llm.queries import QUERIES

DOCS, LABELS = "doc_id long, text string, score string, lang string", "doc_id long, toxic int, quality int"
WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()


def corpus(n=240):
    draw = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(n):
        words = list(draw.choice(WORDS, 30))
        toxic = i % 4 == 0
        if toxic:
            words[draw.integers(30)] = "Nastyword"
        rows.append((i, " ".join(words), "clash", "en"))
        labels.append((i, int(toxic), 1))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(make):
    rows, labels = corpus()
    return make(rows, DOCS), make(labels, LABELS), dict((i, t) for i, t, _ in labels), toxicity.fit(make(rows, DOCS), make(labels, LABELS))


def test_held_out_rows_are_judged_right(fitted):
    docs, _, truth, model = fitted
    scored = toxicity.score_texts(docs, model).collect()
    assert set(scored[0].asDict()) == {"doc_id", "text", "lang", *toxicity.ADDED}
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == truth[r.doc_id] == int(r.score >= 0.5)


def test_score_is_the_sum_over_distinct_grams(fitted):
    docs, _, _, model = fitted
    weights = dict(zip(model.codes.tolist(), model.weights.tolist()))
    assert any(weights)
    for row in docs.limit(20).collect():
        held = {c for codes in toxicity.gram_codes(row.text) for c in codes.tolist()}
        margin = model.bias + sum(weights.get(c, 0.0) for c in held)
        assert model.score(row.text) == pytest.approx(1 / (1 + math.exp(-margin)))


def test_ratios_are_counts_of_texts(make):
    sample = make([("abc abc", 1), ("abd", 0), ("abc", 0)], "text string, toxic int")
    found = {r.code & (2**64 - 1): (r.texts, r.ratio) for r in toxicity.log_count_ratios(sample, (2, 1)).collect()}
    grams = {}
    for text, toxic in (("abc abc", 1), ("abd", 0), ("abc", 0)):
        for code in {c for codes in toxicity.gram_codes(text) for c in codes.tolist()}:
            grams.setdefault(code, [0, 0])[toxic] += 1
    assert {c: (a + b, pytest.approx(math.log((b + 1) / 3) - math.log((a + 1) / 4))) for c, (a, b) in grams.items()} == found


def test_pieces_change_nothing(monkeypatch):
    text = "Ünïcode text with 🙂 and many words " * 20
    whole = sorted(c for codes in toxicity.gram_codes(text) for c in codes.tolist())
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert sorted(c for codes in toxicity.gram_codes(text) for c in codes.tolist()) == whole
    padded = f" {text.lower()} "
    assert len(whole) == sum(len(padded) - n + 1 for n in toxicity.ORDERS)


def test_labels_of_held_out_rows_play_no_part(make):
    rows, labels = corpus()
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, q) for i, t, q in labels]
    a, b = (toxicity.fit(make(rows, DOCS), make(x, LABELS)) for x in (labels, turned))
    assert np.array_equal(a.codes, b.codes) and np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_odd_rows_one_class_and_empty(make, fitted):
    odd = make([(1, None, "", "x"), (None, "", "", None), (2, "a" * 400_000, "", "x"), (2, "a" * 400_000, "", "x")], DOCS)
    model = fitted[3]
    scores = {(r.doc_id, r.text is None): r.score for r in toxicity.score_texts(odd, model).collect()}
    assert scores[(1, True)] == scores[(None, False)] == pytest.approx(1 / (1 + math.exp(-model.bias)))
    assert toxicity.score_texts(odd, model).count() == 4
    docs, labels = fitted[:2]
    assert toxicity.judge_toxicity(docs.limit(0), labels).count() == 0
    for some in (labels.where("toxic = 0"), labels.limit(0)):
        one = toxicity.judge_toxicity(docs, some).select("score", "predicted").distinct().collect()
        assert len(one) == 1 and 0 <= one[0].score <= 0.5


def test_query_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [r for r in QUERIES["op11_toxicity"](spark, folder).collect() if r.doc_id in labels]
    learnt = [r for r in got if not r.held_out]
    assert sum(r.predicted == labels[r.doc_id] for r in learnt) / len(learnt) > 0.97
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.9
