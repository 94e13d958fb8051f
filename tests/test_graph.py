"""Tag graph, degrees, debiased rates and the segment prior against brute force."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest

from shelfscout.operators import debias, graph

TOKENS = "item_id long, token string"


def test_edges_of_large_and_repeated_sets(spark, monkeypatch):
    monkeypatch.setattr(graph, "CHUNK", 4)
    rng = random.Random(2)
    sets = {n: {f"t{rng.randrange(30):02}" for _ in range(rng.choice((0, 1, 3, 20)))} for n in range(60)}
    # A third of all items hold one and the same set.
    sets |= {100 + n: {f"t{i:02}" for i in range(13)} for n in range(30)}
    rows = [(n, t) for n, held in sets.items() for t in held for _ in range(rng.choice((1, 2)))]
    rows += [(None, "t01"), (None, "t02"), (7, None)]
    edges = graph.cooccurrence(spark.createDataFrame(rows, TOKENS).repartition(3))
    wanted = Counter(p for held in sets.values() for p in itertools.combinations(sorted(held), 2))
    assert {(r.token_a, r.token_b): r.weight for r in edges.collect()} == wanted
    degrees = {r.token: (r.degree, r.weighted_degree) for r in graph.weighted_degree(edges).collect()}
    for token in {t for p in wanted for t in p}:
        own = [w for p, w in wanted.items() if token in p]
        assert degrees[token] == (len(own), sum(own))
    heavy = graph.cooccurrence(spark.createDataFrame(rows, TOKENS), min_weight=31).collect()
    assert len(heavy) == sum(w >= 31 for w in wanted.values())


def test_edges_of_nothing(spark):
    none = spark.createDataFrame([], TOKENS)
    assert graph.cooccurrence(none).isEmpty() and graph.weighted_degree(graph.cooccurrence(none)).isEmpty()


def test_bipartite_degrees(spark):
    pairs = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1)], "user_id long, item_id long")
    assert {tuple(r) for r in graph.bipartite_degrees(pairs).collect()} == {("user", 2, 1), ("user", 1, 2), ("item", 3, 1), ("item", 1, 1)}


def test_rare_items_weigh_more(spark):
    train = spark.createDataFrame([(u, 1) for u in range(100)] + [(0, 2)] * 25 + [(0, 3)], "user_id long, item_id long")
    chances = debias.propensities(train)
    assert {r.item_id: r.propensity for r in chances.collect()} == {1: 1.0, 2: 0.5, 3: 0.1}
    ranks = spark.createDataFrame([(1, 1, 1), (2, 2, 7), (3, 3, 99), (4, 9, 12)], "user_id long, item_id long, rank long")
    rates = {r.k: (r.hit_rate, r.n_tested) for r in debias.debiased_hit_rates(ranks, chances).collect()}
    # Weights 1, 2, 10 and, with no train pair, 100.
    assert rates == {5: (pytest.approx(1 / 113, abs=1e-6), 4), 10: (pytest.approx(3 / 113, abs=1e-6), 4), 20: (pytest.approx(103 / 113, abs=1e-6), 4)}
    none = debias.debiased_hit_rates(ranks.limit(0), debias.propensities(train.limit(0)))
    assert {(r.k, r.hit_rate, r.n_tested) for r in none.collect()} == {(5, 0.0, 0), (10, 0.0, 0), (20, 0.0, 0)}


def test_prior_is_the_share_of_the_history(spark):
    train = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (1, 4), (2, 9)], "user_id long, item_id long")
    segments = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1), (9, 2)], "item_id long, cluster int")
    users = {r.user_id: r.prior for r in debias.segment_affinity(train, segments, 3).collect()}
    assert users == {1: [0.5, 0.5, 0.0], 2: [0.0, 0.0, 1.0]}
    items = debias.segment_membership(spark.createDataFrame([(3,), (9,), (77,)], "item_id long"), segments, 3)
    assert {r.item_id: r.prior for r in items.collect()} == {3: [0.0, 1.0, 0.0], 9: [0.0, 0.0, 1.0], 77: [0.0, 0.0, 0.0]}
